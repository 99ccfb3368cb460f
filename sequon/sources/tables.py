"""Where rows come from: values in the program, files, files as they arrive."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A bounded table of values written in the program."""
    return spark.createDataFrame(list(rows), schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table in a folder of tables."""
    return spark.read.parquet(str(PurePosixPath(folder) / f"{name}.parquet"))


def arriving(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, oldest first.

    ``files_per_batch`` limits what one micro-batch, and so one key in one
    micro-batch, can hold.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
