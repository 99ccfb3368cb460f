"""What several operators share: words, keys of texts, tables kept on shared storage."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at ASCII white space and nowhere else.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or else the warehouse's."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/sequon-{uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """The same rows, written once below the shared folder and read from there.

    It cuts the lineage: a lost executor costs no more than the tasks it ran.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` to be broadcast if it has at most ``most_rows`` rows; else as it is.

    ``df`` must be cheap to count, as a kept table is. Beyond the bound Spark joins by
    shuffle; the rows of the result are the same.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def text_key(text: str | Column) -> Column:
    """Equal for equal texts only; null for a null text."""
    return F.unhex(F.sha2(F.col(text) if isinstance(text, str) else text, 256))


def crc32_text(value: str) -> Column:
    """Unsigned CRC-32 of a number or text as UTF-8."""
    return F.crc32(F.col(value).cast("string"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(taken: list[str], name: str) -> str:
    """``name``, made longer until no column has it."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def checkpoints(context: SparkContext) -> None:
    """Give the session a checkpoint folder if it has none."""
    if context.getCheckpointDir() is None:
        spark = SparkSession.builder.getOrCreate()
        context.setCheckpointDir(shared_folder(spark))


def crc32(data: bytes) -> int:
    return zlib.crc32(data)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by a path that only Spark may be able to read."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
