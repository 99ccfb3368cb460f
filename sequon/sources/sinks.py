"""Where results go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Put the name of the output in front of each row."""
    return df.select(F.lit(label).alias("label"), *df.columns)


def _print(df: DataFrame, rows: int | None) -> None:
    shown = df if rows is None else df.limit(rows)
    # One partition at a time comes to the driver, so a long output is never held whole.
    for row in shown.toLocalIterator():
        print(*("null" if value is None else value for value in row), sep="\t")


def to_console(df: DataFrame, label: str, rows: int | None = None) -> StreamingQuery | None:
    """Print every row under a label, or the first ``rows`` of a table or micro-batch.

    Starts a query if ``df`` is a stream.
    """
    df = labelled(df, label)
    if df.isStreaming:
        return df.writeStream.foreachBatch(lambda batch, _: _print(batch, rows)).start()
    _print(df, rows)
    return None


def write_outputs(
    df: DataFrame,
    path: str,
    checkpoint: str | None = None,
    by: str = "status",
    mode: str = "errorifexists",
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """Write each output to a folder of its own, ``path/status=...``, in one pass.

    ``mode`` says what becomes of a folder that a table finds there. A stream is written by
    the file sink, whose log keeps output exactly once across restarts, and so needs a
    ``checkpoint``. It runs until the input at hand is used up, or as ``trigger`` says:
    ``{"processingTime": "1 minute"}`` keeps it running.
    """
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder")
        return (
            df.writeStream.format("parquet")
            .partitionBy(by)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    df.write.partitionBy(by).mode(mode).parquet(path)
    return None


def read_output(spark: SparkSession, path: str, value: str, by: str = "status") -> DataFrame:
    """One output written by :func:`write_outputs`; reads its folder only."""
    return spark.read.parquet(path).where(F.col(by) == value).drop(by)
