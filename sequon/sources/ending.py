"""The end of a finished input, and tables as streams that arrive slice by slice.

A stream that has read all its input still holds what only later rows could settle. A mark,
one row with a time far beyond all others and nothing else, lets the watermark pass every
bound, so that all that is open is given up or matched, as in a table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Later than any row; what arrives after such a mark is late.
END = datetime(9999, 12, 1)


def with_end(stream: DataFrame, folder: str) -> DataFrame:
    """The stream, and the marks that come to ``folder``.

    A mark has no key, so no keyed operator takes it for an event.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(folder)
    # Columns of a file may be null, whatever the stream says.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    return stream.unionByName(spark.readStream.schema(schema).parquet(folder))


def mark_end(spark: SparkSession, folder: str, schema: T.StructType, ts: str, at: datetime = END) -> None:
    """Say that the input has ended: no row of a time before ``at`` will follow."""
    values = [
        (F.lit(at.isoformat(" ")) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    spark.range(1).select(*values).write.mode("append").parquet(folder)


def run_to_end(start: Callable[[], StreamingQuery], end: Callable[[], None]) -> None:
    """Run a query until its input is used up, mark the end, and run it on.

    The mark comes in a run of its own: read along with the first rows it would make all
    later ones late.
    """
    start().awaitTermination()
    end()
    start().awaitTermination()


def replay(df: DataFrame, folder: str, ts: str, slices: int, files: int = 1) -> None:
    """Write a table as it would have arrived: ``files`` files at a time, in the order of
    ``ts``, for ``arriving(..., files_per_batch=files)``.

    Slices have about as many rows each; rows without a time come in the first. They are
    written one after the other, since a stream takes files by age, and each reads only the
    rows of its times.
    """
    at = F.col(ts).cast("timestamp")
    shares = [i / slices for i in range(1, slices)]
    cuts = []
    if shares:
        found = df.agg(F.percentile_approx(F.unix_micros(at), shares).alias("cuts")).first()
        cuts = sorted(set(found["cuts"] or []))
    for i in range(len(cuts) + 1):
        low, high = cuts[i - 1] if i else None, cuts[i] if i < len(cuts) else None
        rows = df if high is None else df.where(at < F.timestamp_micros(F.lit(high)))
        rows = rows if low is None else rows.where(at >= F.timestamp_micros(F.lit(low)))
        if i == 0:
            rows = rows.unionByName(df.where(F.col(ts).isNull())) if cuts else rows
        rows.repartition(files).write.mode("append").parquet(folder)
