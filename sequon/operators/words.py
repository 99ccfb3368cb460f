"""Word frequency over text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """Words between white space and how often each occurs.

    Counts are summed before the shuffle, so a frequent word travels once per task.
    """
    words = df.select(F.explode(F.split(text, r"\s+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
