"""Marks alone are no letters."""

from sequon.llm import language
from sequon.llm.ngrams import letters


def test_texts_with_marks_but_no_letter_are_und(spark):
    assert [letters(t) for t in ("❤️", "1 ́", None, "", "❤️ 12")] == [""] * 5
    assert letters("Été ❤️ 1") == " été ️ "
    learned = language.learn(spark.createDataFrame([("x", "abc abd")], "`group` string, text string"))
    docs = spark.createDataFrame([("❤️",), ("abc",)], "text string")
    rows = docs.select(language.predict(spark, "text", learned).alias("p")).collect()
    assert [(r.p.lang, r.p.score) for r in rows] == [("und", 0.0), ("x", 1.0)]
