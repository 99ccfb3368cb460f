"""Secrets that are rare among candidates."""

import random

from pyspark.sql import functions as F

from sequon.llm import secret_scan
from sequon.llm.common import crc32_text

SCHEMA = "candidate string, before string, before2 string, after string, label int"


def test_rare_secrets_are_learned_from_any_number_of_findings(spark):
    own = random.Random(4)
    value = lambda n: "".join(own.choices("0123456789abcdef", k=n))
    clean = [(value(own.randint(16, 60)), "word", "other", "next", 0) for _ in range(21_000)]
    found = spark.createDataFrame(clean, SCHEMA)
    # Behind the first 20,000 findings by crc32, where a sample would not reach them.
    late = spark.createDataFrame([(value(40), "=", "token", "x", 1) for _ in range(3_000)], SCHEMA)
    late = late.orderBy(crc32_text("candidate").desc()).limit(5)
    scanner = secret_scan.train(found.union(late), [])
    fresh = [(value(40), "=", "token", "x", 1) for _ in range(20)] + clean[:20]
    scored = scanner.score(spark.createDataFrame(fresh, SCHEMA))
    rows = scored.select("label", (F.col("score") >= 0.5).alias("secret")).collect()
    assert all(r.secret == bool(r.label) for r in rows)


def _found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "at long, text string")
    rows = secret_scan.candidates(docs)
    out = {i: {} for i in range(len(texts))}
    for r in rows.withColumn("label", secret_scan.assigned(rows)).collect():
        out[r.at][r.candidate] = r.label
    return out


def test_candidates_are_values_without_their_names(spark):
    value, issued = "04db9c1e22f7a6b35d80", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    given = {
        f"TOKEN={value}": {value: 1},
        f"a export API_KEY={issued} b": {issued: 1},
        f"x={issued}&id={value}": {issued: 1, value: 0},
        f'{{"token":"{value}","password":"hunter2x"}}': {value: 1, "hunter2x": 1},
        "password = hunter2, and": {"hunter2": 1},
        "the password: 'p@ss-w0rd!x'.": {"p@ss-w0rd!x": 1},
        "password =hunter2": {"hunter2": 1},
        "password = correcthorsebattery": {"correcthorsebattery": None},
        "password=letmein": {"letmein": None},
        f"MY_VERY_LONG_SECRET_2={value}==": {f"{value}==": 1},
        f"plain {value} words: short1 and = this9": {value: 0},
        f'token = "{value}"': {value: 1},
        "日本語" * 20_000 + "=" + "a" * 60_000 + "=b": {},
    }
    found = _found(spark, list(given))
    assert [found[i] for i in range(len(given))] == list(given.values())


def test_assigned_secrets_of_every_form_are_masked(spark):
    own = random.Random(9)
    value = lambda n: "".join(own.choices("abcdef", k=2) + own.choices("0123456789abcdef", k=n - 2))
    forms = ['TOKEN={}', 'export KEY={}', 'password = {}', 'password: "{}"', 'token="{}"']
    rows, secrets = [], []
    for i in range(100):
        secrets.append("7" + value(own.choice([8, 12, 40])))
        rows.append((i, f"some words {forms[i % 5].format(secrets[-1])} and more words", "en", 1))
    rows += [(100 + i, f"some words {value(40)} and id={value(30)}", "en", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert not [s for i, s in enumerate(secrets) if s in out[i]]
    assert all(out[i] == text for i, text, *_ in rows[100:])
    texts = spark.createDataFrame([("a key1 key12 =key1.", ["key1"])], "t string, s array<string>")
    masked = texts.select(secret_scan.masked(F.col("t"), F.col("s"))).first()[0]
    assert masked == "a [SECRET] key12 =[SECRET]."
