"""The operators against brute force, round trips and held-out rows, edge cases included."""

import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from sequon.llm import bpe, decontaminate, language, lm, quality, secret_scan, shards, simhash
from sequon.llm import toxicity, urls
from sequon.llm.vocabulary import byte_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, at long"
ODD = [None, "", " \n\t ", "one", "日本語 éé <|endoftext|> x'll 12\n\n a", "ab " * 30_000]


def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, letters="abcdefgh"):
    own = random.Random(seed)
    return " ".join("".join(own.choices(letters, k=own.randint(2, 7))) for _ in range(n))


def test_bpe_equals_tiktoken_and_comes_back(spark):
    vocabulary = byte_bpe()
    assert sorted(map(vocabulary.hash.slot, vocabulary.ranks)) == list(range(len(vocabulary.ranks)))
    other = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=vocabulary.ranks,
        special_tokens={},
    )
    ids = docs(spark, ODD + [prose(1, 500)]).select(
        "text", bpe.encode(spark, "text", vocabulary).alias("ids")
    )
    rows = ids.select("*", bpe.decode(spark, "ids", vocabulary).alias("back")).collect()
    for r in rows:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert own == other.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()


@pytest.mark.parametrize("radius", [0, 2])
def test_components_equal_brute_force(spark, radius):
    own = random.Random(3)
    fps = [own.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for _ in range(120):
        fps.append(own.choice(fps) ^ (1 << own.randrange(64)) ^ (1 << own.randrange(64)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.classes(frame, radius).collect()}
    least = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= radius:
                    least[i] = min(least[i], least[j])
        if all(found[s] == m for s, m in zip(signed, least)):
            break
    assert [found[s] for s in signed] == least


def test_near_copies_of_odd_texts(spark):
    rows = simhash.near_copies(docs(spark, ODD + ODD)).collect()
    assert len(rows) == 2 * len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == "0" * 16 and by_id[1].component_id == 0
    assert all(by_id[i].component_id == by_id[i + len(ODD)].component_id for i in range(len(ODD)))
    left = simhash.one_of_each(docs(spark, ODD + ODD))
    assert left.columns == docs(spark, []).columns
    assert {r.doc_id for r in left.collect()} == {r.component_id for r in rows}
    assert simhash.near_copies(docs(spark, [])).count() == 0


def test_ledger(spark):
    table = docs(spark, ODD + ["a b c a b c\na b c a b c", prose(2, 80)])
    rows = {r.doc_id: r for r in quality.ledger(table).collect()}
    assert (rows[0].n_words, rows[6].n_repeat_words, rows[6].n_dup_lines) == (0, 12, 1)
    kept = {r.doc_id for r in quality.keep(table, "v1").collect()}
    assert kept == {7}
    lost = {r.rule: r.n_only for r in quality.ablation(quality.ledger(table), "v1").collect()}
    # The fifth text also has four symbols among six words.
    assert lost["few_words"] == 4


def _hits(text, items):
    import re

    split = lambda t: [
        w
        for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        if w
    ]
    own, hit, names = split(text), set(), set()
    for name, item in items:
        item = split(item)
        n = min(13, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(own), len(hit), sorted(names)


def test_decontamination_equals_brute_force(spark):
    passage = prose(5, 40)
    items = [(1, passage), (2, "Short item"), (10, None), (3, "a a a " * 9), (3, "a a a " * 9)]
    texts = [
        *ODD,
        prose(6, 30) + " " + passage + " " + passage.upper(),
        " ".join(passage.split()[:13]),
        " ".join(passage.split()[:12]),
        "short, item! " * 4,
        "a " * 40,
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.search(docs(spark, texts), benchmark).collect()
    for r in found:
        own = r.found
        assert (own.n_words, own.n_hit, own["items"]) == _hits(texts[r.row.doc_id], items)
    none = decontaminate.search(docs(spark, texts), benchmark.limit(0)).collect()
    assert all(r.found.n_hit == 0 for r in none) and len(none) == len(texts)
    assert decontaminate.search(docs(spark, []), benchmark).count() == 0


def test_secrets_are_masked_and_the_rest_stays(spark):
    own = random.Random(8)
    value = lambda: "".join(own.choices("0123456789abcdef", k=40))
    secrets = [value() for _ in range(30)]
    texts = [f'{prose(i, 9)} token = "{s}" {prose(i + 99, 9)}' for i, s in enumerate(secrets)]
    texts += [f"{prose(i, 9)} {own.randrange(10**15, 10**16)} {prose(i, 3)}" for i in range(60)]
    table = docs(spark, texts + ODD)
    out = {r.doc_id: r for r in secret_scan.redact(table).collect()}
    assert len(out) == len(texts) + len(ODD)
    assert all(s not in out[i].text and secret_scan.MASK in out[i].text for i, s in enumerate(secrets))
    assert all(out[i].text == texts[i] for i in range(30, 90))
    assert secret_scan.redact(docs(spark, [])).count() == 0


def test_shards_are_whole_and_near_equal(spark):
    texts = [prose(i, 40) for i in range(800)] + ["copy " * 40] * 400 + ODD[:5]
    rows = shards.assign(docs(spark, texts), 10).toPandas()
    assert sorted(rows["doc_id"]) == list(range(len(texts)))
    sums = rows.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 2 * rows["size"].max()
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert shards.assign(docs(spark, [])).count() == 0


def test_urls(spark):
    given = [f"http://a{i}.example.org/fr/{i}" for i in range(20)]
    given += [f"http://a{i}.bad.net/x/{i}" for i in range(20)]
    given += [None, "no host", "HTTP://X.Example.NET/en/1?a#b", "http://c.bad.com/x/7", "http://"]
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    rows = {r.page_id: r for r in urls.judge(pages, ["page_id"]).collect()}
    assert rows[40].host == rows[41].path == "" and rows[40].verdict == "allow"
    assert (rows[42].rule, rows[42].host) == ("example.net/en/", "x.example.net")
    # Mined: host part "bad" means block.
    assert (rows[43].rule, rows[43].verdict) == (None, "block")
    assert urls.judge(pages.limit(0), ["page_id"]).count() == 0


def test_languages(spark):
    rows = [(k, prose(i, 80, c)) for i in range(20) for k, c in (("x", "abcde"), ("y", "fghij"))]
    learned = language.learn(spark.createDataFrame(rows, "`group` string, text string"))
    shares = learned.shares(prose(77, 60, "abcde") + " " + prose(78, 60, "fghij"))
    assert set(shares) == {"x", "y"} and abs(shares["x"] - 0.5) < 0.15
    own = docs(spark, [prose(79, 50, "fghij"), *ODD[:3], "12 34"])
    found = own.select("doc_id", language.predict(spark, "text", learned).alias("p")).collect()
    assert [r.p.lang for r in found] == ["y", "und", "und", "und", "und"]


def test_language_model_prefers_its_target(spark):
    rows = [(i % 2 == 0, prose(i, 60, "abcde" if i % 2 == 0 else "fghij")) for i in range(40)]
    models = lm.learn(spark.createDataFrame(rows, "target boolean, text string"))
    own = docs(spark, [prose(90, 50, "abcde"), prose(91, 50, "fghij"), *ODD])
    found = own.select(lm.score(spark, "text", models).alias("s")).collect()
    assert found[0].s.score > 0 > found[1].s.score and found[2].s.score == 0
    assert lm.learn(spark.createDataFrame([], "target boolean, text string")) is None


def test_toxicity_on_held_out_rows(spark):
    bad = lambda i: prose(i, 30) + " vile rotten " + prose(i + 500, 30)
    rows = [(int(i % 4 == 0), bad(i) if i % 4 == 0 else prose(i, 60)) for i in range(200)]
    learned = toxicity.learn(spark.createDataFrame(rows, "label int, text string"))
    own = docs(spark, [bad(900), prose(901, 60), *ODD])
    scores = [r.s for r in own.select(toxicity.score(spark, "text", learned).alias("s")).collect()]
    assert scores[0] > 0.5 > scores[1] and all(0 <= s <= 1 for s in scores)


def test_toxicity_takes_apart_chosen_texts_only(spark, monkeypatch):
    """What is written and shuffled for the fit follows the texts chosen, not all labelled ones."""
    texts = [f"word{i} some plain line {i % 7} of text" if i % 2 else f"vile{i} rotten insult {i % 5}" for i in range(400)]
    rows = [(1 - i % 2, text) for i, text in enumerate(texts)] * 2 + [(0, None), (0, None), (None, "none")]
    known = spark.createDataFrame(rows, "label int, text string").repartition(6)
    written, keep = [], toxicity.kept
    monkeypatch.setattr(toxicity, "kept", lambda df: written.append(keep(df)) or written[-1])
    telling = np.ones(1 << toxicity.BITS, dtype=bool)
    found = toxicity._sampled(known.where("label is not null"), telling, 5)
    assert [df.columns for df in written] == [["label", "h"]] and written[0].count() == 10
    distinct = known.where("label is not null").distinct().selectExpr("label", "xxhash64(text) h", "text")
    expected = []
    for label in (0, 1):
        own = sorted((r.h, r.text) for r in distinct.collect() if r.label == label)[:5]
        expected += [(label, h, list(toxicity.present(text))) for h, text in own]
    assert [(r.label, r.h, list(r.grams)) for r in found.itertuples()] == expected
