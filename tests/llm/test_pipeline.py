"""The pipeline against plain Python, stage by stage."""

import random
import re

import numpy as np
import tiktoken

import corpus_pipeline
import public_tokenizers
from sequon.llm.secret_scan import MASK
from sequon.llm.simhash import simhash
from sequon.llm.vocabulary import byte_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=60):
    own = random.Random(seed)
    return " ".join("".join(own.choices("abcdefgh", k=own.randint(2, 7))) for _ in range(n))


PASSAGE = prose(500, 20)
HEX = random.Random(3)
SECRETS = ["7a" + "".join(HEX.choices("0123456789abcdef", k=38)) for _ in range(20)]


def _texts():
    forms = ['{} token = "{}" {}', "{} TOKEN={} {}"]
    rows = [(None, prose(i)) for i in range(8)] + [(5, prose(20 + i)) for i in range(4)]
    rows += [(i, prose(i)) for i in (100, 101, 102)] + [(None, prose(100)), (99, prose(101)), (5, prose(20))]
    rows += [(200 + i, forms[i % 2].format(prose(200 + i, 40), s, prose(300 + i, 40))) for i, s in enumerate(SECRETS)]
    rows += [(400 + i, f"{prose(400 + i, 60)} {''.join(HEX.choices('0123456789abcdef', k=40))} ab") for i in range(20)]
    rows += [(600, f"{prose(600)} {PASSAGE}"), (None, f"{PASSAGE.upper()}, {prose(601)}")]
    rows += [(602, f"{prose(602, 900)} {' '.join(PASSAGE.split()[:13])}")]
    return rows + [(700, None), (701, ""), (702, prose(702, 20)), (703, "a b c " * 40), (None, None)]


def _good(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, g in enumerate(three) if three.count(g) > 1 for k in range(3)}
    return len(words) >= 50 and 100 * len(again) <= 50 * len(words)


def _one_of_each(rows):
    group = list(range(len(rows)))
    prints = [simhash(t) for _, t in rows]
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    group[i] = min(group[i], group[j])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    first = {}
    for i in order:
        first.setdefault(group[i], rows[i])
    return list(first.values())


def _clean(text):
    own, item = (re.findall("[a-z0-9]+", t.lower()) for t in (text, PASSAGE))
    windows = {tuple(item[i : i + 13]) for i in range(len(item) - 12)}
    hit = {i + k for i in range(len(own) - 12) if tuple(own[i : i + 13]) in windows for k in range(13)}
    return not hit or 20 * len(hit) < len(own)


def _masked(text):
    for secret in SECRETS:
        text = text.replace(secret, MASK)
    return text


def test_pipeline_equals_plain_python(spark, tmp_path):
    rows = _texts()
    table = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(table, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(1, PASSAGE), (None, None)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    steps = [
        lambda own: [r for r in own if _good(r[1])],
        _one_of_each,
        lambda own: [r for r in own if _clean(r[1])],
        lambda own: [(i, _masked(t)) for i, t in own],
    ]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        before = len(rows)
        rows, docs = step(rows), corpus_pipeline.kept(stage(spark, docs, str(tmp_path)))
        found = docs.collect()
        assert sorted(((r.doc_id, r.text) for r in found), key=key) == sorted(rows, key=key), name
        assert all(r.n_chars == len(r.text) for r in found)
        assert len(rows) < before or name == "secret scans"
    other = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe().ranks,
        special_tokens={},
    )
    own = [(i, np.array(other.encode_ordinary(t), "<u4").tobytes()) for i, t in rows]
    out = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, bytes(r.ids)) for r in out), key=key) == sorted(own, key=key)
    whole = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids").collect()
    assert sorted(((r.doc_id, bytes(r.ids)) for r in whole), key=key) == sorted(own, key=key)
