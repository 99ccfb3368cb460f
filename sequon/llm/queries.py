"""The operators as queries over whole tables, and the same as SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm import (
    bpe,
    conversations,
    decontaminate,
    language,
    lm,
    main_text,
    negatives,
    quality,
    secret_scan,
    shards,
    simhash,
    toxicity,
    urls,
)
from sequon.llm.common import crc32_text, read, small
from sequon.llm.vocabulary import byte_bpe


#: Labels that may be broadcast: 16 bytes each.
BROADCAST_LABELS = 1_000_000


def _labelled(spark: SparkSession, folder: str, label: str, docs: DataFrame) -> DataFrame:
    """``docs`` with the ``label`` of each id, the largest if there are several; else null."""
    rows = read(spark, folder, "labels").groupBy("doc_id").agg(F.max(label).alias("label"))
    return docs.join(small(rows, BROADCAST_LABELS), "doc_id", "left")


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    assigned = shards.assign(read(spark, folder, "documents").select("doc_id", "text"))
    return assigned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    vocabulary = byte_bpe()
    text = F.coalesce("text", F.lit(""))
    ids = docs.select("doc_id", bpe.encode(spark, text, vocabulary).alias("ids"))
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(bpe.decode(spark, "ids", vocabulary), 256).alias("decoded_sha256"),
    )


def op3_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(read(spark, folder, "pages").select("page_id", "url"), ["page_id"])


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(read(spark, folder, "documents").select("doc_id", "text"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc32_text("doc_id") % 4 == 2, F.lit(False))
    learned = language.learn(docs.where(~held_out).select(F.col("lang").alias("group"), "text"))
    own = docs.select(
        "doc_id",
        held_out.alias("held_out"),
        language.predict(spark, "text", learned).alias("p"),
    )
    return own.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op6_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    target = _labelled(spark, folder, "quality", docs)
    models = lm.learn(target.select((F.col("label") == 1).alias("target"), "text"))
    return lm.scored(docs, models).select(
        "doc_id",
        "s.n_tokens",
        *(F.round(f"s.{c}", 6).alias(c) for c in ("target_loss", "background_loss", "score")),
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality.ledger(read(spark, folder, "documents"))
    failed = F.col("failed")
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes(failed, "base")).alias("base_failed"),
        quality.passes(failed, "v1").alias("kept"),
    )


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, read(spark, folder, "benchmark"), columns=["doc_id"])
    return found.select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("found")).alias("contaminated"),
    )


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, columns=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_candidates",
        F.size("secrets").cast("long").alias("n_secrets"),
        F.sha2(F.array_join("secrets", ","), 256).alias("secrets_sha256"),
        "max_score",
        (F.size("secrets") == 0).alias("clean"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc32_text("doc_id") % 5 == 0, F.lit(False))
    taught = _labelled(spark, folder, "toxic", docs.where(~held_out))
    classifier = toxicity.learn(taught.select("label", "text"))
    scored = docs.select(
        "doc_id",
        held_out.alias("held_out"),
        F.round(toxicity.score(spark, "text", classifier), 6).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector")
    )
    return negatives.mine(rows, F.col("id") % 100 == 0)


def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    text = main_text.extract(spark, "html", main_text.learn(pages))
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = conversations.digests(conversations.repaired(conversations.damaged(rows)))
    # A conversation that lost all its rows is still one.
    ids = rows.select("conv_id", conversations.key("conv_id").alias("key")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(own, "key", "left").select(
        "conv_id",
        *(F.coalesce(f"report.{c}", F.lit(0)).alias(c) for c in counts),
        F.coalesce("report.audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_shards": op1_shards,
    "op2_bpe": op2_bpe,
    "op3_urls": op3_urls,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_lm": op6_lm,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_secrets": op9_secrets,
    "op10_toxicity": op10_toxicity,
    "op11_negatives": op11_negatives,
    "op12_main_text": op12_main_text,
    "op13_conversations": op13_conversations,
}

_OP7 = r"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, doc_id, t, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w,
        [x FOR x IN string_split(t, chr(10)) IF regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> ''] AS l
    FROM t
), p AS (
    SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2
), g AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS c FROM p
), h AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM g WHERE c > 1) GROUP BY r
), m AS (
    SELECT doc_id, len(w) AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(h.n, 0) AS n_repeat_words
    FROM w LEFT JOIN h USING (r)
), b AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines
        OR word_chars > 20 * n_words) AS kept
FROM b
"""

_OP8 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM documents
), b AS (
    SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, [x FOR x IN string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM benchmark
), s AS (
    SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
    FROM b WHERE len(w) > 0
), win AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM s
), lens AS (SELECT DISTINCT n FROM win),
pos AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n
), hit AS (
    SELECT r, item, pos.n, i FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM pos) AS pos
    JOIN win ON win.n = pos.n AND win.g = pos.g
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

_OP11 = r"""
WITH e AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.r, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
        list_dot_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT r, anchor_id, id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS k
    FROM s WHERE same
), n AS (
    SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score,
        s.score AS negative_score,
        row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON s.r = p.r AND NOT s.same
        AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    WHERE p.k <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""

ORACLE_SQL = {"op11_negatives": _OP11, "op7_quality": _OP7, "op8_decontaminate": _OP8}
