"""The main text of web pages, by gradient-boosted trees over the nodes of their trees.

Trees judge every element and every run of text by the text below it and its density, links
and sentences, attribute tokens, depth and siblings. Decoding then picks the set of nodes with
the greatest sum of log odds in which every kept node stands in a kept one.

No page comes with labels, so the trees learn from pages whose text is known: pages of the
table that mark their article themselves, and made-up pages in many layouts that are filled
with texts of those. Both are bounded: ``SAMPLE`` and ``LAYOUTS``. Every page is judged, whole.

A null or empty page has no text. Repeated pages are judged each on its own. Where the table
has no marked page, layouts are filled with spare words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm.common import kept
from sequon.llm.dom import Page, TokenOdds, decoded, measured, parsed, said, words_said
from sequon.llm.layouts import MARK, Layout

#: Pages of the table to learn from, none longer than so many characters.
SAMPLE, SAMPLE_CHARS = 400, 200_000
#: Made-up pages to learn from, and texts to fill them with.
LAYOUTS, TEXTS = 2_000, 2_000
#: Tokens known by name; those of fewer nodes say nothing.
TOKENS, LEAST_NODES = 4_000, 5
TREES, DEPTH = 30, 5
#: Partitions of the nodes to learn from.
PARTS = 8
#: Characters of pages that a task holds parsed.
_CHUNK = 4_000_000

_MARKED = {"<article>", "<main>"}
_NOT_MAIN = {
    "<nav>", "<aside>", "<footer>", "<form>", "ad", "ads", "advert", "sponsored", "comments",
    "comment", "share", "social", "related", "newsletter", "cookie", "notice", "menu", "sidebar",
}


def marked_by_itself(page: Page) -> list[bool] | None:
    """Which nodes hold main text, if one element of the page says that it is the article."""
    own = [i for i, t in enumerate(page.tokens) if t and t[0] in _MARKED]
    if len(own) != 1:
        return None
    main = [False] * len(page.tag)
    out = page.end[own[0]]
    i = own[0]
    while i < out:
        if i != own[0] and _NOT_MAIN & set(page.tokens[i]):
            i = page.end[i]
            continue
        main[i] = page.run[i] is not None
        i += 1
    return _upwards(page, main)


def marked_by_sign(page: Page) -> list[bool]:
    """Which nodes of a made-up page hold main text; takes the marks off."""
    main = [r is not None and MARK in r for r in page.run]
    page.run = [r.replace(MARK, "") if m else r for r, m in zip(page.run, main)]
    return _upwards(page, main)


def _upwards(page: Page, main: list[bool]) -> list[bool]:
    for i in range(len(main) - 1, 0, -1):
        if main[i]:
            main[page.parent[i]] = True
    return main


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Page, list[bool]]]:
    for batch in batches:
        for row in batch.to_pylist():
            page = parsed(row["html"])
            main = marked_by_sign(page) if row["made_up"] else marked_by_itself(page)
            if main is not None:
                yield page, main


def examples(pages: DataFrame, html: str = "html") -> DataFrame:
    """(html, made_up): pages to learn from."""
    spark = pages.sparkSession
    own = (
        pages.select(F.col(html).alias("html"))
        .where((F.length("html") > 0) & (F.length("html") <= SAMPLE_CHARS))
        .withColumn("h", F.xxhash64("html"))
        .orderBy("h", "html")
        .limit(SAMPLE)
        .select("html", F.lit(False).alias("made_up"))
    )
    own = kept(own)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page, main in _taught(batches):
            runs = [(r, m) for r, m in zip(page.run, main) if r is not None]
            yield pa.RecordBatch.from_pydict(
                {"text": [r for r, _ in runs], "main": [m for _, m in runs]},
                pa.schema([("text", pa.string()), ("main", pa.bool_())]),
            )

    found = own.mapInArrow(texts, "text string, main boolean").distinct()
    found = found.withColumn("h", F.xxhash64("text"))
    pools = [
        [r.text for r in found.where("main" if m else "not main").orderBy("h", "text").limit(TEXTS).collect()]
        for m in (True, False)
    ]
    sent = spark.sparkContext.broadcast(pools)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column(0).to_pylist()
            pages = [Layout(s, *sent.value).page() for s in seeds]
            yield pa.RecordBatch.from_pydict({"html": pages, "made_up": [True] * len(pages)})

    seeds = spark.range(0, LAYOUTS, 1, 8)
    return kept(own.unionByName(seeds.mapInArrow(made, "html string, made_up boolean")))


class Extractor:
    """Trees as arrays, and odds of tokens; built by :func:`learn`."""

    def __init__(self, odds: TokenOdds, trees: list[tuple[np.ndarray, ...]]):
        self.odds, self.trees = odds, trees

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, limit, left, right, value in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                goes = rows[every, feature[at]] <= limit[at]
                # A leaf leads to itself.
                at = np.where(goes, left[at], right[at])
            total += value[at]
        return 2 * total

    def runs(self, pages: list[Page]) -> list[list[str]]:
        """The runs of main text of each page, in page order."""
        odds, begin, out = self.log_odds(measured(pages, self.odds)), 0, []
        for page in pages:
            end = begin + len(page.tag)
            keeps = decoded(page, odds[begin:end])
            out.append([r for r, k in zip(page.run, keeps) if k and r is not None])
            begin = end
        return out


def learn(pages: DataFrame, html: str = "html") -> Extractor:
    taught = examples(pages, html)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page, main in _taught(batches):
            rows = [
                (t, m)
                for own, run, m in zip(page.tokens, page.run, main)
                # A word that prose has as well says little where it stands alone.
                for t in (own or (words_said(run or "") if m else said(run)))
            ]
            yield pa.RecordBatch.from_pydict(
                {"token": [t for t, _ in rows], "main": [m for _, m in rows]},
                pa.schema([("token", pa.string()), ("main", pa.bool_())]),
            )

    counts = (
        taught.mapInArrow(tokens, "token string, main boolean")
        .groupBy("token")
        .agg(F.count("*").alias("n"), F.count_if("main").alias("main"))
        .where(F.col("n") >= LEAST_NODES)
    )
    common = counts.orderBy(F.desc("n"), "token").limit(TOKENS).collect()
    odds = TokenOdds({r.token: float(np.log((r.main + 1) / (r.n - r.main + 1))) for r in common})
    sent = taught.sparkSession.sparkContext.broadcast(odds)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for page, main in _taught(batches):
            rows = measured([page], sent.value)[1:]
            yield pa.RecordBatch.from_pydict(
                {"f": list(rows), "label": [float(m) for m in main[1:]]},
                pa.schema([("f", pa.list_(pa.float64())), ("label", pa.float64())]),
            )

    rows = kept(taught.mapInArrow(nodes, "f array<double>, label double"))
    # Order decides which values a split is tried at, so it follows from the rows. They are
    # few, whatever the table; each partition sends its histograms at every level of a tree.
    ordered = rows.repartitionByRange(PARTS, "f", "label").sortWithinPartitions("f", "label")
    ordered = ordered.coalesce(PARTS)
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.25, minInstancesPerNode=5, seed=7, labelCol="label"
    ).fit(ordered.select(array_to_vector("f").alias("features"), "label"))
    return Extractor(odds, _arrays(trees))


_LINE = re.compile(r"(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)|Predict: (\S+)")


def _arrays(model: GBTClassificationModel) -> list[tuple[np.ndarray, ...]]:
    """(feature, limit, left, right, value) of each tree, weights worked in."""
    out = []
    for tree, weight in zip(model.trees, model.treeWeights):
        feature, limit, left, right, value = [], [], [], [], []

        def node(lines: Iterator[re.Match]) -> int:
            match, here = next(lines), len(feature)
            leaf = match[4] is not None
            feature.append(0 if leaf else int(match[2]))
            limit.append(0.0 if leaf else float(match[3]))
            value.append(weight * float(match[4]) if leaf else 0.0)
            left.append(here)
            right.append(here)
            if not leaf:
                left[here] = node(lines)
                next(lines)
                right[here] = node(lines)
            return here

        node(_LINE.finditer(tree.toDebugString))
        out.append(tuple(map(np.array, (feature, limit, left, right, value))))
    return out


def extract(spark: SparkSession, html: str | Column, extractor: Extractor) -> Column:
    """The main text of each page, its blocks joined by one blank."""
    sent = spark.sparkContext.broadcast(extractor)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for batch in batches:
            texts: list[str] = []
            held: list[Page] = []
            size = 0
            for page in batch:
                page = page.as_py() or ""
                held.append(parsed(page))
                size += len(page)
                if size >= _CHUNK:
                    texts += map(" ".join, own.runs(held))
                    held, size = [], 0
            texts += map(" ".join, own.runs(held))
            yield pa.array(texts, pa.string())

    return run(html)

