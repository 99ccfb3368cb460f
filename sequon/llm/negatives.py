"""Hard negatives by angular triangle filtering.

Vectors are scaled and floored to whole numbers; a score is their inner product, exact. Each
row stores its norm and its angles to a few reference directions. Between two rows, angles a
and x to one reference leave an angle from \\|a - x\\| to a + x, so a cosine from cos(a + x) to
cos(a - x); times both norms, and rounded outwards, that bounds the score. Only rows whose
bounds overlap what an anchor still looks for are scored.

Rows lie in tiles, ordered by the reference next to them and the angle to it. Tiles are dealt
to groups; a task holds the tiles of one group and streams all anchors past them, in blocks.
What it sends on is the best few rows per anchor. References come from a bounded sample and
decide how many rows are scored, never the result.

Rows with a null id, label, vector or component, or a component that is not finite, take no
part. A score beyond 64 bits is an error. Shorter vectors count as padded by zeros. Rows of an anchor's own id are not its
partners. A repeated row is a row of its own, so its id may come twice, and as an anchor its
rows come twice. Equal scores are ordered by id. An empty table has no negatives. Other
columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequon.llm.common import kept

#: Reference directions, and the rows they are chosen from.
REFERENCES, SAMPLE = 8, 512
#: Rows in a tile, anchors in a block, tiles that one task holds.
TILE, BLOCK, GROUP_TILES = 2_048, 512, 64
#: Added to a cosine before it is rounded outwards: far above the error of stored angles.
_SLACK = 1e-6
#: Sums below are exact as doubles.
_EXACT = 2**52
#: Scored pair by pair if fewer than one in this many pairs of a tile overlap.
_SPARSE = 16

_ROW = "row long, id long, label long, vector binary, near int, angle double"
_COLUMNS = ("ids", "rows", "labels", "vectors", "norms", "angles", "aims")
_PACK = "place long, " + ", ".join(f"{c} binary" for c in _COLUMNS)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has ``id``, ``label`` and ``vector``; ``anchor`` says which rows are anchors. An
    anchor's positives are the best rows of its label; for each of them, negatives are the
    best rows of other labels that score from ``low`` to ``high`` per cent of the positive.
    """
    spark = rows.sparkSession
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = kept(
        rows.select("id", F.col("label").cast("long").alias("label"), "vector", anchor.alias("anchor"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("id").cast("long").alias("id"),
            "label",
            whole.alias("vector"),
            F.coalesce("anchor", F.lit(False)).alias("anchor"),
        )
    )
    most = F.array_max(F.transform("vector", F.abs))
    size = own.agg(
        F.count("*").alias("n"),
        F.count_if("anchor").alias("anchors"),
        F.max(F.size("vector")).alias("dim"),
        F.max(most).alias("most"),
    ).first()
    shape = _Shape(size.dim or 1, size.most or 0, _references(own, size.dim or 1))
    stored = kept(own.select("row", "id", "label", "vector", "anchor").mapInArrow(shape.store, f"{_ROW}, anchor boolean"))

    tiles = _gathered(stored.drop("anchor"), shape, size.n, TILE)
    n_tiles = -(-size.n // TILE)
    cores = spark.sparkContext.defaultParallelism
    groups = max(1, min(n_tiles, max(2 * cores, n_tiles // GROUP_TILES)))
    tiles = tiles.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups)).cast("int"))

    anchors = stored.where("anchor").drop("anchor")
    blocks = _gathered(anchors, shape, size.anchors, BLOCK)
    best = _met(tiles, blocks, groups, lambda pair: shape.positives(pair, positives))
    ordered = F.slice(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), F.col("id")))), 1, positives
    )
    per_anchor = best.groupBy("row").agg(ordered.alias("found"))
    aimed = anchors.join(
        per_anchor.select(
            "row",
            _packed(F.transform("found", lambda p: -p["down"])).alias("aims"),
            F.transform("found", lambda p: F.struct(p["id"].alias("id"), (-p["down"]).alias("score"))).alias("found"),
        ),
        "row",
    )
    aimed = kept(aimed)
    blocks = _gathered(aimed.drop("found"), shape, size.anchors, BLOCK)
    rest = _met(tiles, blocks, groups, lambda pair: shape.negatives(pair, negatives, low, high))
    ranked = F.slice(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), F.col("id")))), 1, negatives
    )
    per_positive = rest.groupBy("row", "aim").agg(ranked.alias("found"))
    listed = aimed.select("row", F.col("id").alias("anchor_id"), F.posexplode("found").alias("aim", "positive"))
    return (
        listed.join(per_positive, ["row", "aim"])
        .select("anchor_id", "positive", F.posexplode("found").alias("place", "negative"))
        .select(
            "anchor_id",
            F.col("positive.id").alias("positive_id"),
            (F.col("place") + 1).alias("rank"),
            F.col("negative.id").alias("negative_id"),
            F.col("positive.score").alias("positive_score"),
            (-F.col("negative.down")).alias("negative_score"),
        )
    )


def _packed(numbers: Column) -> Column:
    """Whole numbers as the bytes of 64-bit integers."""

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([np.array(x, dtype="<i8").tobytes() for x in lists.to_pylist()], pa.binary())

    return run(numbers)


def _gathered(rows: DataFrame, shape: _Shape, n: int, most: int) -> DataFrame:
    """``n`` rows in tiles of ``most``, each of rows at like angles to one reference."""
    # Ties of a very common vector are broken by id, so that it fills many tiles.
    order = ["near", "angle", "id", "row"]
    dealt = rows.repartitionByRange(max(1, -(-n // (4 * most))), *order).sortWithinPartitions(*order)
    return kept(dealt.mapInArrow(lambda batches: shape.pack(batches, most), _PACK))


def _met(tiles: DataFrame, blocks: DataFrame, groups: int, work) -> DataFrame:
    """``work`` on all anchors and the tiles of each group: (row, aim, id, score)."""
    everywhere = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    both = tiles.withColumn("kind", F.lit(0)).unionByName(everywhere.withColumn("kind", F.lit(1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["group"] != group:
                    group, held = row["group"], []
                if row["kind"] == 0:
                    held.append(row)
                elif held:
                    yield from work((row, held))

    # As many partitions as groups, told outright: small ones must not be put together.
    dealt = both.repartition(groups, "group").sortWithinPartitions("group", "kind", "place")
    return dealt.mapInArrow(run, "row long, aim int, id long, score long")


def _references(rows: DataFrame, dim: int) -> np.ndarray:
    """Directions of sampled rows, each as far as can be from those before it."""
    sample = rows.select("vector", F.xxhash64("id", "row").alias("h")).orderBy("h").limit(SAMPLE)
    vectors = _matrix([r.vector for r in sample.collect()], dim).astype(float)
    vectors = vectors[np.abs(vectors).sum(axis=1) > 0]
    if not len(vectors):
        return np.eye(1, dim)
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _matrix(lists: list, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim), dtype=np.int64)
    for i, own in enumerate(lists):
        out[i, : len(own)] = own
    return out


class _Shape:
    """How vectors are stored and compared; goes to every task."""

    def __init__(self, dim: int, most: int, references: np.ndarray):
        self.dim, self.references = dim, references
        self.kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
        self.exact = dim * most * most < _EXACT
        self.fits = dim * most * most < 2**63

    def store(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their vectors packed, the nearest reference and the angle to it."""
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("vector")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            if (lengths == self.dim).all():
                vectors = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, self.dim)
            else:
                vectors = _matrix(lists.to_pylist(), self.dim)
            _, angles = self.angles(vectors)
            near = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([v.tobytes() for v in vectors.astype(self.kind)], pa.binary()),
                    pa.array(near.astype(np.int32)),
                    pa.array(angles[np.arange(len(near)), near]),
                    batch.column("anchor"),
                ],
                ["row", "id", "label", "vector", "near", "angle", "anchor"],
            )

    def angles(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Norms, and angles to the references; a zero vector is at right angles to all."""
        own = vectors.astype(float)
        norms = np.linalg.norm(own, axis=1)
        unit = own / np.where(norms > 0, norms, 1)[:, None]
        return norms, np.arccos(np.clip(unit @ self.references.T, -1, 1))

    def pack(self, batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        """Rows gathered ``most`` at a time into one."""
        from pyspark import TaskContext

        part, place, held = TaskContext.get().partitionId(), 0, []

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            column = {n: table.column(n).combine_chunks() for n in table.column_names}
            aims = column["aims"].to_pylist() if "aims" in column else []
            vectors = b"".join(column["vector"].to_pylist())
            norms, angles = self.angles(np.frombuffer(vectors, self.kind).reshape(-1, self.dim))
            one = dict(
                place=(part << 32) + place,
                ids=column["id"].to_numpy().astype("<i8").tobytes(),
                rows=column["row"].to_numpy().astype("<i8").tobytes(),
                labels=column["label"].to_numpy().astype("<i8").tobytes(),
                vectors=vectors,
                norms=norms.tobytes(),
                angles=angles.tobytes(),
                # Length of each list of aims, then all of them.
                aims=b"".join(
                    [np.array([len(a or b"") // 8 for a in aims], dtype="<i8").tobytes(), *(a or b"" for a in aims)]
                ),
            )
            return pa.RecordBatch.from_pylist([one], _PACKED)

        count = 0
        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, most - count)
                held.append(take)
                count += take.num_rows
                batch = batch.slice(take.num_rows)
                if count == most:
                    yield packed()
                    place, held, count = place + 1, [], 0
        if count:
            yield packed()

    def _side(self, packed: dict) -> _Side:
        ids, rows, labels = (np.frombuffer(packed[n], "<i8") for n in ("ids", "rows", "labels"))
        vectors = np.frombuffer(packed["vectors"], self.kind).reshape(-1, self.dim)
        norms = np.frombuffer(packed["norms"])
        angles = np.frombuffer(packed["angles"]).reshape(len(norms), -1)
        return _Side(ids, rows, labels, vectors, norms, angles, packed["aims"])

    def _scores(self, a: _Side, x: _Side, pairs: np.ndarray) -> np.ndarray:
        """Integer scores where ``pairs`` holds; anything elsewhere."""
        left, right = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
        scores = np.zeros(pairs.shape, dtype=np.int64)
        if not len(left):
            return scores
        if self.exact:
            kind = float
        elif self.fits:
            kind = np.int64
        else:
            kind = object
        i, j = np.nonzero(pairs)
        if len(i) * _SPARSE < len(left) * len(right) or kind is object:
            for begin in range(0, len(i), 1 << 16):
                at, to = i[begin : begin + (1 << 16)], j[begin : begin + (1 << 16)]
                scores[at, to] = (a.vectors[at].astype(kind) * x.vectors[to].astype(kind)).sum(axis=1)
        else:
            scores[np.ix_(left, right)] = a.vectors[left].astype(kind) @ x.vectors[right].astype(kind).T
        return scores

    def positives(self, pair: tuple[dict, list[dict]], most: int) -> Iterator[pa.RecordBatch]:
        anchors = self._side(pair[0])
        best = _Best(len(anchors.ids), most)
        for packed in pair[1]:
            tile = self._side(packed)
            for label in np.intersect1d(anchors.labels, tile.labels):
                own = np.flatnonzero(anchors.labels == label)
                x = tile.of(np.flatnonzero(tile.labels == label))
                own = own[anchors.of(own).most_with(x) >= best.least[own]]
                if not len(own):
                    continue
                a = anchors.of(own)
                _, upper = a.bounds(x)
                # The least score that still counts, a tie with a smaller id included.
                pairs = (upper >= best.least[own][:, None]) & (x.ids[None, :] != a.ids[:, None])
                scores = self._scores(a, x, pairs)
                for k in np.flatnonzero(pairs.any(axis=1)):
                    best.add(own[k], x.ids[pairs[k]], scores[k, pairs[k]])
        yield from best.batches(anchors.rows)

    def negatives(
        self, pair: tuple[dict, list[dict]], most: int, low: int, high: int
    ) -> Iterator[pa.RecordBatch]:
        anchors = self._side(pair[0])
        which, aims = anchors.windows()
        # From low to high per cent, in whole numbers; none for a negative score.
        floor = np.array([-(-low * s // 100) for s in aims], dtype=np.int64)
        ceiling = np.array([high * s // 100 for s in aims], dtype=np.int64)
        best = _Best(len(which), most)
        n = len(anchors.ids)
        for packed in pair[1]:
            x = self._side(packed)
            wanted = np.maximum(floor, best.least)
            open_still = wanted <= ceiling
            least, largest = np.full(n, np.inf), np.full(n, -np.inf)
            np.minimum.at(least, which[open_still], wanted[open_still].astype(float))
            np.maximum.at(largest, which[open_still], ceiling[open_still].astype(float))
            own = np.flatnonzero((least <= largest) & (anchors.most_with(x) >= least))
            if not len(own):
                continue
            a = anchors.of(own)
            lower, upper = a.bounds(x)
            pairs = (upper >= least[own][:, None]) & (lower <= largest[own][:, None])
            pairs &= x.labels[None, :] != a.labels[:, None]
            scores = self._scores(a, x, pairs)
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            for w in np.flatnonzero(open_still):
                k = place[which[w]]
                if k >= 0:
                    inside = pairs[k] & (scores[k] >= wanted[w]) & (scores[k] <= ceiling[w])
                    if inside.any():
                        best.add(w, x.ids[inside], scores[k, inside])
        first = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1]) if len(which) else which
        starts = np.zeros(len(which), dtype=int)
        starts[first] = first
        aim = np.arange(len(which)) - np.maximum.accumulate(starts) if len(which) else which
        yield from best.batches(anchors.rows[which], aim)


class _Side:
    """Rows of a tile or of a block of anchors."""

    def __init__(self, ids, rows, labels, vectors, norms, angles, aims=b""):
        self.ids, self.rows, self.labels, self.vectors = ids, rows, labels, vectors
        self.norms, self.angles, self.aims = norms, angles, aims

    def of(self, at: np.ndarray) -> _Side:
        return _Side(
            self.ids[at], self.rows[at], self.labels[at], self.vectors[at], self.norms[at], self.angles[at]
        )

    def windows(self) -> tuple[np.ndarray, list[int]]:
        """The anchor of each aim, and the aims, positive scores or zero."""
        numbers = np.frombuffer(self.aims, "<i8")
        n = len(self.ids)
        return np.repeat(np.arange(n), numbers[:n]), [int(s) for s in numbers[n:]]

    def bounds(self, other: _Side) -> tuple[np.ndarray, np.ndarray]:
        """What each score is at least and at most."""
        norms = self.norms[:, None] * other.norms[None, :]
        lower, upper = np.full(norms.shape, -1.0), np.full(norms.shape, 1.0)
        # cos(a + x) and cos(a - x), which is all of the triangle rule up to two right angles.
        cosines = np.cos(self.angles), np.cos(other.angles)
        sines = np.sin(self.angles), np.sin(other.angles)
        for k in range(self.angles.shape[1]):
            along = np.outer(cosines[0][:, k], cosines[1][:, k])
            across = np.outer(sines[0][:, k], sines[1][:, k])
            np.maximum(lower, along - across, out=lower)
            np.minimum(upper, along + across, out=upper)
        return np.floor(norms * (lower - _SLACK)) - 1, np.ceil(norms * (upper + _SLACK)) + 1

    def most_with(self, other: _Side) -> np.ndarray:
        """The most that any row of ``other`` can score, by the range of its angles."""
        least, largest = other.angles.min(axis=0), other.angles.max(axis=0)
        apart = np.maximum(0, np.maximum(least - self.angles, self.angles - largest))
        cosine = np.cos(apart).min(axis=1) + _SLACK
        norm = np.where(cosine > 0, other.norms.max(), other.norms.min())
        return np.ceil(self.norms * norm * cosine) + 1


class _Best:
    """The best few (score, id) of many seekers."""

    def __init__(self, n: int, most: int):
        self.most = most
        self.scores = [np.zeros(0, dtype=np.int64)] * n
        self.ids = [np.zeros(0, dtype=np.int64)] * n
        #: What a further row must score at least, a tie included.
        self.least = np.full(n, np.iinfo(np.int64).min)

    def add(self, at: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[at], scores]), np.concatenate([self.ids[at], ids])
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores[at], self.ids[at] = scores[order], ids[order]
        if len(order) == self.most:
            self.least[at] = self.scores[at][-1]

    def batches(self, rows: np.ndarray, aim: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        sizes = [len(s) for s in self.scores]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(rows, sizes)),
                    pa.array(np.repeat(np.zeros(len(rows)) if aim is None else aim, sizes).astype(np.int32)),
                    pa.array(np.concatenate(self.ids)),
                    pa.array(np.concatenate(self.scores)),
                ],
                ["row", "aim", "id", "score"],
            )


_PACKED = pa.schema([("place", pa.int64()), *((n, pa.binary()) for n in _COLUMNS)])
