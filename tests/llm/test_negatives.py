"""Hard negatives against plain Python over all pairs, and against SQL."""

import math
import random
from pathlib import Path

import duckdb
import pytest

from sequon.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
FOLDER = "/root/testdata/sf0.01"


def rows_of(seed, n=900, dim=6):
    dice = random.Random(seed)
    middles = [[dice.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        middle = dice.choice(middles)
        spread = dice.choice([0.05, 0.4, 1.5])
        rows.append((i, [m + dice.gauss(0, spread) for m in middle], dice.randrange(10)))
    # A very common vector, ties, nothing at all, and what takes no part.
    rows += [(i, [0.25] * dim, 1 if i % 2 else 2) for i in range(n, n + 210)]
    n += 210
    rows += [(n, [0.0] * dim, 3), (n + 1, None, 3), (n + 2, [1.0] * dim, None), (None, [1.0] * dim, 3)]
    rows += [(n + 3, [math.nan] + [1.0] * (dim - 1), 3), (n + 4, [math.inf] * dim, 3)]
    rows += [(n + 5, [None] + [1.0] * (dim - 1), 3), (n + 6, [2.0] * (dim - 2), 3), (n + 7, [], 3)]
    dice.shuffle(rows)
    return rows + rows[:30]


def expected(rows):
    import numpy as np

    own = []
    for i, vector, label in rows:
        if i is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own.append((i, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for a, u, label in own:
        if a % 100:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(u, v)), i, other == label) for i, v, other in own if i != a
        )
        for s, positive, _ in [x for x in scored if x[2]][:5]:
            fits = [x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(a, positive, k, i, -s, -t) for k, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.op11_negatives(spark, str(tmp_path))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert out.columns == names
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("small", [False, True])
def test_same_as_all_pairs(spark, tmp_path, monkeypatch, small):
    if small:
        # Many tiles, groups and blocks.
        monkeypatch.setattr(negatives, "TILE", 32)
        monkeypatch.setattr(negatives, "BLOCK", 3)
        monkeypatch.setattr(negatives, "GROUP_TILES", 4)
    rows = rows_of(1)
    want = expected(rows)
    assert len(want) > 200
    assert found(spark, tmp_path, rows) == want


def test_large_numbers(spark, tmp_path):
    dice = random.Random(4)
    rows = [(i, [dice.uniform(-1, 1) * 3e5 for _ in range(5)], i % 3) for i in range(150)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_same_as_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{Path(FOLDER) / 'embeddings.parquet'}'")
    want = sorted(duck.execute(queries.ORACLE_SQL["op11_negatives"]).fetchall())
    assert sorted(map(tuple, queries.op11_negatives(spark, FOLDER).collect())) == want
    assert want


def test_bounds_hold():
    import numpy as np

    dice = np.random.default_rng(3)
    vectors = dice.integers(-300, 300, (200, 9))
    vectors[:20] = vectors[20:40] * 3
    vectors[0] = 0
    shape = negatives._Shape(9, 900, np.linalg.qr(dice.normal(size=(9, 9)))[0][:4])
    norms, angles = shape.angles(vectors)
    blank = np.zeros(200)
    side = negatives._Side(blank, blank, blank, vectors, norms, angles)
    scores = vectors @ vectors.T
    lower, upper = side.bounds(side)
    assert (lower <= scores).all() and (scores <= upper).all()
    assert (side.most_with(side) >= scores.max(axis=1)).all()


def test_no_rows(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_one_label_and_clashing_names(spark):
    rows = spark.createDataFrame([(0, [1.0], 1, "x"), (1, [2.0], 1, "y")], "id long, vector array<double>, label int, row string")
    from pyspark.sql import functions as F

    assert negatives.mine(rows, F.col("id") == 0).collect() == []
