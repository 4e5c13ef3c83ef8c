"""Hard negatives, held against all scores computed in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASH
from wardline.llm import negatives
from wardline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, first=5, scale=256.0) -> set:
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or None in v or not all(map(math.isfinite, v)):
            continue
        x = tuple(math.floor(scale * c) for c in v)
        if sum(c * c for c in x) < negatives.LARGEST:
            good[i, label, x] = None
    out = set()
    for i, label, x in good:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), j, other) for j, other, y in good if j != i and len(x) == len(y)]
        scored.sort(key=lambda s: s[:2])
        for p, j, _ in [s for s in scored if s[2] == label][:first]:
            fit = [(n, k) for n, k, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p][:first]
            out |= {(i, j, r, k, -p, -n) for r, (n, k) in enumerate(fit, 1)}
    return out


def rows_of(df) -> set:
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def some(rnd, n=260, dim=5) -> list[tuple]:
    """Clustered vectors, ties, copies, hot labels."""
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    out = []
    for i in range(n):
        c = rnd.choice(centres)
        v = [x + rnd.gauss(0, 0.1) for x in c]
        if rnd.random() < 0.3:
            v = [round(x) / 2 for x in c]  # copies
        out.append((i, v, rnd.choice([0, 0, 0, 1, 2])))
    return out


def messy() -> list[tuple]:
    inf, nan = float("inf"), float("nan")
    return [
        (None, [1.0, 0.0], 1), (300, None, 1), (301, [], 1), (302, [1.0, None], 1), (303, [1.0, inf], 1), (304, [nan, 1.0], 1), (305, [1.0, 2.0], None),
        (306, [0.0, 0.0], 1), (307, [0.0, 0.0], 2), (308, [-1.0, 0.0], 1), (309, [1.0, 0.0], 2), (310, [1.0, 0.0], 1), (310, [1.0, 0.0], 1), (310, [1.0, 0.1], 2),
        (311, [1e300, 1.0], 1), (312, [3e5, 3e5], 1), (313, [3e5, 2.9e5], 2), (314, [3e5, 2.99e5], 1), (315, [1.0], 1), (316, [1.0], 1), (317, [0.9], 2),
    ]


SMALL = {"TILE": 16, "BLOCK": 7, "MEMBERS": 5, "SLAB": 4, "HEAD": 2, "PER_CLUSTER": 4}


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    for name, value in SMALL.items() if small else ():
        monkeypatch.setattr(negatives, name, value)
    rnd = random.Random(5 + small)
    rows = some(rnd) + messy()
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in CLASH})
    got = rows_of(negatives.hard_negatives(df, F.col("vec_id") % 3 == 0))
    assert got == brute(rows, lambda i: i % 3 == 0)
    assert len(got) > 300


def test_hot_vector(spark, monkeypatch):
    """A third of the rows are one vector, in two labels; only their smallest ids can be first."""
    for name, value in SMALL.items():
        monkeypatch.setattr(negatives, name, value)
    rnd = random.Random(8)
    rows = [(i, [1.0, 0.5, 0.0], i % 2) if i % 3 == 0 else (i, [rnd.gauss(0, 1) for _ in range(3)], i % 4) for i in range(200)]
    got = rows_of(negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_walk_ends_early():
    """Around tight clusters the walk scores few candidates, and finds the same."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    v = np.floor(256 * (centres[rng.integers(0, 20, 6000)] + rng.normal(scale=0.02, size=(6000, 16)))).astype(np.int64)
    ids = rng.permutation(6000)
    u = np.floor(256 * (centres[0] + rng.normal(scale=0.02, size=(30, 16)))).astype(np.int64)
    low, high = np.full((30, 1), negatives.NO_LOW), np.full((30, 1), negatives.NO_HIGH)

    class Counting(np.ndarray):
        scored = 0

        def __matmul__(self, other):
            Counting.scored += len(self) * other.shape[1] if np.ndim(other) == 2 else 0
            return np.asarray(self) @ np.asarray(other)

    m, slot, score, who = negatives.walk(u.view(Counting), np.full(30, -1), low, high, v, ids, 5)
    for k in range(30):
        every = u[k] @ v.T
        order = np.lexsort((ids, -every))[:5]
        assert who[m == k].tolist() == ids[order].tolist() and score[m == k].tolist() == every[order].tolist()
    assert 0 < Counting.scored < 30 * 6000 / 4


def test_distant_blocks_stay(spark, monkeypatch):
    """Blocks whose bound lies below what a tile needs are not shipped."""
    for name, value in {"TILE": 10, "BLOCK": 50, "HEAD": 1, "PER_CLUSTER": 20}.items():
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(4)
    axes = np.eye(8)
    rows = [(i, (axes[i % 8] + rng.normal(scale=0.01, size=8)).tolist(), i % 2) for i in range(800)]
    met = []
    meet = negatives._meet

    def counted(top):
        run = meet(top)
        count = spark.sparkContext.accumulator(0)
        met.append(count)

        def each(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield from run(iter([batch]))

        return each

    monkeypatch.setattr(negatives, "_meet", counted)
    got = rows_of(negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0))
    assert got == brute(rows, lambda i: i % 5 == 0)
    tiles, blocks, passes = 2 * 80 // 10, 400 // 50, 2
    assert 0 < sum(c.value for c in met) < tiles * blocks * passes / 2


def test_empty_and_wrong_range(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 2 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], VECTORS)
    assert negatives.hard_negatives(alone, F.col("vec_id") == 0).count() == 0
    with pytest.raises(ValueError):
        negatives.hard_negatives(empty, F.lit(True), low=0)


def test_query(spark):
    table = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 and x is not None else x) for i, v, x in table]
    assert rows_of(QUERIES["op13_hard_negatives"](spark, SF)) == brute(rows, lambda i: i % 100 == 0)
