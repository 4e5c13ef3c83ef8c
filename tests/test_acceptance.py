"""Row-at-a-time acceptance, held against a loop over the rows in their order."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import acceptance
from wardline.operators.acceptance import Cover, accept_in_order, refused_claims

CLAIMS = "row long, space string, key string, s long, e long"


def one_by_one(claims) -> set:
    """(row, space) of all refusals."""
    held = [c for c in claims if c[0] is None]
    out = set()
    for row in sorted({c[0] for c in claims if c[0] is not None}):
        mine = [c for c in claims if c[0] == row]
        usable = lambda c: None not in c[2:] and c[3] <= c[4]
        hit = {c[1] for c in mine for h in held if usable(c) and usable(h) and c[1:3] == h[1:3] and c[3] < h[4] and c[4] > h[3]}
        out |= {(row, space) for space in hit}
        if not hit:
            held += mine
    return out


def some_claims(rnd, n, keys, length, spaces=("place",), stored=5) -> list[tuple]:
    out = []
    for row in [None] * stored + rnd.sample(range(1, 10 * n), n):
        for space in spaces:
            s = rnd.randrange(200)
            out.append((row, space, rnd.choice(keys), s, s + rnd.randrange(length)))
    return out


def rows_of(df) -> set:
    return {(r.row, r.rule) for r in df.collect()}


@pytest.fixture
def cut_finely(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("n", "keys", "length", "spaces"), [
    (120, ["a"], 12, ("place",)),  # one key over all parts, in no order of time
    (150, ["a", "b", "c", None], 30, ("place", "chief")),
    (60, ["a"], 150, ("place", "chief")),  # intervals that reach over many cuts
    (80, ["a", "b"], 3, ("place", "chief", "more")),  # empty intervals
])
def test_equals_one_by_one(spark, cut_finely, n, keys, length, spaces):
    claims = some_claims(random.Random(n), n, keys, length, spaces)
    claims += [(10 * n + 1, "place", "a", None, 5), (10 * n + 2, "place", "a", 9, 3), (10 * n + 3, "other", "a", 0, 500)]
    got = rows_of(refused_claims(spark.createDataFrame(claims, CLAIMS)))
    assert got == one_by_one(claims)
    assert 0 < len(got)


def test_a_chain_over_all_cuts(spark, cut_finely):
    """Every interval meets the next: every second is refused, in time order and against it."""
    up = [(i + 1, "place", "a", 10 * i, 10 * i + 15) for i in range(100)]
    assert rows_of(refused_claims(spark.createDataFrame(up, CLAIMS))) == {(i, "place") for i in range(2, 101, 2)}
    down = [(100 - i, *c[1:]) for i, c in enumerate(up)]
    assert rows_of(refused_claims(spark.createDataFrame(down, CLAIMS))) == {(i, "place") for i in range(2, 101, 2)}


def test_batch_and_stored_rows(spark):
    schema = "id long, place string, s long, e long, code string"
    stored = spark.createDataFrame([(1, "p", 0, 10, "x"), (2, "p", 5, 12, None), (3, "q", 0, 10, "y")], schema)
    batch = spark.createDataFrame([
        (13, "p", 14, 20, None),  # clashes only with 12, which is refused
        (12, "p", 11, 16, None),  # clashes with stored 2
        (14, "p", 18, 19, None),  # clashes with 13
        (15, "q", 10, 12, "x"),  # code of stored 1
        (16, "q", 11, 12, "z"),  # 15 is refused
        (17, "q", 30, 31, "z"),  # code of 16
        (18, None, 0, 99, None),
    ], schema)
    accepted, refused = accept_in_order(batch, stored, ["id"], [("overlap", "place", "s", "e")], [("unique(code)", ["code"])])
    assert sorted(r.id for r in accepted.collect()) == [13, 16, 18]
    assert {(r.id, r.rule) for r in refused.collect()} == {(12, "overlap"), (14, "overlap"), (15, "unique(code)"), (17, "unique(code)")}
    assert accepted.columns == batch.columns
    accepted, refused = accept_in_order(batch.limit(0), stored, ["id"], [("overlap", "place", "s", "e")])
    assert accepted.count() == refused.count() == 0


def test_barred_rows_are_told_what_they_meet(spark):
    schema = "id long, place string, s long, e long"
    batch = spark.createDataFrame([(1, "p", 0, 10), (2, "p", 5, 12), (3, "p", 11, 20), (4, "p", 50, 60)], schema)
    accepted, refused = accept_in_order(batch, None, ["id"], [("overlap", "place", "s", "e")], barred=F.col("id").isin(1, 3, 4))
    assert [r.id for r in accepted.collect()] == [2]  # 1 stands in nobody's way
    assert [(r.id, r.rule) for r in refused.collect()] == [(3, "overlap")]


def test_cover():
    rnd = random.Random(2)
    for _ in range(300):
        cover, held = Cover(), []
        for _ in range(20):
            s = rnd.randrange(30)
            e = s + rnd.randrange(6)
            assert cover.meets(s, e) == any(s < b and e > a for a, b in held)
            cover.add(s, e)
            held.append((s, e))
        assert cover.ends == sorted(cover.ends) and cover.starts == sorted(cover.starts)


def test_later_rounds_read_only_what_is_open(spark, monkeypatch):
    """Rows that are decided leave; the scan of a round is as long as what it has left."""
    sizes = []
    scanned = acceptance._scanned

    def counted(claims):
        sizes.append(claims.count())
        return scanned(claims)

    monkeypatch.setattr(acceptance, "_scanned", counted)
    claims = [(i + 1, sp, str(i // 3), i % 3, i % 3 + 2) for i in range(300) for sp in ("a", "b")]
    claims += [(1000 + i, sp, "chain", 10 * i, 10 * i + 15) for i in range(8) for sp in ("a", "b")]
    assert rows_of(refused_claims(spark.createDataFrame(claims, CLAIMS))) == one_by_one(claims)
    rounds = sizes[:-1]  # the last scan names the rules
    assert len(rounds) > 3 and all(x < 40 for x in rounds[3:])
