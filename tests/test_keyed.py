"""The gate with keyed state, held against a loop over the rows in their order."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wardline.streaming.keyed import END, FOUND, START, Occupied, admitted, run_keyed_gate

DAY = 86_400 * 1_000_000


class Store(dict):
    """A map state that counts what is read."""

    reads = 0

    def getValue(self, key):
        self.reads += 1
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


class Handle:
    def __init__(self):
        self.store = Store()

    def getMapState(self, *_):
        return self.store


def processor() -> Occupied:
    p = Occupied("k", "id", DAY, "overlaps", ["k", "id"])
    p.init(Handle())
    return p


def run(p: Occupied, rows) -> dict:
    given = [Row(**{"k": "a", "id": i, START: s, END: e, FOUND: []}) for i, s, e in rows]
    return {r["id"]: r[FOUND] for r in p.handleInputRows(("a",), iter(given), None)}


def one_by_one(rows, held) -> set:
    out = set()
    for i, s, e in sorted(rows):
        if any(s < b and e > a for a, b in held):
            out.add(i)
        else:
            held.append((s, e))
    return out


@pytest.mark.parametrize("length", [DAY // 3, 5 * DAY, 90 * DAY, 1])
def test_batches_equal_one_by_one(length):
    rnd = random.Random(length)
    p, held, refused = processor(), [], 0
    for batch in range(12):
        rows = []
        for i in range(25):
            s = rnd.randrange(300 * DAY) // (DAY // 4) * (DAY // 4)
            rows.append((batch * 100 + i, s, s + rnd.choice([0, 1, 1, 1]) * rnd.randrange(length)))
        rnd.shuffle(rows)
        want = one_by_one(rows, held)
        assert {i for i, found in run(p, rows).items() if found} == want
        refused += len(want)
    assert refused or length == 1


@pytest.mark.parametrize("earlier", [10, 1000])
def test_cost_follows_the_batch(earlier):
    """The cells that a batch reads are its own, whether 10 or 1,000 batches came before."""
    p = processor()
    for b in range(earlier):
        run(p, [(10 * b + i, (b + 5) * DAY + i * 1000, (b + 5) * DAY + i * 1000 + 10) for i in range(5)])
    p.cells.reads = 0
    run(p, [(10**6 + i, (7 + i) * DAY + 500, (7 + i) * DAY + 600) for i in range(5)])
    assert p.cells.reads == 6  # five days, and the cell of far intervals


def test_stream(spark, tmp_path):
    """Three deliveries and stored rows; one batch is replayed."""
    schema = "id long, place string, s timestamp, e timestamp, note string"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    old = [("p", 0, 2), (None, 0, 2), ("p", 1000, 1001), ("p", 1500, 1501), ("r", 1000, 9000)]  # several days of a key, a long interval
    stored = spark.createDataFrame([(0, place, at(s), at(e), "old") for place, s, e in old], schema)
    first = [(5, "p", at(1), at(3), "meets stored"), (6, "p", at(2), at(4), "fits"), (7, "p", at(3), at(5), "meets 6"), (8, "p", at(4), at(6), "7 is refused"),
             (9, "q", at(1), at(90), "bad"), (10, "q", at(2), at(3), "9 is refused"), (11, None, at(0), at(9), None), (12, None, at(0), at(9), None)]
    second = [(13, "q", at(2), at(3), "meets 10"), (4, "p", at(5), at(7), "meets 8, whatever its id"), (14, "p", None, at(7), "no time"), (15, "q", at(3), at(2000), "long")]
    third = [(16, "q", at(1900), at(1901), "bad"), (17, "q", at(2000), at(2001), "fits"), (18, "p", at(1000), at(1001), None), (19, "p", at(1500), at(1501), None), (20, "r", at(5000), at(5001), None)]
    src, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")

    def deliver():
        stream = spark.readStream.schema(schema).parquet(src)
        checked = admitted(stream, stored, "place", "id", "s", "e", static={"bad": F.col("note") == "bad"})
        q = run_keyed_gate(checked, out, checkpoint_location=checkpoint, key=["id"])
        q.awaitTermination()
        assert q.exception() is None

    for rows in (first, second, third):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        deliver()
    rejected = lambda: {(r.id, r.rule) for r in spark.read.parquet(f"{out}/rejected").collect()}
    want = {(5, "overlaps"), (7, "overlaps"), (9, "bad"), (13, "overlaps"), (4, "overlaps"), (16, "bad"), (16, "overlaps"), (18, "overlaps"), (19, "overlaps"), (20, "overlaps")}
    assert rejected() == want
    accepted = {r.id: r for r in spark.read.parquet(f"{out}/accepted").collect()}
    assert set(accepted) == {6, 8, 10, 11, 12, 14, 15, 17}
    assert accepted[6].s == at(2) and accepted[6].note == "fits" and accepted[14].s is None
    # forget that the last batch committed: the restarted stream replays it from the state before it
    last = max((p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    crc = last.parent / f".{last.name}.crc"
    if crc.exists():
        crc.unlink()
    deliver()
    assert rejected() == want
