"""G1: the ingest gate on a stream of procedure events, checked against the batch audits."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column
from pyspark.sql import functions as F

from wardline.operators import hierarchy
from wardline.plans.rules import declared_constraints, trigger_rules
from wardline.sources.schemas import SCHEMAS
from wardline.streaming.gate import gate_batch, run_gate


def test_gate_stream_matches_batch_audit(spark, hospital, tmp_path):
    events = hospital["procedure_event"]
    src = tmp_path / "incoming"
    # two files -> two micro-batches: events 1-3, then 4-6
    events.filter(F.col("procedure_event_id") <= 3).coalesce(1).write.parquet(str(src / "part1"))
    events.filter(F.col("procedure_event_id") > 3).coalesce(1).write.parquet(str(src / "part2"))
    files = sorted(src.glob("part*/*.parquet"))
    for i, f in enumerate(files):
        f.rename(src / f"batch{i}.parquet")
    current = dict(hospital, procedure_event=events.limit(0))
    out = tmp_path / "out"
    q = run_gate(spark, "procedure_event", str(src), current, str(out),
                 checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    rejected = spark.read.parquet(str(out / "rejected"))
    accepted = spark.read.parquet(str(out / "accepted"))
    rej = {r["key_value"] for r in rejected.collect()}
    acc = {r["procedure_event_id"] for r in accepted.collect()}
    assert rej == {"3", "4", "5"}
    assert acc == {1, 2, 6}
    rules = {(r["key_value"], r["rule"]) for r in rejected.collect()}
    assert ("4", "T4_chief_overlap") in rules and ("4", "T6_place_type_mismatch") in rules
    # every rejection is also reported by the batch audit of all rows together
    full = declared_constraints(hospital, only=["procedure_event"]).unionByName(
        trigger_rules(hospital, only=["procedure_event"]))
    audited = {r["key_value"] for r in full.filter(F.col("table_name") == "procedure_event").collect()}
    assert rej <= audited


def _event(spark, *row):
    from wardline.sources.schemas import SCHEMAS

    return spark.createDataFrame([row], _nullable(SCHEMAS["procedure_event"]))


def _rules(rejected):
    return {(r["key_value"], r["rule"]) for r in rejected.collect()}


def test_gate_unique_value_of_another_key(spark, hospital):
    import datetime as dt

    from wardline.sources.schemas import SCHEMAS

    row = ("90000000001", "New", "Person", 30, "a1@h.gr", "9", dt.date(2020, 1, 1), "DOCTOR")  # the email is stored
    batch = spark.createDataFrame([row], SCHEMAS["personnel"])
    accepted, rejected = gate_batch(batch, "personnel", hospital)
    assert accepted.count() == 0 and _rules(rejected) == {("90000000001", "unique(email)")}
    other = spark.createDataFrame([row[:4] + ("A1@H.gr",) + row[5:]], SCHEMAS["personnel"])
    assert gate_batch(other, "personnel", hospital)[0].count() == 1  # binary comparison by default
    assert gate_batch(other, "personnel", hospital, collation="UNICODE_CI_AI_RTRIM")[0].count() == 0


def test_gate_overlap_with_a_stored_row_of_larger_id(spark, hospital):
    import datetime as dt

    # the very slot, place and chief of stored event 6, with id 0
    batch = _event(spark, 0, 1, "PC1", 1, "00000000002", dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1), 120)
    accepted, rejected = gate_batch(batch, "procedure_event", hospital)
    assert accepted.count() == 0
    assert {("0", "T3_place_overlap"), ("0", "T4_chief_overlap")} <= _rules(rejected)


def test_gate_participant_overlap_in_either_order(spark, hospital):
    from wardline.sources.schemas import SCHEMAS

    for new, old in ((1, 4), (4, 1)):  # events 1 and 4 overlap
        stored = spark.createDataFrame([(old, "00000000005")], SCHEMAS["procedure_participant"])
        batch = spark.createDataFrame([(new, "00000000005")], SCHEMAS["procedure_participant"])
        accepted, rejected = gate_batch(batch, "procedure_participant", dict(hospital, procedure_participant=stored))
        assert accepted.count() == 0
        assert (f"{new}|00000000005", "T5a_participant_overlap") in _rules(rejected)


def test_gate_generated_id_avoids_explicit_ids(spark, hospital):
    import datetime as dt

    from wardline.sources.schemas import SCHEMAS

    rows = [(None, "22222222222", 2, 2, "K2", dt.datetime(2025, 5, 2), None, "A00", None, None),
            (211, "22222222222", 2, 2, "K2", dt.datetime(2025, 5, 3), None, "A00", None, None)]
    batch = spark.createDataFrame(rows, _nullable(SCHEMAS["hospitalization"]))
    accepted, rejected = gate_batch(batch, "hospitalization", hospital)
    assert rejected.count() == 0
    assert sorted(r.hosp_id for r in accepted.collect()) == [211, 212]


def test_gate_upsert_compares_with_other_rows_only(spark, hospital):
    import datetime as dt

    free = _event(spark, 6, 1, "PC1", 1, "00000000002", dt.datetime(2024, 1, 1, 22), dt.datetime(2024, 1, 2, 1), 180)
    assert gate_batch(free, "procedure_event", hospital)[0].count() == 0  # as an insert: the key is stored
    accepted, rejected = gate_batch(free, "procedure_event", hospital, upsert=True)
    assert rejected.count() == 0 and accepted.count() == 1  # overlaps only its old self
    busy = _event(spark, 6, 1, "PC1", 1, "00000000002", dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 11), 60)
    rules = _rules(gate_batch(busy, "procedure_event", hospital, upsert=True)[1])
    assert ("6", "T3_place_overlap") in rules and ("6", "primary_key") not in rules


def test_gate_within_batch_keeps_the_first(spark, hospital):
    import datetime as dt

    day = lambda h: dt.datetime(2031, 1, 1, h)
    batch = _event(spark, 20, 1, "PC1", 1, "00000000002", day(9), day(11), 120).unionByName(
        _event(spark, 21, 1, "PC1", 1, "00000000003", day(10), day(12), 120))
    accepted, rejected = gate_batch(batch, "procedure_event", hospital)
    assert [r.procedure_event_id for r in accepted.collect()] == [20]
    assert _rules(rejected) == {("21", "T3_place_overlap")}


@pytest.mark.parametrize("fault", ["no parquet", "another schema"])
def test_gate_does_not_swallow_read_errors(spark, hospital, tmp_path, fault):
    """What batch 0 accepted is damaged before batch 1 reads it: the stream ends with an error and accepts nothing."""
    events = hospital["procedure_event"]
    src, out, ckpt = str(tmp_path / "in"), tmp_path / "out", str(tmp_path / "c")
    current = dict(hospital, procedure_event=events.limit(0))

    def deliver(where):
        events.filter(where).coalesce(1).write.mode("append").parquet(src)
        q = run_gate(spark, "procedure_event", src, current, str(out), checkpoint_location=ckpt)
        q.awaitTermination(300)

    deliver("procedure_event_id = 6")
    held = out / "accepted" / "batch_id=0"
    assert spark.read.parquet(str(held)).count() == 1
    for f in held.glob("*.parquet"):
        if fault == "no parquet":
            f.write_text(fault)
        else:
            pq.write_table(pa.table({"procedure_event_id": ["six"], "place_id": ["one"]}), f)
        crc = f.parent / f".{f.name}.crc"
        if crc.exists():
            crc.unlink()
    with pytest.raises(StreamingQueryException):
        deliver("procedure_event_id = 1")
    assert not (out / "accepted" / "batch_id=1").exists()


def test_gate_admits_one_by_one(spark, hospital):
    """A row that clashes only with a refused row is accepted; the order is that of the keys."""
    day = lambda h: dt.datetime(2031, 1, 1, h)
    chief, other = "00000000002", "00000000003"
    rows = [
        (20, 1, "PC1", 1, chief, day(9), day(11), 120),
        (21, 1, "PC1", 1, other, day(10), day(12), 120),  # overlaps 20
        (22, 1, "PC1", 1, chief, day(11), day(13), 120),  # overlaps 21 only
        (23, 1, "PC1", 1, "99999999999", day(14), day(16), 120),  # no such doctor
        (24, 1, "PC1", 1, other, day(15), day(17), 120),  # overlaps 23 only
        (24, 1, "PC1", 1, other, day(18), day(19), 60),  # the key of an accepted row
        (21, 1, "PC1", 1, other, day(20), day(21), 60),  # the key of a refused row
    ]
    batch = spark.createDataFrame(rows, _nullable(SCHEMAS["procedure_event"]))
    accepted, rejected = gate_batch(batch, "procedure_event", hospital)
    assert {(r.procedure_event_id, r.start_ts.hour) for r in accepted.collect()} == {(20, 9), (21, 20), (22, 11), (24, 15)}
    found = _rules(rejected)
    assert {("21", "T3_place_overlap"), ("24", "primary_key")} <= found
    assert any(key == "23" and rule.startswith("foreign_key(chief") for key, rule in found)
    assert not {"20", "22"} & {key for key, _ in found}


def test_gate_participants_one_by_one(spark, hospital):
    """The second of two participations at the same time goes, the third, after the refused one, stays."""
    day = lambda h: dt.datetime(2032, 1, 1, h)
    new = [(31, 1, "PC1", 1, "00000000002", day(9), day(11), 120), (32, 1, "PC1", 2, "00000000003", day(10), day(12), 120),
           (33, 1, "PC1", 1, "00000000002", day(11), day(13), 120)]
    events = hospital["procedure_event"].unionByName(spark.createDataFrame(new, SCHEMAS["procedure_event"]))
    batch = spark.createDataFrame([(31, "00000000005"), (32, "00000000005"), (33, "00000000005")], SCHEMAS["procedure_participant"])
    accepted, rejected = gate_batch(batch, "procedure_participant", dict(hospital, procedure_event=events))
    assert sorted(r.procedure_event_id for r in accepted.collect()) == [31, 33]
    assert _rules(rejected) == {("32|00000000005", "T5a_participant_overlap")}


def _climb(rows, stored):
    up = dict(stored) | dict(rows)
    out = set()
    for v, _ in rows:
        seen, at = set(), v
        while at is not None and at not in seen:
            seen.add(at)
            at = up.get(at)
        if at is not None:
            out.add(v)
    return out


@pytest.mark.parametrize("pushed", [1000, 2])
def test_cycles_are_climbed_from_the_batch(spark, monkeypatch, pushed):
    monkeypatch.setattr(hierarchy, "PUSHED", pushed)
    rnd = random.Random(pushed)
    schema = "v int, p int"
    for n in (12, 40):
        stored = [(v, rnd.choice([None, *range(60)])) for v in range(n)]
        rows = [(v, rnd.choice([None, *range(60)])) for v in range(n - 4, n + 8)]
        got = hierarchy.cycles_through(spark.createDataFrame(rows, schema), spark.createDataFrame(stored, schema), "v", "p")
        assert {r.v for r in got.collect()} == _climb(rows, stored)
    long = [(v, v + 1) for v in range(20)] + [(20, 5)]  # a tail into a cycle of sixteen
    rows = spark.createDataFrame([(100, 0), (101, 300), (3, 4)], schema)
    assert {r.v for r in hierarchy.cycles_through(rows, spark.createDataFrame(long, schema), "v", "p").collect()} == {100, 3}


def test_climbing_reads_what_it_reaches(spark, tmp_path):
    """Of a large sorted table only the row groups with the reached keys are read: a filter on a list of keys goes into every scan."""
    table = spark.range(200_000).select(F.col("id").alias("v"), F.when(F.col("id") > 0, F.floor(F.col("id") / 20)).alias("p")).repartitionByRange(50, "v").sortWithinPartitions("v")
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    lists = []
    batch = spark.createDataFrame([(300_000, 199_999), (300_001, 300_000)], "v long, p long")
    isin = Column.isin

    def noted(self, *keys):
        lists.append(len(keys[0]))
        return isin(self, *keys)

    Column.isin = noted
    try:
        assert hierarchy.cycles_through(batch, stored, "v", "p").count() == 0
    finally:
        Column.isin = isin
    assert len(lists) <= 8 and all(n <= 2 for n in lists)  # rounds by depth, keys by the batch


def test_gate_batch_rejects_duplicate_key(spark, hospital):
    events = hospital["procedure_event"]
    batch = events.filter(F.col("procedure_event_id") == 6)
    accepted, rejected = gate_batch(batch, "procedure_event", hospital)  # 6 is already stored
    assert accepted.count() == 0
    assert {r["rule"] for r in rejected.collect()} >= {"primary_key"}


def test_gate_applies_declared_default(spark, hospital):
    import datetime as dt

    from wardline.sources.schemas import SCHEMAS

    rows = [(None, "22222222222", 2, 2, "K2", dt.datetime(2025, 5, 2), None, "A00", None, None),
            (None, "22222222222", 2, 2, "K2", dt.datetime(2025, 5, 3), None, "A00", None, None)]
    batch = spark.createDataFrame(rows, _nullable(SCHEMAS["hospitalization"]))  # id and total_cost omitted
    accepted, rejected = gate_batch(batch, "hospitalization", hospital)
    assert rejected.count() == 0
    got = sorted((r.hosp_id, r.total_cost) for r in accepted.collect())
    assert got == [(211, 0), (212, 0)]  # ids continue after the stored maximum (210)


def _nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def test_gate_replay_is_idempotent(spark, hospital, tmp_path):
    events = hospital["procedure_event"]
    src = tmp_path / "incoming"
    events.filter(F.col("procedure_event_id") <= 3).coalesce(1).write.parquet(str(src / "p1"))
    events.filter(F.col("procedure_event_id") > 3).coalesce(1).write.parquet(str(src / "p2"))
    for i, f in enumerate(sorted(src.glob("p*/*.parquet"))):
        f.rename(src / f"batch{i}.parquet")
    current = dict(hospital, procedure_event=events.limit(0))
    out, ckpt = tmp_path / "out", tmp_path / "ckpt"

    def snapshot():
        acc = sorted(tuple(r) for r in spark.read.parquet(str(out / "accepted")).collect())
        rej = sorted(tuple(r) for r in spark.read.parquet(str(out / "rejected")).collect())
        return acc, rej

    run_gate(spark, "procedure_event", str(src), current, str(out), checkpoint_location=str(ckpt)).awaitTermination(300)
    first = snapshot()
    batch_dirs = sorted((out / "accepted").glob("batch_id=*"))
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in batch_dirs}
    # forget that the last batch committed: the restarted stream replays it
    commits = sorted((ckpt / "commits").iterdir(), key=lambda p: p.name)
    last = [p for p in commits if p.name.isdigit()][-1]
    last.unlink()
    crc = ckpt / "commits" / f".{last.name}.crc"
    if crc.exists():
        crc.unlink()
    run_gate(spark, "procedure_event", str(src), current, str(out), checkpoint_location=str(ckpt)).awaitTermination(300)
    assert snapshot() == first
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in sorted((out / "accepted").glob("batch_id=*"))}
    assert after[batch_dirs[0].name] == before[batch_dirs[0].name]  # earlier batch untouched
    assert after[batch_dirs[-1].name] != before[batch_dirs[-1].name]  # last batch really ran again


def test_gate_rejects_reused_id_with_other_keys(spark, hospital):
    import datetime as dt

    from wardline.sources.schemas import SCHEMAS

    # id 6 is stored (place 1, chief A2); the new row reuses it with another place and chief
    row = [(6, 5, "PC1", 2, "00000000003", dt.datetime(2030, 1, 1, 8), dt.datetime(2030, 1, 1, 9), 60)]
    batch = spark.createDataFrame(row, SCHEMAS["procedure_event"])
    accepted, rejected = gate_batch(batch, "procedure_event", hospital)
    assert accepted.count() == 0
    assert "primary_key" in {r["rule"] for r in rejected.collect()}


def test_gate_doctor_cycle_through_stored_rows(spark, hospital):
    from wardline.sources.schemas import SCHEMAS

    # stored: 00000000009 is supervised by the (not yet present) 00000000010; inserting 10 under 9 closes a cycle
    stored = hospital["doctor"].unionByName(
        spark.createDataFrame([("00000000009", "L9", "S", "CONSULTANT_A", "00000000010")], SCHEMAS["doctor"]))
    batch = spark.createDataFrame([("00000000010", "L10", "S", "CONSULTANT_A", "00000000009")], SCHEMAS["doctor"])
    accepted, rejected = gate_batch(batch, "doctor", dict(hospital, doctor=stored))
    assert accepted.count() == 0
    assert "T1d_supervision_cycle" in {r["rule"] for r in rejected.collect()}


def test_gate_participants(spark, hospital):
    from wardline.sources.schemas import SCHEMAS

    pp = hospital["procedure_participant"]
    stored = pp.filter(~(((F.col("procedure_event_id") == 1) & (F.col("personnel_amka") == "00000000001"))
                         | ((F.col("procedure_event_id") == 2) & (F.col("personnel_amka") == "00000000006"))))
    batch = spark.createDataFrame(
        [(1, "00000000001"), (2, "00000000006"), (5, "00000000005")], SCHEMAS["procedure_participant"])
    accepted, rejected = gate_batch(batch, "procedure_participant", dict(hospital, procedure_participant=stored))
    rules = {(r["key_value"], r["rule"]) for r in rejected.collect()}
    assert ("1|00000000001", "T7_chief_is_participant") in rules  # chief of event 1 listed as its participant
    assert ("1|00000000001", "T5b_participant_is_busy_chief") in rules  # and chief of overlapping event 4
    assert ("2|00000000006", "T8_admin_participant") in rules
    assert [tuple(r) for r in accepted.collect()] == [(5, "00000000005")]
