"""Trigger rules T1-T8 and the declared-constraint audits on the hand-built hospital."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from tests.hospital_fixture import A1, A4, A7, A8, AD6, N5
from wardline.plans import rules as RU
from wardline.sources.schemas import FOREIGN_KEYS, SCHEMAS


def _nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _set(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_supervision_rules(spark, hospital):
    assert RU.supervision_rules(hospital).count() == 0
    bad = spark.createDataFrame([
        ("90000000001", "L", "S", "CONSULTANT_A", "90000000001"),  # self
        ("90000000002", "L", "S", "RESIDENT", None),               # resident alone
        ("90000000003", "L", "S", "DIRECTOR", A1),                 # director supervised
    ], SCHEMAS["doctor"])
    t = dict(hospital, doctor=hospital["doctor"].unionByName(bad))
    got = _set(RU.supervision_rules(t), "rule", "key_value")
    assert got == {("T1a_self_supervision", "90000000001"), ("T1b_resident_needs_supervisor", "90000000002"),
                   ("T1c_director_has_no_supervisor", "90000000003")}


def test_supervision_cycles(spark, hospital):
    got = _set(RU.supervision_cycle_rows(hospital), "amka", "on_cycle", "cycle_id")
    assert got == {(A7, True, A7), (A8, True, A7)}
    # a doctor below the cycle leads into it but is not on it
    extra = spark.createDataFrame([("90000000009", "L", "S", "RESIDENT", A8)], SCHEMAS["doctor"])
    t = dict(hospital, doctor=hospital["doctor"].unionByName(extra))
    assert ("90000000009", False, A7) in _set(RU.supervision_cycle_rows(t), "amka", "on_cycle", "cycle_id")


def test_allergy_conflict(hospital):
    assert _set(RU.allergy_conflict_rows(hospital), "prescription_id", "substance") == {(1, 2)}


def test_overlaps(hospital):
    # 1 (10:00-11:00) and 4 (10:30-10:45), 2 (11:00-12:00) and 3 (11:30-12:30): the later of each pair is reported
    assert _set(RU.place_overlap_rows(hospital), "procedure_event_id") == {(4,), (3,)}
    assert _set(RU.chief_overlap_rows(hospital), "procedure_event_id") == {(4,)}
    assert _set(RU.participant_overlap_rows(hospital), "personnel_amka", "procedure_event_id") == {(N5, 4)}
    assert _set(RU.participant_chief_overlap_rows(hospital), "personnel_amka", "procedure_event_id") == {(A4, 2), (A1, 1)}


def test_lookup_rules(hospital):
    assert _set(RU.place_type_mismatch_rows(hospital), "procedure_event_id") == {(4,), (5,)}
    assert _set(RU.chief_is_participant_rows(hospital), "procedure_event_id", "personnel_amka") == {(1, A1)}
    assert _set(RU.admin_participant_rows(hospital), "procedure_event_id", "personnel_amka") == {(2, AD6)}


def test_trigger_rules_union(hospital):
    rules = {r["rule"] for r in RU.trigger_rules(hospital).collect()}
    assert rules == {"T1d_supervision_cycle", "T2_allergy_conflict", "T3_place_overlap", "T4_chief_overlap",
                     "T5a_participant_overlap", "T5b_participant_is_busy_chief", "T6_place_type_mismatch",
                     "T7_chief_is_participant", "T8_admin_participant"}


def test_declared_constraints_clean_fixture(hospital):
    assert RU.declared_constraints(hospital).collect() == []


def test_declared_constraints_find_violations(spark, hospital):
    bad_person = spark.createDataFrame(
        [(A1, "Dup", "Key", 15, "a1@h.gr", "9", dt.date(2020, 1, 1), "JANITOR")], SCHEMAS["personnel"])
    bad_stay = spark.createDataFrame(
        [(900, "99999999999", 1, 1, "K1", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 1), "A00", None, None)],
        _nullable(SCHEMAS["hospitalization"]),  # as read from files, where NOT NULL is not enforced
    )
    t = dict(hospital, personnel=hospital["personnel"].unionByName(bad_person),
             hospitalization=hospital["hospitalization"].unionByName(bad_stay))
    got = _set(RU.declared_constraints(t, only=["personnel", "hospitalization"]), "rule", "table_name", "key_value")
    assert ("primary_key", "personnel", A1) in got
    assert ("unique(email)", "personnel", "a1@h.gr") in got
    assert ("ck_personnel_age", "personnel", A1) in got
    assert ("ck_personnel_type", "personnel", A1) in got
    assert ("ck_hosp_dates", "hospitalization", "900") in got
    assert ("not_null(total_cost)", "hospitalization", "900") in got
    assert ("foreign_key(patient_amka)->patient", "hospitalization", "900") in got


def test_catalogue_counts():
    assert len(SCHEMAS) == 30
    assert len(FOREIGN_KEYS) == 42
    assert sum(fk.on_delete == "CASCADE" for fk in FOREIGN_KEYS) == 19
