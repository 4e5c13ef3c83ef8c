"""Reports Q1-Q15 on the hand-built hospital, each against a plain-Python answer from the fixture's own rows.

The answers loop over dictionaries made of ``hospital_fixture.ROWS``; numbers
that a reader can check by hand are asserted beside them.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.hospital_fixture import A1, A2, A4, A7, AS_OF, AS_OF_TS, P1, ROWS, SURG
from tests.util import norm, rows_of
from wardline.operators.hierarchy import CycleFound
from wardline.plans import reports as R
from wardline.sources.schemas import SCHEMAS

T = {t: [dict(zip(SCHEMAS[t].fieldNames(), row, strict=False)) for row in rows] for t, rows in ROWS.items()}


def by(table: str, key: str) -> dict:
    return {r[key]: r for r in T[table]}


STAFF, DEPT, KEN, PATIENT, ICD = (by(t, k) for t, k in (
    ("personnel", "amka"), ("department", "department_id"), ("ken", "ken_code"), ("patient", "patient_amka"), ("icd10_diagnosis", "icd10_code")))
RATING = by("hospitalization_evaluation", "hosp_id")
SCORES = ["medical_care_score", "nursing_care_score", "cleanliness_score", "food_score", "overall_experience_score"]


def days(a: dt.datetime, b: dt.datetime) -> int:
    return (b.date() - a.date()).days


def agrees(df, want, *, ordered: bool = False):
    got = rows_of(df)
    want = [tuple(norm(x) for x in r) for r in want]
    assert got == want if ordered else Counter(got) == Counter(want)
    return got


def test_q1_revenue_rollup(hospital):
    groups = defaultdict(lambda: [0, 0, 0, 0])
    for h in T["hospitalization"]:
        if h["discharge_ts"] is None:
            continue
        k = KEN[h["ken_code"]]
        late = max(0, days(h["admission_ts"], h["discharge_ts"]) - k["mean_duration_days"])
        g = groups[DEPT[h["department_id"]]["department_name"], h["discharge_ts"].year, k["ken_code"], k["ken_description"],
                   PATIENT[h["patient_amka"]]["insurance_provider"]]
        for i, x in enumerate((1, k["basic_cost"], late * k["extra_daily_cost"], h["total_cost"])):
            g[i] += x
    got = agrees(R.revenue_rollup(hospital), [(*k, *v) for k, v in groups.items()])
    # stay 1 crosses the year end: it counts in its discharge year, with 6 days vs a mean of 3
    assert ("Χειρουργική Κλινική", 2025, "K1", "Ken one", "EOPYY", 2, 2000.0, 900.0, 3500.0) in got


def test_q2_roster_flag(hospital):
    this_year = {s["shift_id"] for s in T["department_shift"] if s["shift_date"].year == AS_OF.year}
    on_duty = {a["personnel_amka"] for a in T["shift_assignment"] if a["shift_id"] in this_year}
    led = Counter(e["chief_surgeon_amka"] for e in T["procedure_event"])
    want = [(d["amka"], STAFF[d["amka"]]["first_name"], STAFF[d["amka"]]["last_name"], SURG, "YES" if d["amka"] in on_duty else "NO", led[d["amka"]])
            for d in T["doctor"] if d["specialization"] == SURG]
    got = agrees(R.roster_flag(hospital, SURG, as_of=AS_OF), want)
    assert {r[0]: (r[4], r[5]) for r in got} == {A1: ("YES", 3), A2: ("YES", 2), A4: ("NO", 1)}


def test_q2_collation_opt_in(hospital):
    assert R.roster_flag(hospital, "χειρουργικη", as_of=AS_OF).count() == 0
    assert R.roster_flag(hospital, "ΧΕΙΡΟΥΡΓΙΚΗ", as_of=AS_OF, collation="UNICODE_CI_AI_RTRIM").count() == 3


def test_q3_frequent_groups(hospital):
    stays = defaultdict(list)
    for h in T["hospitalization"]:
        stays[h["patient_amka"], h["department_id"]].append(h["total_cost"])
    want = [(p, PATIENT[p]["first_name"], PATIENT[p]["last_name"], DEPT[d]["department_name"], len(c), sum(c))
            for (p, d), c in stays.items() if len(c) > 3]
    assert (P1, "Nikos", "P", "Χειρουργική Κλινική", 4, 4100.0) in agrees(R.frequent_groups(hospital), want)


def _rated(amka: str) -> list[dict]:
    return [RATING[x["hosp_id"]] for x in T["hospitalization_doctor"] if x["doctor_amka"] == amka and x["hosp_id"] in RATING]


def _means(rated: list[dict]) -> tuple:
    return tuple(sum(r[c] for r in rated) / len(rated) for c in ("medical_care_score", "overall_experience_score"))


def test_q4_bridge_average(hospital):
    agrees(R.bridge_average(hospital, A1), [("Alice", "Alpha", *_means(_rated(A1)))])
    assert _means(_rated(A1)) == (4.0, 4.5)  # stay 4 is unrated and does not count
    assert R.bridge_average(hospital, A4).count() == 0  # unrated doctor: no row


def test_q4_all_doctors(hospital):
    want = [(d["amka"], STAFF[d["amka"]]["first_name"], STAFF[d["amka"]]["last_name"], *_means(_rated(d["amka"])))
            for d in T["doctor"] if _rated(d["amka"])]
    assert {r[0] for r in agrees(R.bridge_average(hospital), want)} == {A1, A2}


def test_q5_filtered_leaderboard(hospital):
    surgical = {c["procedure_code"] for c in T["procedure_catalog"] if c["procedure_category"] == "SURGICAL"}
    led = Counter(e["chief_surgeon_amka"] for e in T["procedure_event"] if e["procedure_code"] in surgical)
    want = [(a, STAFF[a]["first_name"], STAFF[a]["last_name"], STAFF[a]["age"], n) for a, n in led.items() if STAFF[a]["age"] < 35]
    got = agrees(R.filtered_leaderboard(hospital), want)
    assert got[0][0] == A1 and got[0][4] == 2


def _stay(h: dict, discharge: bool = True) -> tuple:
    desc = lambda c: (c, ICD[c]["icd10_description"]) if c else (None, None)
    r = RATING.get(h["hosp_id"])
    score = sum(r[c] for c in SCORES) / 5 if r else None
    out = desc(h["discharge_icd10_code"]) if discharge else ()
    return (h["hosp_id"], h["admission_ts"], h["discharge_ts"], *desc(h["admission_icd10_code"]), *out, h["total_cost"], score)


def _newest_first(stays) -> list[dict]:
    return sorted(sorted(stays, key=lambda h: h["hosp_id"]), key=lambda h: h["admission_ts"], reverse=True)


def test_q6_entity_timeline(hospital):
    mine = _newest_first(h for h in T["hospitalization"] if h["patient_amka"] == P1)
    got = agrees(R.entity_timeline(hospital, P1), [_stay(h) for h in mine], ordered=True)
    assert [r[0] for r in got] == [4, 7, 3, 2, 1]
    assert got[0][8] is None and got[-1][8] == 4.2  # an unrated stay; (5+4+3+4+5)/5


def test_q6_all_patients(hospital):
    patients = sorted({h["patient_amka"] for h in T["hospitalization"]})
    want = [(p, *_stay(h)) for p in patients for h in _newest_first(x for x in T["hospitalization"] if x["patient_amka"] == p)]
    agrees(R.entity_timeline(hospital), want, ordered=True)


def test_q6b_reduced(hospital):
    df = R.entity_timeline(hospital, P1, with_discharge=False)
    assert df.columns == ["hosp_id", "admission_ts", "discharge_ts", "icd10_code", "icd10_description", "total_cost", "avg_score"]
    mine = _newest_first(h for h in T["hospitalization"] if h["patient_amka"] == P1)
    agrees(df, [_stay(h, discharge=False) for h in mine], ordered=True)


def test_q7_dual_optional_counts(hospital):
    want = []
    for s in T["active_substance"]:
        allergic = {a["patient_amka"] for a in T["patient_allergy"] if a["substance_id"] == s["substance_id"]}
        drugs = {d["drug_id"] for d in T["drug_active_substance"] if d["substance_id"] == s["substance_id"]}
        want.append((s["substance_name"], len(allergic), len(drugs)))
    assert ("Unused", 0, 0) in agrees(R.dual_optional_counts(hospital), want)


def test_q8_not_assigned(hospital):
    there = {s["shift_id"] for s in T["department_shift"] if s["shift_date"] == dt.date(2025, 5, 20) and s["department_id"] == 1}
    busy = {a["personnel_amka"] for a in T["shift_assignment"] if a["shift_id"] in there}
    want = [(p["amka"], p["first_name"], p["last_name"], p["personnel_type"]) for p in T["personnel"] if p["amka"] not in busy]
    got = agrees(R.not_assigned(hospital, dt.date(2025, 5, 20), 1), want)
    assert len(got) == 7 and A2 not in {r[0] for r in got}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_q9_equal_total_pairs(spark, hospital, zone):
    total = Counter()
    for h in T["hospitalization"]:
        total[h["patient_amka"], h["admission_ts"].year] += days(h["admission_ts"], h["discharge_ts"] or AS_OF_TS)
    long = sorted((p, y, n) for (p, y), n in total.items() if n > 15)
    want = [(a[0], b[0], a[2], a[1]) for a, b in itertools.combinations(long, 2) if a[1:] == b[1:]]
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = agrees(R.equal_total_pairs(hospital, as_of=AS_OF_TS), want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    assert ("01234567891", "11111111111", 20, 2025) in got


def test_q10_substance_cooccurrence(hospital):
    holds = defaultdict(set)
    for d in T["drug_active_substance"]:
        holds[d["drug_id"]].add(d["substance_id"])
    basket = defaultdict(set)
    for rx in T["prescription"]:
        basket[rx["hosp_id"]] |= holds[rx["drug_id"]]
    pairs = Counter(p for items in basket.values() for p in itertools.combinations(sorted(items), 2))
    name = {s["substance_id"]: s["substance_name"] for s in T["active_substance"]}
    top = sorted(pairs.items(), key=lambda x: (-x[1], x[0]))[:3]
    got = agrees(R.substance_cooccurrence(hospital), [(name[a], name[b], n) for (a, b), n in top], ordered=True)
    # (2,3) is in stays 1, 4 and 5; (1,2) in stays 1 and 2; (1,3) in stay 1 only
    assert [r[2] for r in got] == [3, 2, 1]


@pytest.mark.parametrize("gap", [0, 1, 5])
def test_q11_surgeons_below_max(hospital, gap):
    led = Counter(e["chief_surgeon_amka"] for e in T["procedure_event"] if e["start_ts"].year == AS_OF.year)
    most = max(led.values())
    agrees(R.surgeons_below_max(hospital, gap, as_of=AS_OF), [(a, n, most) for a, n in led.items() if n <= most - gap])


def test_q12_weekly_roster(hospital):
    week = dt.date(2025, 5, 20).isocalendar()[:2]
    spec = {d["amka"]: d["specialization"] for d in T["doctor"]}
    rank = {n["amka"]: n["degree"] for n in T["nurse"]}
    role = {a["amka"]: a["admin_role"] for a in T["administrative_staff"]}
    count = Counter()
    for s, a in itertools.product(T["department_shift"], T["shift_assignment"]):
        if s["shift_id"] == a["shift_id"] and s["shift_date"].isocalendar()[:2] == week:
            p, d = a["personnel_amka"], s["department_id"]
            count[d, DEPT[d]["department_name"], s["shift_date"], s["shift_type"], STAFF[p]["personnel_type"], spec.get(p), rank.get(p), role.get(p)] += 1
    got = agrees(R.weekly_roster(hospital, dt.date(2025, 5, 20)), [(*k, n) for k, n in count.items()])
    assert {r[2] for r in got} == {dt.date(2025, 5, 19), dt.date(2025, 5, 20), dt.date(2025, 5, 25)}  # the 18th is a Sunday


def test_q13_supervisor_closure(hospital):
    circle = {A7, "00000000008"}
    acyclic = dict(hospital, doctor=hospital["doctor"].filter(~hospital["doctor"].amka.isin(*circle)))
    doc = {d["amka"]: d for d in T["doctor"] if d["amka"] not in circle}
    want = []
    for a in sorted(doc):
        up, level = doc[a]["supervisor_amka"], 1
        while up is not None:
            want.append((a, STAFF[a]["first_name"], STAFF[a]["last_name"], up, STAFF[up]["first_name"], STAFF[up]["last_name"], doc[up]["doctor_rank"], level))
            up, level = doc[up]["supervisor_amka"], level + 1
    got = agrees(R.supervisor_closure(acyclic), want, ordered=True)
    assert [(r[3], r[7]) for r in got if r[0] == A4] == [(A1, 1), (A2, 2), ("00000000003", 3)]


def test_q13_cycle_raises_instead_of_looping(hospital):
    with pytest.raises(CycleFound):
        R.supervisor_closure(hospital)


def test_q14_equal_consecutive_years(hospital):
    n = Counter((h["admission_icd10_code"], h["admission_ts"].year) for h in T["hospitalization"])
    want = [(c, ICD[c]["icd10_description"], y, y + 1, k) for (c, y), k in n.items() if k >= 5 and n[c, y + 1] == k]
    assert agrees(R.equal_consecutive_years(hospital), want) == [("C02", "Neoplasm", 2022, 2023, 5)]


def _triage(stays: list[dict], names: dict) -> list[tuple]:
    """One entry per visit and stay within a day of it (or one without), grouped by level and department name."""
    cells = defaultdict(list)
    for v in T["emergency_visit"]:
        hits = [h for h in stays if h["patient_amka"] == v["patient_amka"] and dt.timedelta() <= h["admission_ts"] - v["arrival_ts"] <= dt.timedelta(hours=24)]
        for h in hits or [None]:
            cells[v["emergency_level"], names.get(h["department_id"]) if h else None].append((v, h))
    out = []
    for (level, name), pairs in cells.items():
        visits = {v["visit_id"] for v, _ in pairs}
        waits = [(v["service_start_ts"] - v["arrival_ts"]) // dt.timedelta(minutes=1) for v, _ in pairs if v["service_start_ts"]]
        cent = Decimal("0.01")
        mean = (Decimal(sum(waits)) / len(waits)).quantize(cent, ROUND_HALF_UP) if waits else None
        kept = sum(v["disposition"] == "HOSPITALIZED" for v, _ in pairs)
        share = (Decimal(100 * kept) / len(visits)).quantize(cent, ROUND_HALF_UP)
        out.append((level, len(visits), mean, share, name or "NO_ADMISSION", sum(h is not None for _, h in pairs)))
    return out


DEPT_NAMES = {d["department_id"]: d["department_name"] for d in T["department"]}


def test_q15_triage_referral(hospital):
    got = agrees(R.triage_referral(hospital), _triage(T["hospitalization"], DEPT_NAMES))
    # visit 2 matches two stays (departments 1 and 2); visit 1 one stay in department 1
    assert sorted(r for r in got if r[0] == 2) == [(2, 1, None, 100.0, "Καρδιολογική Κλινική", 1), (2, 2, 30.0, 100.0, "Χειρουργική Κλινική", 2)]
    assert [r for r in got if r[0] == 1] == [(1, 1, 5.0, 0.0, "Καρδιολογική Κλινική", 1)]  # admission exactly 24 h later counts
    assert [r for r in got if r[0] == 3] == [(3, 1, 1.0, 0.0, "NO_ADMISSION", 0)]  # 119 s is one whole minute


def test_q15_counts_referrals_by_department_key(spark, hospital):
    # a stay whose department row is missing still counts as a referral, under the NO_ADMISSION label
    row = (50, "11111111111", 9, 2, "K2", dt.datetime(2025, 5, 1, 12), None, "A00", None, Decimal("1.00"))
    extra = spark.createDataFrame([row], SCHEMAS["hospitalization"])
    t = dict(hospital, hospitalization=hospital["hospitalization"].unionByName(extra))
    stays = [*T["hospitalization"], dict(zip(SCHEMAS["hospitalization"].fieldNames(), row, strict=True))]
    assert (3, 1, 1.0, 0.0, "NO_ADMISSION", 1) in agrees(R.triage_referral(t), _triage(stays, DEPT_NAMES))


def test_q15_first_match(hospital):
    got = rows_of(R.triage_referral(hospital, first_match=True))
    assert sum(r[5] for r in got if r[0] == 2) == 2  # each visit keeps one stay
