"""The fifteen reports over the hospital schema.

Each report takes ``tables`` (anything mapping a table name to a DataFrame,
e.g. a ``TableSet`` with the hospital ``SCHEMAS``) and the report's literals
as arguments, and returns a lazy DataFrame with the reference's output
columns.  Clock-dependent literals (``CURRENT_DATE``) are an ``as_of``
argument that defaults to the session's current date.

Plans, in one line each (the details are in the operator docstrings):
Q1  filter -> broadcast ken -> join patient -> partial+final aggregate -> names
Q2  per-doctor shift flag and distinct procedure count, each pre-aggregated
Q3  aggregate stays per (patient, department) first, HAVING, then names
Q4  one doctor's evaluations through the bridge; exact dialect averages
Q5  per-chief surgical counts, then the age filter on staff
Q6  one patient's stays; code lookups in two roles; NULL-propagating mean
Q7  two distinct counts from two pre-aggregated branches
Q8  anti join against the day's roster
Q9  patient-year day totals, then salted self pairs on (year, total)
Q10 distinct substances per stay, pair counts, top-k, names last
Q11 per-chief counts against the maximum, a scalar subquery
Q12 week as a date range, roster joins, subtype left joins, grouped count
Q13 iterative ancestor walk with checkpoints
Q14 per-code yearly counts, next year via lead over each code's years
Q15 bucketed interval left join of visits to stays, grouped ratios
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.calendar import days_between, in_week, in_year, minutes_between, ntz_literal
from wardline.functions.numeric import dialect_avg, greatest_strict, ratio
from wardline.operators.hierarchy import ancestors
from wardline.operators.joins import anti_join, interval_join
from wardline.operators.relate import (
    consecutive_equal,
    distinct_counts,
    equal_measure_pairs,
    flag_any,
    gap_to_max,
    lookup,
    pair_cooccurrence,
)

Tables = Mapping[str, DataFrame]

# --- fixed values: the reports' literals, as the reference states them (defaults of the arguments)
MIN_STAYS = 3  # Q3: more than 3 stays
MAX_AGE = 35  # Q5: younger than 35
SURGICAL = "SURGICAL"  # Q5: procedure category
MIN_TOTAL_DAYS = 15  # Q9: more than 15 days
TOP_PAIRS = 3  # Q10: LIMIT 3
GAP_TO_MAX = 5  # Q11: at most the maximum minus 5
MIN_ADMISSIONS = 5  # Q14: at least 5 admissions
REFERRAL_HOURS = 24  # Q15: admission within 24 hours of arrival


def _year(as_of: dt.date | None, df: DataFrame) -> int:
    """Year of ``as_of``, or of the session's current date (one value, no table read)."""
    if as_of is None:
        as_of = df.sparkSession.range(1).select(F.current_date()).first()[0]
    return as_of.year


def _text_eq(col: str, value: str, collation: str | None) -> Column:
    """Equality on human text; with ``collation`` (e.g. ``UNICODE_CI_AI_RTRIM``) case/accent-insensitive."""
    if collation:
        return F.collate(F.col(col), collation) == F.collate(F.lit(value), collation)
    return F.col(col) == value


# ---------------------------------------------------------------- Q1


def revenue_rollup(tables: Tables) -> DataFrame:
    """Q1: per department, discharge year, cost code and insurer: stays, base, overstay and total revenue."""
    h = tables["hospitalization"].filter(F.col("discharge_ts").isNotNull()).select(
        "hosp_id", "patient_amka", "department_id", "ken_code", "admission_ts", "discharge_ts", "total_cost"
    )
    ken = tables["ken"].select("ken_code", "basic_cost", "mean_duration_days", "extra_daily_cost")
    pat = tables["patient"].select(F.col("patient_amka").alias("p_amka"), "insurance_provider")
    j = lookup(h, ken, "ken_code")
    j = j.join(pat, j.patient_amka == pat.p_amka)
    over = greatest_strict(F.lit(0), days_between("admission_ts", "discharge_ts") - F.col("mean_duration_days"))
    agg = j.groupBy(
        "department_id", F.year("discharge_ts").alias("hosp_year"), "ken_code", "insurance_provider"
    ).agg(
        F.count("hosp_id").alias("total_hospitalizations"),
        F.sum("basic_cost").alias("total_basic_cost"),
        F.sum(over * F.col("extra_daily_cost")).alias("total_extra_cost"),
        F.sum("total_cost").alias("final_total_revenue"),
    )
    # department and ken names are 1:1 with their keys; attach them to the aggregate rows only
    dept = tables["department"].select("department_id", "department_name")
    names = tables["ken"].select("ken_code", "ken_description")
    out = lookup(lookup(agg, dept, "department_id"), names, "ken_code")
    return out.select(
        "department_name", "hosp_year", "ken_code", "ken_description", "insurance_provider",
        "total_hospitalizations", "total_basic_cost", "total_extra_cost", "final_total_revenue",
    ).orderBy("department_name", "hosp_year", "ken_code", "insurance_provider")


# ---------------------------------------------------------------- Q2


def roster_flag(tables: Tables, specialization: str, *, as_of: dt.date | None = None,
                collation: str | None = None) -> DataFrame:
    """Q2: doctors of a specialization, YES/NO shift this year, distinct procedures led (any year)."""
    d = tables["doctor"].filter(_text_eq("specialization", specialization, collation)).select("amka", "specialization")
    p = tables["personnel"].select("amka", "first_name", "last_name")
    base = d.join(p, "amka")
    shifts = tables["department_shift"].filter(in_year("shift_date", _year(as_of, tables["department_shift"]), timestamp=False)).select("shift_id")
    worked = tables["shift_assignment"].join(shifts, "shift_id", "left_semi").select("personnel_amka")
    out = flag_any(base, "amka", worked, "personnel_amka", "had_shift_current_year")
    out = distinct_counts(
        out, "amka", [(tables["procedure_event"], "chief_surgeon_amka", "procedure_event_id", "primary_surgeries_count")]
    )
    return out.select("amka", "first_name", "last_name", "specialization", "had_shift_current_year",
                      "primary_surgeries_count")


# ---------------------------------------------------------------- Q3


def frequent_groups(tables: Tables, min_stays: int = MIN_STAYS) -> DataFrame:
    """Q3: (patient, department) pairs with more than ``min_stays`` stays, with their total cost."""
    per = (
        tables["hospitalization"].groupBy("patient_amka", "department_id")
        .agg(F.count("hosp_id").alias("total_hospitalizations"), F.sum("total_cost").alias("total_hospitalization_cost"))
        .filter(F.col("total_hospitalizations") > min_stays)
    )
    p = tables["patient"].select("patient_amka", "first_name", "last_name")
    d = tables["department"].select("department_id", "department_name")
    return (
        lookup(per.join(p, "patient_amka"), d, "department_id")
        .select("patient_amka", "first_name", "last_name", "department_name", "total_hospitalizations",
                "total_hospitalization_cost")
        .orderBy(F.col("total_hospitalizations").desc(), "patient_amka", "department_name")
    )


# ---------------------------------------------------------------- Q4


def bridge_average(tables: Tables, doctor_amka: str | None = None) -> DataFrame:
    """Q4 (and Q4b): a doctor's mean medical and overall score over the stays they are linked to.

    With ``doctor_amka`` the report is that one doctor's (the filter reaches
    every scan); without it, one row per rated doctor, with ``amka`` first.
    """
    one = (lambda c: F.col(c) == doctor_amka) if doctor_amka is not None else (lambda c: F.lit(True))
    d = tables["doctor"].filter(one("amka")).select("amka")
    p = tables["personnel"].filter(one("amka")).select("amka", "first_name", "last_name")
    hd = tables["hospitalization_doctor"].filter(one("doctor_amka")).select("hosp_id", "doctor_amka")
    e = tables["hospitalization_evaluation"].select("hosp_id", "medical_care_score", "overall_experience_score")
    j = d.join(p, "amka").join(hd, F.col("amka") == F.col("doctor_amka")).join(e, "hosp_id")
    agg = j.groupBy("amka", "first_name", "last_name").agg(
        F.sum("medical_care_score").alias("__m"), F.count("medical_care_score").alias("__mn"),
        F.sum("overall_experience_score").alias("__o"), F.count("overall_experience_score").alias("__on"),
    )
    keys = ["first_name", "last_name"] if doctor_amka is not None else ["amka", "first_name", "last_name"]
    return agg.select(
        *keys,
        dialect_avg("__m", "__mn", 4).alias("avg_medical_care"),
        dialect_avg("__o", "__on", 4).alias("avg_overall_experience"),
    )


# ---------------------------------------------------------------- Q5


def filtered_leaderboard(tables: Tables, max_age: int = MAX_AGE, category: str = SURGICAL) -> DataFrame:
    """Q5: staff younger than ``max_age`` by number of procedures of ``category`` led as chief."""
    cat = tables["procedure_catalog"].filter(F.col("procedure_category") == category).select("procedure_code")
    pe = lookup(tables["procedure_event"].select("procedure_event_id", "procedure_code", "chief_surgeon_amka"), cat,
                "procedure_code", "left_semi")
    per = pe.groupBy("chief_surgeon_amka").agg(F.count("procedure_event_id").alias("total_surgeries"))
    p = tables["personnel"].filter(F.col("age") < max_age).select("amka", "first_name", "last_name", "age")
    d = tables["doctor"].select("amka")
    return (
        p.join(d, "amka").join(per, F.col("amka") == F.col("chief_surgeon_amka"))
        .select("amka", "first_name", "last_name", "age", "total_surgeries")
        .orderBy(F.col("total_surgeries").desc(), "amka")
    )


# ---------------------------------------------------------------- Q6


def entity_timeline(tables: Tables, patient_amka: str | None = None, *, with_discharge: bool = True, ordered: bool = True) -> DataFrame:
    """Q6: a patient's stays, newest first, with admission/discharge diagnoses and the mean score.

    With ``patient_amka`` the report is that one patient's (the filter reaches
    the scan); without it, every patient's stays, with ``patient_amka`` first.
    ``with_discharge=False`` is the reduced Q6b (no discharge lookup, 7 columns).
    The mean is NULL for an unrated stay (any NULL score propagates).
    ``ordered=False`` leaves out the global sort, for whole tables that go on to a file.
    """
    stays = tables["hospitalization"]
    if patient_amka is not None:
        stays = stays.filter(F.col("patient_amka") == patient_amka)
    h = stays.select(
        "patient_amka", "hosp_id", "admission_ts", "discharge_ts", "admission_icd10_code", "discharge_icd10_code",
        "total_cost"
    )
    icd = tables["icd10_diagnosis"]
    icd_in = icd.select(F.col("icd10_code").alias("admission_diagnosis_code"),
                        F.col("icd10_description").alias("admission_diagnosis_desc"))
    e = tables["hospitalization_evaluation"].select(
        F.col("hosp_id").alias("e_hosp"),
        (F.col("medical_care_score") + F.col("nursing_care_score") + F.col("cleanliness_score")
         + F.col("food_score") + F.col("overall_experience_score")).alias("__score_sum"),
    )
    j = lookup(h, icd_in, [("admission_icd10_code", "admission_diagnosis_code")])
    cols = ["hosp_id", "admission_ts", "discharge_ts", "admission_diagnosis_code", "admission_diagnosis_desc"]
    if with_discharge:
        icd_out = icd.select(F.col("icd10_code").alias("discharge_diagnosis_code"),
                             F.col("icd10_description").alias("discharge_diagnosis_desc"))
        j = lookup(j, icd_out, [("discharge_icd10_code", "discharge_diagnosis_code")], "left")
        cols += ["discharge_diagnosis_code", "discharge_diagnosis_desc"]
    j = j.join(e, j.hosp_id == e.e_hosp, "left")
    avg = (F.col("__score_sum").cast("decimal(12,0)") / F.lit(5)).cast("decimal(12,5)")
    name = "average_evaluation_score" if with_discharge else "avg_score"
    lead = [] if patient_amka is not None else ["patient_amka"]
    out = j.select(*lead, *cols, "total_cost", avg.alias(name))
    if not with_discharge:
        out = out.withColumnRenamed("admission_diagnosis_code", "icd10_code").withColumnRenamed(
            "admission_diagnosis_desc", "icd10_description")
    return out.orderBy(*lead, F.col("admission_ts").desc(), "hosp_id") if ordered else out


# ---------------------------------------------------------------- Q7


def dual_optional_counts(tables: Tables) -> DataFrame:
    """Q7: per substance, distinct allergic patients and distinct drugs containing it (zeros kept)."""
    s = tables["active_substance"].select("substance_id", "substance_name")
    out = distinct_counts(s, "substance_id", [
        (tables["patient_allergy"], "substance_id", "patient_amka", "allergic_patients_count"),
        (tables["drug_active_substance"], "substance_id", "drug_id", "drugs_containing_count"),
    ])
    return out.select("substance_name", "allergic_patients_count", "drugs_containing_count").orderBy(
        F.col("allergic_patients_count").desc(), "substance_name")


# ---------------------------------------------------------------- Q8


def not_assigned(tables: Tables, day: dt.date, department_id: int) -> DataFrame:
    """Q8: all staff with no shift in ``department_id`` on ``day`` (any department's staff)."""
    ds = tables["department_shift"].filter((F.col("shift_date") == F.lit(day)) & (F.col("department_id") == department_id))
    busy = tables["shift_assignment"].join(ds.select("shift_id"), "shift_id", "left_semi").select("personnel_amka")
    p = tables["personnel"].select("amka", "first_name", "last_name", "personnel_type")
    return anti_join(p, busy, [("amka", "personnel_amka")])


# ---------------------------------------------------------------- Q9


def equal_total_pairs(tables: Tables, min_days: int = MIN_TOTAL_DAYS, *, as_of: dt.datetime | None = None, ordered: bool = True) -> DataFrame:
    """Q9: patient pairs with the same total stay days (> ``min_days``) in the same admission year.

    An open stay runs to ``as_of`` (default: now); a stay counts wholly in its admission year.
    """
    end = F.coalesce(F.col("discharge_ts"), ntz_literal(as_of) if as_of else F.localtimestamp())
    totals = (
        tables["hospitalization"]
        .groupBy("patient_amka", F.year("admission_ts").alias("hosp_year"))
        .agg(F.sum(days_between("admission_ts", end)).alias("total_days"))
        .filter(F.col("total_days") > min_days)
    )
    pairs = equal_measure_pairs(totals, "patient_amka", ["hosp_year"], "total_days")
    out = pairs.select(
        F.col("patient_amka_a").alias("patient_A"), F.col("patient_amka_b").alias("patient_B"), "total_days", "hosp_year"
    )
    return out.orderBy(F.col("total_days").desc(), "hosp_year", "patient_A", "patient_B") if ordered else out


# ---------------------------------------------------------------- Q10


def substance_cooccurrence(tables: Tables, top: int = TOP_PAIRS) -> DataFrame:
    """Q10: the ``top`` substance pairs prescribed together in the most stays (ties by substance id)."""
    rx = tables["prescription"].select("hosp_id", "patient_amka", "drug_id")
    das = tables["drug_active_substance"].select("drug_id", "substance_id")
    items = rx.join(das, "drug_id").select("hosp_id", "patient_amka", "substance_id")
    top_pairs = pair_cooccurrence(items, ["hosp_id", "patient_amka"], "substance_id", top=top)
    s = tables["active_substance"]
    s1 = s.select(F.col("substance_id").alias("s1"), F.col("substance_name").alias("substance_1"))
    s2 = s.select(F.col("substance_id").alias("s2"), F.col("substance_name").alias("substance_2"))
    return (
        top_pairs.join(s1, top_pairs.item_1 == s1.s1).join(s2, top_pairs.item_2 == s2.s2)
        .orderBy(F.col("co_occurrence_count").desc(), "item_1", "item_2")
        .select("substance_1", "substance_2", "co_occurrence_count")
    )


# ---------------------------------------------------------------- Q11


def surgeons_below_max(tables: Tables, gap: int = GAP_TO_MAX, *, as_of: dt.date | None = None) -> DataFrame:
    """Q11: chiefs of this year whose procedure count is at most the year's maximum minus ``gap``."""
    counts = (
        tables["procedure_event"].filter(in_year("start_ts", _year(as_of, tables["procedure_event"])))
        .groupBy("chief_surgeon_amka").agg(F.count("procedure_event_id").alias("num_surgeries"))
    )
    return gap_to_max(counts, "num_surgeries", gap, "max_surg").orderBy(
        F.col("num_surgeries").desc(), "chief_surgeon_amka")


# ---------------------------------------------------------------- Q12


def weekly_roster(tables: Tables, week_of: dt.date) -> DataFrame:
    """Q12: assigned head-count per department, day, shift and staff attributes in the week of ``week_of``."""
    ds = tables["department_shift"].filter(in_week("shift_date", week_of, timestamp=False)).select(
        "shift_id", "department_id", "shift_date", "shift_type")
    d = tables["department"].select("department_id", "department_name")
    sa = tables["shift_assignment"].select("shift_id", "personnel_amka")
    p = tables["personnel"].select(F.col("amka"), "personnel_type")
    doc = tables["doctor"].select(F.col("amka").alias("doc_amka"), "specialization")
    nur = tables["nurse"].select(F.col("amka").alias("nurse_amka"), F.col("degree").alias("nurse_rank"))
    adm = tables["administrative_staff"].select(F.col("amka").alias("adm_amka"), "admin_role")
    j = lookup(ds, d, "department_id").join(sa, "shift_id")
    j = j.join(p, j.personnel_amka == p.amka)
    j = j.join(doc, j.amka == doc.doc_amka, "left").join(nur, j.amka == nur.nurse_amka, "left")
    j = j.join(adm, j.amka == adm.adm_amka, "left")
    return (
        j.groupBy("department_id", "department_name", "shift_date", "shift_type", "personnel_type", "specialization",
                  "nurse_rank", "admin_role")
        .agg(F.count("personnel_amka").alias("assigned_count"))
        .orderBy("department_id", "shift_date", "shift_type", "personnel_type")
    )


# ---------------------------------------------------------------- Q13


def supervisor_closure(tables: Tables, *, ordered: bool = True) -> DataFrame:
    """Q13: every doctor with each supervisor above them, level 1 (direct) upward."""
    doc = tables["doctor"].select("amka", "supervisor_amka", "doctor_rank")
    walk = ancestors(doc, "amka", "supervisor_amka")
    per = tables["personnel"].select("amka", "first_name", "last_name")
    p1 = per.select(F.col("amka").alias("k1"), F.col("first_name").alias("doc_first_name"),
                    F.col("last_name").alias("doc_last_name"))
    d2 = doc.select(F.col("amka").alias("k2"), F.col("doctor_rank").alias("sup_rank"))
    p2 = per.select(F.col("amka").alias("k3"), F.col("first_name").alias("sup_first_name"),
                    F.col("last_name").alias("sup_last_name"))
    out = (
        walk.join(p1, walk.origin_amka == p1.k1).join(d2, walk.ancestor_amka == d2.k2).join(p2, F.col("k2") == p2.k3)
        .select(F.col("origin_amka").alias("original_doctor_amka"), "doc_first_name", "doc_last_name",
                F.col("ancestor_amka").alias("supervisor_amka"), "sup_first_name", "sup_last_name", "sup_rank",
                F.col("level").alias("hierarchy_level"))
    )
    return out.orderBy("original_doctor_amka", "hierarchy_level") if ordered else out


# ---------------------------------------------------------------- Q14


def equal_consecutive_years(tables: Tables, min_count: int = MIN_ADMISSIONS) -> DataFrame:
    """Q14: admission codes with the same count (>= ``min_count``) in two consecutive years."""
    counts = (
        tables["hospitalization"].groupBy(F.col("admission_icd10_code").alias("icd10"),
                                          F.year("admission_ts").alias("adm_year"))
        .agg(F.count(F.lit(1)).alias("num_admissions"))
        .filter(F.col("num_admissions") >= min_count)
    )
    pairs = consecutive_equal(counts, ["icd10"], "adm_year", "num_admissions")
    icd = tables["icd10_diagnosis"].select(F.col("icd10_code").alias("icd10"), "icd10_description")
    return (
        lookup(pairs, icd, "icd10")
        .select("icd10", "icd10_description", F.col("period_1").alias("year_1"), F.col("period_2").alias("year_2"),
                "num_admissions")
        .orderBy(F.col("num_admissions").desc(), "icd10", "year_1")
    )


# ---------------------------------------------------------------- Q15


def triage_summary(vd: DataFrame, referral_col: str = "department_name") -> DataFrame:
    """Per (level, department): distinct visits, mean wait, hospitalised percentage, referrals.

    ``vd`` holds one row per (visit, matched stay).  A visit matched by two stays
    counts twice in the sums and the mean but once in the distinct divisor, as
    in the reference, so the percentage can pass 100.  ``referrals_count``
    counts non-NULL ``referral_col`` (the matched stay's department key).
    """
    agg = vd.groupBy("emergency_level", "department_name").agg(
        F.count_distinct("visit_id").alias("total_visits"),
        F.sum("wait_time_mins").alias("__wsum"),
        F.count("wait_time_mins").alias("__wn"),
        F.sum(F.when(F.col("disposition") == "HOSPITALIZED", 1).otherwise(0)).alias("__hosp"),
        F.count(referral_col).alias("referrals_count"),
    )
    return agg.select(
        "emergency_level",
        "total_visits",
        dialect_avg("__wsum", "__wn", 2).alias("avg_wait_time_mins"),
        ratio("__hosp", "total_visits", 2, times=100).alias("hosp_percentage"),
        F.coalesce("department_name", F.lit("NO_ADMISSION")).alias("referred_department"),
        "referrals_count",
    ).orderBy("emergency_level", F.col("referrals_count").desc(), "referred_department")


def triage_referral(tables: Tables, hours: int = REFERRAL_HOURS, *, first_match: bool = False) -> DataFrame:
    """Q15: triage statistics, linking each visit to stays of the same patient admitted within ``hours``.

    ``first_match=True`` keeps only the earliest such stay per visit (so the
    percentage stays within 100); the default reproduces the reference.
    """
    v = tables["emergency_visit"].select(
        "visit_id", F.col("patient_amka").alias("v_patient"), "arrival_ts", "service_start_ts", "emergency_level",
        "disposition")
    h = tables["hospitalization"].select(
        "hosp_id", F.col("patient_amka").alias("h_patient"), "admission_ts", F.col("department_id").alias("h_dept"))
    vd = interval_join(v, h, keys=[("v_patient", "h_patient")], left_ts="arrival_ts", right_ts="admission_ts",
                       hours=hours)
    if first_match:
        w = Window.partitionBy("visit_id").orderBy(F.col("admission_ts").asc_nulls_last(), "hosp_id")
        vd = vd.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    d = tables["department"].select(F.col("department_id").alias("d_id"), "department_name")
    vd = lookup(vd, d, [("h_dept", "d_id")], "left").withColumn(
        "wait_time_mins", minutes_between("arrival_ts", "service_start_ts"))
    return triage_summary(vd, referral_col="h_dept")


REPORTS = {
    "Q1": revenue_rollup, "Q2": roster_flag, "Q3": frequent_groups, "Q4": bridge_average,
    "Q5": filtered_leaderboard, "Q6": entity_timeline, "Q7": dual_optional_counts, "Q8": not_assigned,
    "Q9": equal_total_pairs, "Q10": substance_cooccurrence, "Q11": surgeons_below_max, "Q12": weekly_roster,
    "Q13": supervisor_closure, "Q14": equal_consecutive_years, "Q15": triage_referral,
}
