"""The hospital schema: 30 tables and their declared constraints, as data.

Types map as follows: CHAR/VARCHAR/TEXT -> STRING (declared length kept for
the length audit), INT -> INT, BIGINT -> BIGINT, DECIMAL(p,s) -> DECIMAL(p,s),
DATE -> DATE, DATETIME -> TIMESTAMP_NTZ (zone-free), TIME -> STRING 'HH:mm:ss'.
Person keys (``amka``) are 11-character strings with leading zeros, never
numbers.

Fixed values below (column lists, key lists, domain lists in CHECKs and the
delete/update actions) must equal the declared schema for the audits to mean
the same thing; they are stated here in declaration order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from wardline.operators.maintain import ForeignKey


@dataclass(frozen=True)
class Col:
    name: str
    kind: str  # 'S' string, 'I' int, 'L' bigint, 'D' date, 'TS' datetime, 'T' time, 'DEC' decimal
    nullable: bool = False
    length: int | None = None  # CHAR/VARCHAR limit; None for TEXT and non-strings
    precision: tuple[int, int] | None = None

    def spark_type(self) -> T.DataType:
        if self.kind in ("S", "T"):
            return T.StringType()
        if self.kind == "I":
            return T.IntegerType()
        if self.kind == "L":
            return T.LongType()
        if self.kind == "D":
            return T.DateType()
        if self.kind == "TS":
            return T.TimestampNTZType()
        if self.kind == "DEC":
            p, s = self.precision or (10, 0)
            return T.DecimalType(p, s)
        raise ValueError(self.kind)


def s(name: str, n: int | None, nullable: bool = False) -> Col:
    return Col(name, "S", nullable, n)


def i(name: str, nullable: bool = False) -> Col:
    return Col(name, "I", nullable)


def big(name: str, nullable: bool = False) -> Col:
    return Col(name, "L", nullable)


def dec(name: str, p: int, sc: int, nullable: bool = False) -> Col:
    return Col(name, "DEC", nullable, precision=(p, sc))


def date(name: str, nullable: bool = False) -> Col:
    return Col(name, "D", nullable)


def ts(name: str, nullable: bool = False) -> Col:
    return Col(name, "TS", nullable)


def time_(name: str, nullable: bool = False) -> Col:
    return Col(name, "T", nullable, 8)


# --- fixed values: table columns in declaration order -----------------------
TABLES: dict[str, list[Col]] = {
    "personnel": [s("amka", 11), s("first_name", 80), s("last_name", 80), i("age"), s("email", 255),
                  s("phone_number", 30), date("hiring_date"), s("personnel_type", 20)],
    "doctor": [s("amka", 11), s("license_number", 50), s("specialization", 120), s("doctor_rank", 20),
               s("supervisor_amka", 11, True)],
    "nurse": [s("amka", 11), s("degree", 20), i("department_id")],
    "administrative_staff": [s("amka", 11), s("admin_role", 120), s("office_work", 120), i("department_id")],
    "department": [i("department_id"), s("department_name", 120), s("description", None, True), i("bed_capacity"),
                   s("floor_building", 120), s("manager_doctor_amka", 11, True)],
    "doctor_department": [s("doctor_amka", 11), i("department_id")],
    "bed": [i("bed_id"), i("department_id"), s("bed_type", 20), s("bed_status", 20)],
    "patient": [s("patient_amka", 11), s("first_name", 80), s("last_name", 80), s("father_name", 80), i("age"),
                s("gender", 20), dec("weight_kg", 5, 2, True), dec("height_cm", 5, 2, True), s("address_line", 255),
                s("phone_number", 30), s("email", 255, True), s("profession", 120, True), s("nationality", 80, True),
                s("insurance_provider", 120)],
    "emergency_contact": [s("patient_amka", 11), s("first_name", 80), s("last_name", 80), s("phone_number", 30),
                          s("email", 255, True)],
    "icd10_diagnosis": [s("icd10_code", 20), s("icd10_description", 500)],
    "ken": [s("ken_code", 20), s("ken_description", 500), dec("basic_cost", 12, 2), i("mean_duration_days"),
            dec("extra_daily_cost", 12, 2)],
    "operating_place": [i("place_id"), s("place_name", 120), s("place_type", 30), s("place_status", 20)],
    "department_shift": [big("shift_id"), i("department_id"), date("shift_date"), s("shift_type", 20),
                         time_("start_time"), time_("end_time")],
    "shift_assignment": [big("shift_id"), s("personnel_amka", 11), s("assigned_role", 40, True)],
    "emergency_visit": [big("visit_id"), s("patient_amka", 11), s("triage_nurse_amka", 11), ts("arrival_ts"),
                        s("symptoms", None), i("emergency_level"), ts("service_start_ts", True), s("disposition", 20),
                        s("discharge_instructions", None, True)],
    "hospitalization": [big("hosp_id"), s("patient_amka", 11), i("department_id"), i("bed_id"), s("ken_code", 20),
                        ts("admission_ts"), ts("discharge_ts", True), s("admission_icd10_code", 20),
                        s("discharge_icd10_code", 20, True), dec("total_cost", 12, 2)],
    "hospitalization_doctor": [big("hosp_id"), s("doctor_amka", 11)],
    "lab_test_catalog": [s("test_code", 30), s("test_name", 255), s("test_type", 80)],
    "lab_test": [big("test_id"), big("hosp_id"), s("test_code", 30), s("ordered_by_doctor_amka", 11),
                 ts("test_datetime"), s("result_text", None, True)],
    "procedure_catalog": [s("procedure_code", 30), s("procedure_name", 255), s("procedure_category", 20),
                          s("required_place_type", 30)],
    "procedure_event": [big("procedure_event_id"), big("hosp_id"), s("procedure_code", 30), i("place_id"),
                        s("chief_surgeon_amka", 11), ts("start_ts"), ts("end_ts"), i("actual_duration_min")],
    "procedure_participant": [big("procedure_event_id"), s("personnel_amka", 11)],
    "drug": [s("drug_id", 80), s("drug_name", 255)],
    "active_substance": [big("substance_id"), s("substance_name", 255)],
    "drug_active_substance": [s("drug_id", 80), big("substance_id")],
    "patient_allergy": [s("patient_amka", 11), big("substance_id")],
    "prescription": [big("prescription_id"), big("hosp_id"), s("patient_amka", 11), s("doctor_amka", 11),
                     s("drug_id", 80), s("dosage", 120), s("frequency", 120), ts("start_datetime"),
                     ts("end_datetime", True)],
    "hospitalization_evaluation": [big("hosp_id"), date("evaluation_date"), i("medical_care_score"),
                                   i("nursing_care_score"), i("cleanliness_score"), i("food_score"),
                                   i("overall_experience_score"), s("comments", None, True)],
    "image_asset": [big("image_id"), s("image_url", 500), s("alt_text", 500)],
    "entity_image": [s("entity_name", 64), s("entity_pk", 64), big("image_id"), s("entity_description", None, True)],
}

# --- fixed values: primary keys ---------------------------------------------
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "personnel": ("amka",), "doctor": ("amka",), "nurse": ("amka",), "administrative_staff": ("amka",),
    "department": ("department_id",), "doctor_department": ("doctor_amka", "department_id"), "bed": ("bed_id",),
    "patient": ("patient_amka",),
    "emergency_contact": ("patient_amka", "first_name", "last_name", "phone_number"),
    "icd10_diagnosis": ("icd10_code",), "ken": ("ken_code",), "operating_place": ("place_id",),
    "department_shift": ("shift_id",), "shift_assignment": ("shift_id", "personnel_amka"),
    "emergency_visit": ("visit_id",), "hospitalization": ("hosp_id",),
    "hospitalization_doctor": ("hosp_id", "doctor_amka"), "lab_test_catalog": ("test_code",),
    "lab_test": ("test_id",), "procedure_catalog": ("procedure_code",), "procedure_event": ("procedure_event_id",),
    "procedure_participant": ("procedure_event_id", "personnel_amka"), "drug": ("drug_id",),
    "active_substance": ("substance_id",), "drug_active_substance": ("drug_id", "substance_id"),
    "patient_allergy": ("patient_amka", "substance_id"), "prescription": ("prescription_id",),
    "hospitalization_evaluation": ("hosp_id",), "image_asset": ("image_id",),
    "entity_image": ("entity_name", "entity_pk", "image_id"),
}

# --- fixed values: unique constraints ---------------------------------------
UNIQUES: list[tuple[str, tuple[str, ...]]] = [
    ("personnel", ("email",)),
    ("doctor", ("license_number",)),
    ("department", ("department_name",)),
    ("department", ("manager_doctor_amka",)),
    ("patient", ("email",)),
    ("operating_place", ("place_name",)),
    ("department_shift", ("department_id", "shift_date", "shift_type")),
    ("hospitalization", ("hosp_id", "patient_amka")),
    ("active_substance", ("substance_name",)),
    ("prescription", ("doctor_amka", "patient_amka", "drug_id", "start_datetime")),
]


def _fk(child: str, cols: str, parent: str, pcols: str, on_delete: str) -> ForeignKey:
    return ForeignKey(child, tuple(cols.split()), parent, tuple(pcols.split()), on_delete, "CASCADE")


# --- fixed values: foreign keys (all ON UPDATE CASCADE) ----------------------
FOREIGN_KEYS: list[ForeignKey] = [
    _fk("doctor", "amka", "personnel", "amka", "CASCADE"),
    _fk("doctor", "supervisor_amka", "doctor", "amka", "RESTRICT"),
    _fk("nurse", "amka", "personnel", "amka", "CASCADE"),
    _fk("nurse", "department_id", "department", "department_id", "RESTRICT"),
    _fk("administrative_staff", "amka", "personnel", "amka", "CASCADE"),
    _fk("administrative_staff", "department_id", "department", "department_id", "RESTRICT"),
    _fk("department", "manager_doctor_amka", "doctor", "amka", "RESTRICT"),
    _fk("doctor_department", "doctor_amka", "doctor", "amka", "CASCADE"),
    _fk("doctor_department", "department_id", "department", "department_id", "CASCADE"),
    _fk("bed", "department_id", "department", "department_id", "CASCADE"),
    _fk("emergency_contact", "patient_amka", "patient", "patient_amka", "CASCADE"),
    _fk("department_shift", "department_id", "department", "department_id", "CASCADE"),
    _fk("shift_assignment", "shift_id", "department_shift", "shift_id", "CASCADE"),
    _fk("shift_assignment", "personnel_amka", "personnel", "amka", "CASCADE"),
    _fk("emergency_visit", "patient_amka", "patient", "patient_amka", "RESTRICT"),
    _fk("emergency_visit", "triage_nurse_amka", "nurse", "amka", "RESTRICT"),
    _fk("hospitalization", "patient_amka", "patient", "patient_amka", "RESTRICT"),
    _fk("hospitalization", "department_id", "department", "department_id", "RESTRICT"),
    _fk("hospitalization", "bed_id", "bed", "bed_id", "RESTRICT"),
    _fk("hospitalization", "ken_code", "ken", "ken_code", "RESTRICT"),
    _fk("hospitalization", "admission_icd10_code", "icd10_diagnosis", "icd10_code", "RESTRICT"),
    _fk("hospitalization", "discharge_icd10_code", "icd10_diagnosis", "icd10_code", "RESTRICT"),
    _fk("hospitalization_doctor", "hosp_id", "hospitalization", "hosp_id", "CASCADE"),
    _fk("hospitalization_doctor", "doctor_amka", "doctor", "amka", "RESTRICT"),
    _fk("lab_test", "hosp_id", "hospitalization", "hosp_id", "CASCADE"),
    _fk("lab_test", "test_code", "lab_test_catalog", "test_code", "RESTRICT"),
    _fk("lab_test", "ordered_by_doctor_amka", "doctor", "amka", "RESTRICT"),
    _fk("procedure_event", "hosp_id", "hospitalization", "hosp_id", "CASCADE"),
    _fk("procedure_event", "procedure_code", "procedure_catalog", "procedure_code", "RESTRICT"),
    _fk("procedure_event", "place_id", "operating_place", "place_id", "RESTRICT"),
    _fk("procedure_event", "chief_surgeon_amka", "doctor", "amka", "RESTRICT"),
    _fk("procedure_participant", "procedure_event_id", "procedure_event", "procedure_event_id", "CASCADE"),
    _fk("procedure_participant", "personnel_amka", "personnel", "amka", "RESTRICT"),
    _fk("drug_active_substance", "drug_id", "drug", "drug_id", "CASCADE"),
    _fk("drug_active_substance", "substance_id", "active_substance", "substance_id", "RESTRICT"),
    _fk("patient_allergy", "patient_amka", "patient", "patient_amka", "CASCADE"),
    _fk("patient_allergy", "substance_id", "active_substance", "substance_id", "RESTRICT"),
    _fk("prescription", "hosp_id patient_amka", "hospitalization", "hosp_id patient_amka", "CASCADE"),
    _fk("prescription", "doctor_amka", "doctor", "amka", "RESTRICT"),
    _fk("prescription", "drug_id", "drug", "drug_id", "RESTRICT"),
    _fk("hospitalization_evaluation", "hosp_id", "hospitalization", "hosp_id", "CASCADE"),
    _fk("entity_image", "image_id", "image_asset", "image_id", "CASCADE"),
]

# --- fixed values: CHECK constraints (Spark SQL; a NULL result passes) -------
_SCORE = "BETWEEN 1 AND 5"
CHECKS: dict[str, dict[str, str]] = {
    "personnel": {
        "ck_personnel_age": "age BETWEEN 18 AND 100",
        "ck_personnel_type": "personnel_type IN ('DOCTOR', 'NURSE', 'ADMIN')",
    },
    "doctor": {"ck_doctor_rank": "doctor_rank IN ('RESIDENT', 'CONSULTANT_B', 'CONSULTANT_A', 'DIRECTOR')"},
    "nurse": {"ck_nurse_rank": "degree IN ('ASSISTANT_NURSE', 'NURSE', 'HEAD_NURSE')"},
    "department": {"ck_department_bed_capacity": "bed_capacity >= 0"},
    "bed": {
        "ck_bed_type": "bed_type IN ('ICU', 'SINGLE', 'MULTI_BED')",
        "ck_bed_status": "bed_status IN ('AVAILABLE', 'OCCUPIED', 'MAINTENANCE')",
    },
    "patient": {
        "ck_patient_age": "age BETWEEN 0 AND 120",
        "ck_patient_weight": "weight_kg IS NULL OR weight_kg > 0",
        "ck_patient_height": "height_cm IS NULL OR height_cm > 0",
    },
    "ken": {
        "ck_ken_costs": "basic_cost >= 0 AND extra_daily_cost >= 0",
        "ck_ken_duration": "mean_duration_days >= 0",
    },
    "operating_place": {
        "ck_place_type": "place_type IN ('OPERATING_ROOM', 'PROCEDURE_ROOM')",
        "ck_place_status": "place_status IN ('AVAILABLE', 'OCCUPIED', 'MAINTENANCE')",
    },
    "department_shift": {
        "ck_shift_type": "shift_type IN ('MORNING', 'AFTERNOON', 'NIGHT')",
        "ck_shift_time": (
            "(shift_type = 'MORNING' AND start_time = '07:00:00' AND end_time = '15:00:00') OR "
            "(shift_type = 'AFTERNOON' AND start_time = '15:00:00' AND end_time = '23:00:00') OR "
            "(shift_type = 'NIGHT' AND start_time = '23:00:00' AND end_time = '07:00:00')"
        ),
    },
    "emergency_visit": {
        "ck_emergency_level": "emergency_level BETWEEN 1 AND 5",
        "ck_emergency_disposition": "disposition IN ('DISCHARGED', 'HOSPITALIZED')",
        "ck_emergency_times": "service_start_ts IS NULL OR service_start_ts >= arrival_ts",
    },
    "hospitalization": {
        "ck_hosp_cost": "total_cost >= 0",
        "ck_hosp_dates": "discharge_ts IS NULL OR discharge_ts >= admission_ts",
    },
    "procedure_catalog": {
        "ck_procedure_category": "procedure_category IN ('SURGICAL', 'DIAGNOSTIC', 'THERAPEUTIC')",
        "ck_required_place_type": "required_place_type IN ('OPERATING_ROOM', 'PROCEDURE_ROOM')",
    },
    "procedure_event": {
        "ck_proc_event_times": "end_ts > start_ts",
        "ck_proc_event_duration": "actual_duration_min > 0",
    },
    "prescription": {"ck_prescription_dates": "end_datetime IS NULL OR end_datetime >= start_datetime"},
    "hospitalization_evaluation": {
        "ck_eval_medical": f"medical_care_score {_SCORE}",
        "ck_eval_nursing": f"nursing_care_score {_SCORE}",
        "ck_eval_cleanliness": f"cleanliness_score {_SCORE}",
        "ck_eval_food": f"food_score {_SCORE}",
        "ck_eval_overall": f"overall_experience_score {_SCORE}",
    },
}

# Column defaults applied on ingest (NULL -> default).
DEFAULTS: dict[str, dict[str, object]] = {"hospitalization": {"total_cost": 0}}

# Tables whose surrogate key is assigned on insert (AUTO_INCREMENT).
GENERATED_KEYS: dict[str, str] = {
    "department": "department_id", "bed": "bed_id", "operating_place": "place_id", "department_shift": "shift_id",
    "emergency_visit": "visit_id", "hospitalization": "hosp_id", "lab_test": "test_id",
    "procedure_event": "procedure_event_id", "active_substance": "substance_id", "prescription": "prescription_id",
    "image_asset": "image_id",
}


def schema(table: str) -> T.StructType:
    """StructType of ``table`` with declared nullability."""
    return T.StructType([T.StructField(c.name, c.spark_type(), c.nullable) for c in TABLES[table]])


SCHEMAS: dict[str, T.StructType] = {t: schema(t) for t in TABLES}


def with_defaults(df, table: str):
    """``df`` with each declared column default filled in where the value is NULL (the insert-time DEFAULT)."""
    from pyspark.sql import functions as F

    for col, value in DEFAULTS.get(table, {}).items():
        if col in df.columns:
            df = df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(df.schema[col].dataType)))
    return df


def not_null_columns(table: str) -> list[str]:
    return [c.name for c in TABLES[table] if not c.nullable]


def length_limits(table: str) -> dict[str, int]:
    return {c.name: c.length for c in TABLES[table] if c.length is not None}


def decimal_columns(table: str) -> dict[str, tuple[int, int]]:
    return {c.name: c.precision for c in TABLES[table] if c.kind == "DEC" and c.precision}


# Physical layout replacing the secondary indexes: rows are range-partitioned
# and sorted on the columns the reports filter or look up by, so each file and
# row group covers a narrow key range and pushed filters skip the rest by
# Parquet min/max statistics.
LAYOUT: dict[str, tuple[str, ...]] = {
    "hospitalization": ("patient_amka", "admission_ts"),       # one patient's stays (Q6), per-patient totals
    "emergency_visit": ("arrival_ts",),
    "procedure_event": ("start_ts", "place_id"),               # year filters (Q11), overlap checks
    "department_shift": ("shift_date", "department_id"),       # day / week / year filters (Q2, Q8, Q12)
    "shift_assignment": ("personnel_amka", "shift_id"),
    "prescription": ("hosp_id", "patient_amka"),
    "procedure_participant": ("personnel_amka", "procedure_event_id"),
}
