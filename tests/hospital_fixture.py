"""A small hand-built hospital, one row per edge case the reports and rules must handle.

Edges covered: open stay (NULL discharge); stay across a year end; stay
shorter than the mean; leading-zero person keys; touching and overlapping
procedures; a chief who participates elsewhere at the same time; visits with
0, 1 and 2 stays within 24 h and one at exactly 24 h; an unrated stay; a NULL
service start; nurse and admin rows; a supervisor chain of depth 3 and a
two-node cycle; a NULL supervisor; ties in the co-occurrence top-k; shifts on
the Sunday and Monday around a week boundary.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from wardline.sources.schemas import SCHEMAS

D = Decimal
ts = dt.datetime
day = dt.date

AS_OF = day(2025, 6, 1)
AS_OF_TS = ts(2025, 6, 1, 0, 0)

# person keys
A1, A2, A3, A4, N5, AD6, A7, A8 = (f"{i:011d}" for i in (1, 2, 3, 4, 5, 6, 7, 8))
P1, P2, P3, P4 = "01234567890", "01234567891", "11111111111", "22222222222"
SURG, CARD = "Χειρουργική", "Καρδιολογία"

ROWS: dict[str, list[tuple]] = {
    "personnel": [
        (A1, "Alice", "Alpha", 30, "a1@h.gr", "1", day(2015, 1, 1), "DOCTOR"),
        (A2, "Bob", "Beta", 50, "a2@h.gr", "2", day(2005, 1, 1), "DOCTOR"),
        (A3, "Carol", "Gamma", 45, "a3@h.gr", "3", day(2001, 1, 1), "DOCTOR"),
        (A4, "Dan", "Delta", 33, "a4@h.gr", "4", day(2023, 1, 1), "DOCTOR"),
        (N5, "Eve", "Epsilon", 28, "n5@h.gr", "5", day(2020, 1, 1), "NURSE"),
        (AD6, "Frank", "Zeta", 40, "ad6@h.gr", "6", day(2019, 1, 1), "ADMIN"),
        (A7, "Gina", "Eta", 40, "a7@h.gr", "7", day(2010, 1, 1), "DOCTOR"),
        (A8, "Hank", "Theta", 41, "a8@h.gr", "8", day(2011, 1, 1), "DOCTOR"),
    ],
    "doctor": [
        (A1, "L1", SURG, "CONSULTANT_B", A2),
        (A2, "L2", SURG, "CONSULTANT_A", A3),
        (A3, "L3", CARD, "DIRECTOR", None),
        (A4, "L4", SURG, "RESIDENT", A1),
        (A7, "L7", CARD, "CONSULTANT_A", A8),
        (A8, "L8", CARD, "CONSULTANT_A", A7),
    ],
    "nurse": [(N5, "HEAD_NURSE", 1)],
    "administrative_staff": [(AD6, "Secretary", "A1", 1)],
    "department": [
        (1, "Χειρουργική Κλινική", None, 20, "B1", A2),
        (2, "Καρδιολογική Κλινική", "heart", 10, "B2", A3),
    ],
    "doctor_department": [(A1, 1), (A2, 1), (A3, 2)],
    "bed": [(1, 1, "ICU", "OCCUPIED"), (2, 2, "SINGLE", "AVAILABLE")],
    "patient": [
        (P1, "Nikos", "P", "F", 60, "M", D("80.50"), D("175.00"), "Odos 1", "69", None, None, "GR", "EOPYY"),
        (P2, "Maria", "Q", "F", 45, "F", None, None, "Odos 2", "69", "m@x.gr", None, "GR", "PRIVATE"),
        (P3, "Petros", "R", "F", 30, "M", None, None, "Odos 3", "69", None, None, None, "EOPYY"),
        (P4, "Anna", "S", "F", 70, "F", None, None, "Odos 4", "69", None, None, None, "EOPYY"),
    ],
    "emergency_contact": [(P1, "Eleni", "P", "70", None)],
    "icd10_diagnosis": [("A00", "Cholera"), ("B01", "Varicella"), ("C02", "Neoplasm")],
    "ken": [("K1", "Ken one", D("1000.00"), 3, D("100.00")), ("K2", "Ken two", D("500.00"), 5, D("50.00"))],
    "operating_place": [(1, "OR-1", "OPERATING_ROOM", "AVAILABLE"), (2, "PR-1", "PROCEDURE_ROOM", "AVAILABLE")],
    "department_shift": [
        (1, 1, day(2025, 5, 19), "MORNING", "07:00:00", "15:00:00"),    # Monday of the week of 2025-05-20
        (2, 1, day(2025, 5, 18), "NIGHT", "23:00:00", "07:00:00"),      # Sunday before: other week
        (3, 2, day(2025, 5, 25), "AFTERNOON", "15:00:00", "23:00:00"),  # Sunday closing the week
        (4, 1, day(2025, 5, 20), "AFTERNOON", "15:00:00", "23:00:00"),
        (5, 1, day(2024, 3, 3), "MORNING", "07:00:00", "15:00:00"),     # previous year
    ],
    "shift_assignment": [
        (1, A1, None), (1, N5, "scrub"), (1, AD6, None), (3, A3, None), (4, A2, None), (5, A4, None), (2, A7, None),
    ],
    "hospitalization": [
        (1, P1, 1, 1, "K1", ts(2024, 12, 30, 10), ts(2025, 1, 5, 9), "A00", "B01", D("1500.00")),  # across year end
        (2, P1, 1, 1, "K2", ts(2025, 2, 1, 8), ts(2025, 2, 3, 8), "A00", None, D("600.00")),       # shorter than mean
        (3, P1, 1, 1, "K1", ts(2025, 3, 1, 0), None, "B01", None, D("0.00")),                      # open stay
        (4, P1, 1, 1, "K1", ts(2025, 4, 1, 0), ts(2025, 4, 10, 0), "A00", "A00", D("2000.00")),
        (5, P2, 2, 2, "K2", ts(2025, 1, 10, 12), ts(2025, 1, 30, 12), "B01", "B01", D("900.00")),
        (6, P3, 2, 2, "K2", ts(2025, 1, 11, 0), ts(2025, 1, 31, 0), "B01", "B01", D("950.00")),
        (7, P1, 2, 2, "K2", ts(2025, 3, 1, 6), ts(2025, 3, 2, 6), "A00", "A00", D("300.00")),     # 2nd stay within 24 h
    ]
    # code C02: five admissions in 2022 and five in 2023 (equal consecutive years)
    + [(100 + k, P4, 2, 2, "K2", ts(2022 + k // 5, 6, 1 + k % 5), ts(2022 + k // 5, 6, 10), "C02", None, D("10.00"))
       for k in range(10)]
    # code B01 admissions in 2022: five, then six in 2023 (not equal)
    + [(200 + k, P4, 2, 2, "K2", ts(2022 + (k >= 5), 7, 1 + k), ts(2022 + (k >= 5), 7, 20), "B01", None, D("10.00"))
       for k in range(11)],
    "hospitalization_doctor": [(1, A1), (2, A1), (4, A1), (5, A2)],
    "lab_test_catalog": [("T1", "Blood count", "HEMATOLOGY")],
    "lab_test": [(1, 1, "T1", A1, ts(2025, 1, 1, 9), "ok")],
    "procedure_catalog": [
        ("PC1", "Appendectomy", "SURGICAL", "OPERATING_ROOM"),
        ("PC2", "Endoscopy", "DIAGNOSTIC", "PROCEDURE_ROOM"),
    ],
    "procedure_event": [
        (1, 1, "PC1", 1, A1, ts(2025, 1, 1, 10), ts(2025, 1, 1, 11), 60),
        (2, 1, "PC1", 1, A2, ts(2025, 1, 1, 11), ts(2025, 1, 1, 12), 60),          # touches 1 in place 1
        (3, 2, "PC1", 1, A4, ts(2025, 1, 1, 11, 30), ts(2025, 1, 1, 12, 30), 60),  # overlaps 2 in place 1
        (4, 4, "PC2", 1, A1, ts(2025, 1, 1, 10, 30), ts(2025, 1, 1, 10, 45), 15),  # wrong room type; chief busy (1)
        (5, 5, "PC1", 2, A1, ts(2025, 2, 1, 10), ts(2025, 2, 1, 11), 60),          # wrong room type
        (6, 1, "PC1", 1, A2, ts(2024, 1, 1, 23), ts(2024, 1, 2, 1), 120),          # crosses midnight, last year
    ],
    "procedure_participant": [
        (1, N5), (3, N5), (2, A4), (1, A1), (2, AD6), (4, N5),
    ],
    "drug": [("D1", "Depon"), ("D2", "Augmentin"), ("D3", "Combo")],
    "active_substance": [(1, "Paracetamol"), (2, "Amoxicillin"), (3, "Clavulanic acid"), (4, "Unused")],
    "drug_active_substance": [("D1", 1), ("D2", 2), ("D2", 3), ("D3", 1), ("D3", 2)],
    "patient_allergy": [(P2, 2)],
    "prescription": [
        (1, 5, P2, A2, "D2", "1x", "daily", ts(2025, 1, 11, 9), None),   # allergy conflict
        (2, 1, P1, A1, "D1", "1x", "daily", ts(2025, 1, 1, 9), None),
        (3, 1, P1, A1, "D2", "1x", "daily", ts(2025, 1, 1, 9), ts(2025, 1, 3, 9)),
        (4, 2, P1, A1, "D3", "1x", "daily", ts(2025, 2, 1, 9), None),
        (5, 4, P1, A1, "D2", "1x", "daily", ts(2025, 4, 1, 9), None),
        (6, 6, P3, A2, "D1", "1x", "daily", ts(2025, 1, 12, 9), None),
    ],
    "hospitalization_evaluation": [
        (1, day(2025, 1, 6), 5, 4, 3, 4, 5, "good"),
        (2, day(2025, 2, 4), 3, 3, 3, 3, 4, None),
        (5, day(2025, 2, 1), 1, 2, 3, 4, 5, None),
    ],
    "emergency_visit": [
        (1, P1, N5, ts(2025, 2, 1, 7), "pain", 2, ts(2025, 2, 1, 7, 30), "HOSPITALIZED", None),      # one stay (2)
        (2, P1, N5, ts(2025, 2, 28, 8), "fever", 2, None, "HOSPITALIZED", None),                     # two stays (3, 7)
        (3, P2, N5, ts(2025, 1, 9, 12), "cough", 1, ts(2025, 1, 9, 12, 5), "DISCHARGED", None),     # exactly 24 h
        (4, P3, N5, ts(2025, 5, 1, 10), "rash", 3, ts(2025, 5, 1, 10, 1, 59), "DISCHARGED", None),  # none; 119 s
    ],
    "image_asset": [(1, "http://img/1", "logo")],
    "entity_image": [("patient", P1, 1, None)],
}


def hospital_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in ROWS.items()}
