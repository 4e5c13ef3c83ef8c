"""The reference's trigger rules (T1-T8) as whole-table offender DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conflicts(
    rx: DataFrame, rx_patient: str, rx_drug: str,
    allergy: DataFrame, a_patient: str, a_substance: str,
    contains: DataFrame, c_drug: str, c_substance: str,
) -> DataFrame:
    """Rows of ``rx`` whose drug contains a substance the patient is allergic to, with that ``substance``.

    ``rx`` is joined to the drug's substances (a small fan-out per drug), then
    to the allergies on ``(patient, substance)``; both joins are equi-joins,
    so a hot patient or drug is split by AQE like any skewed join key.
    """
    c = contains.select(F.col(c_drug).alias("__drug"), F.col(c_substance).alias("substance"))
    a = allergy.select(F.col(a_patient).alias("__pat"), F.col(a_substance).alias("__sub")).distinct()
    with_sub = rx.join(c, rx[rx_drug] == c["__drug"]).drop("__drug")
    return with_sub.join(a, (with_sub[rx_patient] == a["__pat"]) & (with_sub["substance"] == a["__sub"])).drop(
        "__pat", "__sub"
    )


# ---------------------------------------------------------------------------
# Hospital-schema rules.  Each returns the offending rows in the audit shape
# (rule, table_name, key_value, detail); ``*_rows`` variants return raw rows.
# ---------------------------------------------------------------------------

from collections.abc import Mapping, Sequence  # noqa: E402
from dataclasses import dataclass, field  # noqa: E402

from wardline.operators import audit as A  # noqa: E402
from wardline.operators.hierarchy import find_cycles  # noqa: E402
from wardline.operators.relate import lookup, overlap_flags, overlapped_by, overlaps_any  # noqa: E402
from wardline.session import materialise  # noqa: E402

Tables = Mapping[str, DataFrame]


def _shape(df: DataFrame, rule: str, table: str, key: list[str], detail) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                     A.key_text(key).alias("key_value"), detail.cast("string").alias("detail"))


def supervision_rules(tables: Tables) -> DataFrame:
    """T1a-c: no self-supervision; a RESIDENT has a supervisor; a DIRECTOR has none (one pass)."""
    d = tables["doctor"]
    return A.audit_check(d, "doctor", ["amka"], {
        "T1a_self_supervision": F.coalesce(F.col("supervisor_amka") != F.col("amka"), F.lit(True)),
        "T1b_resident_needs_supervisor": ~((F.col("doctor_rank") == "RESIDENT") & F.col("supervisor_amka").isNull()),
        "T1c_director_has_no_supervisor": ~((F.col("doctor_rank") == "DIRECTOR") & F.col("supervisor_amka").isNotNull()),
    })


def supervision_cycle_rows(tables: Tables) -> DataFrame:
    """T1d: doctors whose supervisor chain never ends (on a cycle, or leading into one)."""
    return find_cycles(tables["doctor"].select("amka", "supervisor_amka"), "amka", "supervisor_amka")


def supervision_cycles(tables: Tables) -> DataFrame:
    rows = supervision_cycle_rows(tables)
    detail = F.concat(F.when(F.col("on_cycle"), F.lit("on cycle ")).otherwise(F.lit("leads to cycle ")), F.col("cycle_id"))
    return _shape(rows, "T1d_supervision_cycle", "doctor", ["amka"], detail)


def allergy_conflict_rows(tables: Tables) -> DataFrame:
    """T2: prescriptions of a drug holding a substance the patient is allergic to."""
    rx = tables["prescription"].select("prescription_id", "patient_amka", "drug_id")
    return conflicts(rx, "patient_amka", "drug_id", tables["patient_allergy"], "patient_amka", "substance_id",
                     tables["drug_active_substance"], "drug_id", "substance_id")


def allergy_conflicts(tables: Tables) -> DataFrame:
    return _shape(allergy_conflict_rows(tables), "T2_allergy_conflict", "prescription", ["prescription_id"],
                  F.concat(F.lit("substance "), F.col("substance")))


def _events(tables: Tables) -> DataFrame:
    return tables["procedure_event"].select("procedure_event_id", "place_id", "chief_surgeon_amka", "start_ts", "end_ts")


def place_overlap_rows(tables: Tables) -> DataFrame:
    """T3: procedures that overlap an earlier one (by start, then id) in the same place."""
    return overlap_flags(_events(tables), "place_id", "procedure_event_id", "start_ts", "end_ts")


def chief_overlap_rows(tables: Tables) -> DataFrame:
    """T4: procedures that overlap an earlier one (by start, then id) with the same chief surgeon."""
    return overlap_flags(_events(tables), "chief_surgeon_amka", "procedure_event_id", "start_ts", "end_ts")


def _participation(tables: Tables) -> DataFrame:
    pp = tables["procedure_participant"].select("procedure_event_id", "personnel_amka")
    ev = _events(tables).select("procedure_event_id", "start_ts", "end_ts")
    return pp.join(ev, "procedure_event_id")


def participant_overlap_rows(tables: Tables) -> DataFrame:
    """T5a: participations that overlap an earlier one (by start, then event id) of the same person."""
    return overlap_flags(_participation(tables), "personnel_amka", "procedure_event_id", "start_ts", "end_ts")


def busy_chief_rows(members: DataFrame, chiefs: DataFrame, person: str, event: str, start: str, end: str) -> DataFrame:
    """T5b's shape: rows of ``members`` that overlap another event of which the person is chief (both have all four columns).

    The same event in both roles is T7, not T5b.  Members who aren't chief of
    their own event are swept against all chiefs; those who are stand where
    their event's chief stands, so they are hit when that chief row overlaps
    another of the same person.  Both are linear, however many events a person leads.
    """
    members = materialise(members.select(event, person, start, end))
    chiefs = materialise(chiefs.select(event, person, start, end))
    own = materialise(members.join(chiefs.select(event, person), [event, person], "left_semi"))
    others = members.join(own.select(event, person), [event, person], "left_anti")
    swept = overlapped_by(others, chiefs, person, start, end).select(event, person)
    if own.isEmpty():
        return swept.distinct()
    led = chiefs.join(own.select(person).distinct(), person, "left_semi")
    busy = overlaps_any(led, person, event, start, end)
    return swept.unionByName(own.join(busy.select(event, person), [event, person], "left_semi").select(event, person)).distinct()


def _chiefs(tables: Tables) -> DataFrame:
    return _events(tables).select("procedure_event_id", F.col("chief_surgeon_amka").alias("personnel_amka"), "start_ts", "end_ts")


def participant_chief_overlap_rows(tables: Tables) -> DataFrame:
    """T5b: participations of a person who is chief of another overlapping procedure."""
    return busy_chief_rows(_participation(tables), _chiefs(tables), "personnel_amka", "procedure_event_id", "start_ts", "end_ts")


def place_type_mismatch_rows(tables: Tables) -> DataFrame:
    """T6: procedures held in a place whose type differs from the procedure's required type."""
    ev = tables["procedure_event"].select("procedure_event_id", "procedure_code", "place_id")
    cat = tables["procedure_catalog"].select("procedure_code", "required_place_type")
    place = tables["operating_place"].select("place_id", "place_type")
    j = lookup(lookup(ev, cat, "procedure_code"), place, "place_id")
    return j.filter(F.col("required_place_type") != F.col("place_type"))


def role_conflicts(members: DataFrame, event: str, person: str, leads: DataFrame, lead_event: str, lead: str) -> DataFrame:
    """Rows of ``members`` whose person is also the lead of the same event (a semi join on both keys)."""
    ld = leads.select(F.col(lead_event).alias(event), F.col(lead).alias(person))
    return members.join(ld, [event, person], "left_semi")


def forbidden_members(members: DataFrame, person: str, people: DataFrame, key: str, forbidden: Column) -> DataFrame:
    """Rows of ``members`` whose person falls in a forbidden category (a semi join to the filtered people)."""
    bad = people.filter(forbidden).select(F.col(key).alias(person))
    return members.join(bad, person, "left_semi")


def chief_is_participant_rows(tables: Tables) -> DataFrame:
    """T7: the chief surgeon also listed as a participant of the same procedure."""
    pp = tables["procedure_participant"].select("procedure_event_id", "personnel_amka")
    return role_conflicts(pp, "procedure_event_id", "personnel_amka", tables["procedure_event"],
                          "procedure_event_id", "chief_surgeon_amka")


def admin_participant_rows(tables: Tables) -> DataFrame:
    """T8: administrative staff listed as procedure participants."""
    pp = tables["procedure_participant"].select("procedure_event_id", "personnel_amka")
    return forbidden_members(pp, "personnel_amka", tables["personnel"], "amka", F.col("personnel_type") == "ADMIN")


def place_overlaps(tables: Tables) -> DataFrame:
    return _shape(place_overlap_rows(tables), "T3_place_overlap", "procedure_event", ["procedure_event_id"],
                  F.concat(F.lit("overlaps an earlier procedure in place "), F.col("place_id").cast("string")))


def chief_overlaps(tables: Tables) -> DataFrame:
    return _shape(chief_overlap_rows(tables), "T4_chief_overlap", "procedure_event", ["procedure_event_id"],
                  F.concat(F.lit("overlaps an earlier procedure with chief "), F.col("chief_surgeon_amka")))


def participant_overlaps(tables: Tables) -> DataFrame:
    return _shape(participant_overlap_rows(tables), "T5a_participant_overlap", "procedure_participant",
                  ["procedure_event_id", "personnel_amka"], F.lit("overlaps an earlier procedure of the same person"))


def participant_chief_overlaps(tables: Tables) -> DataFrame:
    return _shape(participant_chief_overlap_rows(tables), "T5b_participant_is_busy_chief", "procedure_participant",
                  ["procedure_event_id", "personnel_amka"], F.lit("chief of an overlapping procedure"))


def place_type_mismatches(tables: Tables) -> DataFrame:
    return _shape(place_type_mismatch_rows(tables), "T6_place_type_mismatch", "procedure_event", ["procedure_event_id"],
                  F.concat(F.col("required_place_type"), F.lit(" required, "), F.col("place_type"), F.lit(" used")))


def chief_is_participant(tables: Tables) -> DataFrame:
    return _shape(chief_is_participant_rows(tables), "T7_chief_is_participant", "procedure_participant",
                  ["procedure_event_id", "personnel_amka"], F.lit("chief surgeon listed as participant"))


def admin_participants(tables: Tables) -> DataFrame:
    return _shape(admin_participant_rows(tables), "T8_admin_participant", "procedure_participant",
                  ["procedure_event_id", "personnel_amka"], F.lit("administrative staff"))


# The rules each inserted table's trigger runs (the table the offender belongs to).
RULES_BY_TABLE = {
    "doctor": [supervision_rules, supervision_cycles],
    "prescription": [allergy_conflicts],
    "procedure_event": [place_overlaps, chief_overlaps, place_type_mismatches],
    "procedure_participant": [participant_overlaps, participant_chief_overlaps, chief_is_participant,
                              admin_participants],
}


def trigger_rules(tables: Tables, only: list[str] | None = None) -> DataFrame:
    """Trigger rules T1-T8 (or those of the ``only`` tables) as one audit DataFrame."""
    frames = [rule(tables) for t, rs in RULES_BY_TABLE.items() if not only or t in only for rule in rs]
    return A.union_all(frames)


@dataclass(frozen=True)
class Catalogue:
    """The declared constraints of a set of tables, by table name."""

    primary_keys: Mapping[str, Sequence[str]]
    uniques: Sequence[tuple[str, Sequence[str]]] = ()
    foreign_keys: Sequence = ()
    not_null: Mapping[str, Sequence[str]] = field(default_factory=dict)
    checks: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    lengths: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    decimals: Mapping[str, Mapping[str, tuple[int, int]]] = field(default_factory=dict)


def hospital_catalogue() -> Catalogue:
    from wardline.sources import schemas as S

    of = lambda f: {t: f(t) for t in S.TABLES}
    return Catalogue(S.PRIMARY_KEYS, S.UNIQUES, S.FOREIGN_KEYS, of(S.not_null_columns), S.CHECKS, of(S.length_limits), of(S.decimal_columns))


def declared_constraints(tables: Tables, only: list[str] | None = None, catalogue: Catalogue | None = None) -> DataFrame:
    """D1-D6 for every table present in ``tables``, driven by the constraint catalogue.

    Per table one scan for its primary key, one for its unique keys, one for its
    rows and one for the values of its foreign keys, as child and as parent; these
    are compared when this is called, and the children that have orphans are read
    once more.
    """
    c = catalogue or hospital_catalogue()
    frames = []
    for t, pk in c.primary_keys.items():
        if t not in tables or (only and t not in only):
            continue
        frames.append(A.audit_keys(tables[t], t, list(pk), [list(cols) for tt, cols in c.uniques if tt == t]))
        # NOT NULL, CHECK, length and decimal limits in one pass over the table
        row_rules = [x.get(t, {}) for x in (c.not_null, c.checks, c.lengths, c.decimals)]
        if any(row_rules):
            not_null, checks, lengths, decimals = row_rules
            frames.append(A.audit_rows(tables[t], t, list(pk), not_null=list(not_null), checks=checks, lengths=lengths, decimals=decimals))
    orphans = A.audit_foreign_keys(tables, c.primary_keys, c.foreign_keys, only)
    return A.union_all([*frames, orphans] if orphans is not None else frames)


def audit_all(tables: Tables) -> DataFrame:
    """Every declared constraint and trigger rule over whole tables, as one DataFrame."""
    return declared_constraints(tables).unionByName(trigger_rules(tables))
