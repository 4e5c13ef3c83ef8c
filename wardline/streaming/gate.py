"""The ingest gate: the trigger rules and declared constraints applied to arriving rows.

The reference checks each inserted row in BEFORE INSERT/UPDATE triggers and
refuses the statement.  Here rows arrive as a Structured Stream (a folder of
files); every micro-batch is checked in ``foreachBatch`` against the stored
tables plus everything accepted by earlier batches, and split into accepted
and rejected rows.  All failing rules of a row are reported at once.

Semantics: the rows of a batch are admitted one by one in the order of their
key, as a trigger would see them.  A row is rejected when a rule fires for it
against a stored row, whatever the two keys are, or against an accepted row of
the batch before it (``wardline.operators.acceptance``); a row that conflicts only with a
rejected row is accepted.  Rules on the row itself and on other tables don't
depend on the order; rows of a batch that share a primary key are judged together by them.

Idempotence: each batch writes ``accepted/batch_id=N`` and
``rejected/batch_id=N`` with overwrite, and reads prior acceptances only from
``batch_id < N``, so a replayed batch rewrites the same output.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.acceptance import accept_in_order
from wardline.operators.audit import AUDIT_COLUMNS, audit_foreign_key, audit_rows, key_text, union_all
from wardline.operators.hierarchy import cycles_through
from wardline.operators.maintain import assign_ids
from wardline.operators.relate import overlap_pairs, overlapped_by
from wardline.plans.rules import (
    admin_participants,
    allergy_conflicts,
    busy_chief_rows,
    chief_is_participant,
    place_type_mismatches,
    supervision_rules,
)
from wardline.session import ensure_checkpoint_dir, materialise
from wardline.sources.schemas import (
    CHECKS,
    FOREIGN_KEYS,
    GENERATED_KEYS,
    PRIMARY_KEYS,
    SCHEMAS,
    UNIQUES,
    decimal_columns,
    length_limits,
    not_null_columns,
    with_defaults,
)

Tables = Mapping[str, DataFrame]
NUMBER, BARRED = "__wl_number", "__wl_barred"

Rule = Callable[[DataFrame, DataFrame], DataFrame]


def split_batch(batch: DataFrame, stored: DataFrame, key: Sequence[str], rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Generic core: run ``rules`` on a batch and the stored rows, and split the batch.

    Each rule maps ``(batch, stored)`` to the offending *batch* rows, with the
    ``key`` columns and a ``rule`` column: whichever side of a conflict has the
    larger key, it is the arriving row that is refused.  The findings are
    written once; accepted and rejected rows are both read from them.
    """
    key = list(key)
    found = materialise(union_all([r(batch, stored).select(*key, "rule") for r in rules]).distinct())
    same = [batch[k].eqNullSafe(found[k]) for k in key]
    return batch.join(found, same, "left_anti"), found


def fill_generated_keys(batch: DataFrame, table: str, stored: DataFrame, *, top: int | None = None) -> DataFrame:
    """Give rows whose generated key (AUTO_INCREMENT) is NULL the next ids after every id in use.

    ``top`` is the largest stored id; without it the stored maximum is taken (a
    one-row aggregate; ``run_gate`` computes it once per stream start).  Explicit
    ids of the batch count as in use.  Ids follow the batch rows' column order
    (declared columns left to right), so a replayed batch gets the same ids.
    """
    col = GENERATED_KEYS.get(table)
    if col is None or col not in batch.columns:
        return batch
    missing, given = batch.agg(F.count_if(F.col(col).isNull()), F.max(col)).first()
    if not missing:
        return batch
    if top is None:
        top = stored.agg(F.max(col)).first()[0]
    order = [c for c in batch.columns if c != col]
    numbered = assign_ids(batch.filter(F.col(col).isNull()).drop(col), order, id_col=col, start=max(top or 0, given or 0) + 1)
    numbered = numbered.withColumn(col, F.col(col).cast(batch.schema[col].dataType)).select(*batch.columns)
    return batch.filter(F.col(col).isNotNull()).unionByName(numbered)


def repeated_value(batch: DataFrame, stored: DataFrame, pk: Sequence[str], cols: Sequence[str], collation: str | None = None) -> DataFrame:
    """Batch rows whose ``cols`` (all non-NULL) another stored row has, or a batch row with a smaller key.

    ``collation`` compares text without case and accents.  Works on the batch and
    the stored rows that share a value with it.
    """
    text = {f.name for f in batch.schema.fields if f.dataType.typeName() == "string"}
    value = [(F.collate(F.col(c), collation) if collation and c in text else F.col(c)).alias(f"__v{i}") for i, c in enumerate(cols)]
    names = [f"__v{i}" for i in range(len(cols))]
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    rows = batch.filter(known).select(*pk, *value)
    taken = rows.join(stored.filter(known).select(*value), names, "left_semi")
    first = rows.groupBy(*names).agg(F.min(F.struct(*pk)).alias("__first"))
    later = rows.join(first, names).filter(F.col("__first") < F.struct(*pk))
    return taken.select(*pk).unionByName(later.select(*pk)).distinct()


def overlapping(batch: DataFrame, stored: DataFrame, key: str, pk: Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Batch rows that overlap a stored row of the same ``key``, or a batch row with a smaller ``id_col``.

    Stored rows come in by a sweep over those that share a key with the batch;
    only the batch, which is small, is paired with itself.
    """
    near = stored.join(batch.select(key).distinct(), key, "left_semi")
    hit = overlapped_by(batch, near, key, start, end).select(*pk)
    pairs = overlap_pairs(batch, key, id_col, start, end)
    later = pairs.select(key, F.col(f"{id_col}_b").alias(id_col)).distinct()
    return hit.unionByName(batch.join(later, [key, id_col], "left_semi").select(*pk)).distinct()


def _keyed(rows: DataFrame, pk: Sequence[str], rule: str, table: str, detail: str) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), key_text(pk).alias("key_value"), F.lit(detail).alias("detail"))


def _trigger_findings(batch: DataFrame, stored: DataFrame, table: str, current: Tables) -> list[DataFrame]:
    """Trigger rules of ``table`` whose answer doesn't depend on which rows of the batch are accepted, as findings on batch rows."""
    pk = list(PRIMARY_KEYS[table])
    if table == "doctor":
        cycles = cycles_through(batch, stored, "amka", "supervisor_amka")
        return [supervision_rules(dict(current, doctor=batch)), _keyed(cycles, pk, "T1d_supervision_cycle", table, "the chain of supervisors never ends")]
    if table == "prescription":
        return [allergy_conflicts(dict(current, prescription=batch))]
    if table == "procedure_event":
        return [place_type_mismatches(dict(current, procedure_event=batch))]
    if table == "procedure_participant":
        events = current["procedure_event"]
        person, event = "personnel_amka", "procedure_event_id"
        mine = materialise(batch.select(*pk).join(events.select(event, "start_ts", "end_ts"), event))
        people = mine.select(person).distinct()
        view = dict(current, procedure_participant=batch)
        chiefs = events.select(event, F.col("chief_surgeon_amka").alias(person), "start_ts", "end_ts").join(people, person, "left_semi")
        return [
            _keyed(busy_chief_rows(mine, chiefs, person, event, "start_ts", "end_ts"), pk, "T5b_participant_is_busy_chief", table, "chief of an overlapping procedure"),
            chief_is_participant(view),
            admin_participants(view),
        ]
    return []


# Trigger rules by which rows of one table exclude each other: rule, key, start, end.
EXCLUSIONS = {
    "procedure_event": [("T3_place_overlap", "place_id", "start_ts", "end_ts"), ("T4_chief_overlap", "chief_surgeon_amka", "start_ts", "end_ts")],
    "procedure_participant": [("T5a_participant_overlap", "personnel_amka", "start_ts", "end_ts")],
}


def _timed(rows: DataFrame, table: str, current: Tables) -> DataFrame:
    """Rows with the times that their exclusions are about: a participant's are those of the procedure."""
    if table != "procedure_participant":
        return rows
    times = current["procedure_event"].select("procedure_event_id", "start_ts", "end_ts")
    return rows.join(times, "procedure_event_id", "left")


def gate_batch(
    batch: DataFrame, table: str, current: Tables, *, top_id: int | None = None, upsert: bool = False, collation: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split ``batch`` (arriving rows of hospital ``table``) into ``(accepted, rejected)``.

    ``rejected`` has the audit shape (``rule, table_name, key_value, detail``)
    with the arriving row's primary key, one row per failing rule: the declared
    constraints of the table and its trigger rules.  Column defaults and
    missing generated keys are filled in first, as an insert would.  With
    ``upsert`` a row whose key is stored is a change of that row: it is compared
    with all other stored rows, not with its old self.  ``collation`` makes
    unique text compare as in a case- and accent-insensitive database (a value
    that an earlier row of the batch has is then taken, accepted or not).

    Stored and parent tables are narrowed to the batch's keys by semi joins
    before any rule sees them.
    """
    pk = list(PRIMARY_KEYS[table])
    batch = fill_generated_keys(with_defaults(batch, table), table, current[table], top=top_id)
    batch = materialise(batch.select(*current[table].columns).withColumn(NUMBER, F.monotonically_increasing_id()))
    rows = batch.drop(NUMBER)
    stored = current[table].join(rows.select(*pk).distinct(), pk, "left_anti") if upsert else current[table]
    uniques = [list(cols) for t, cols in UNIQUES if t == table]

    # rules that don't depend on the order: on the row itself by its number, on other tables by its key
    frames = [audit_rows(batch, table, [NUMBER], not_null=[*not_null_columns(table), *pk], checks=CHECKS.get(table, {}),
                         lengths=length_limits(table), decimals=decimal_columns(table))]
    for fk in FOREIGN_KEYS:
        if fk.child == table and fk.parent in current:
            parent = stored.unionByName(rows) if fk.parent == table else current[fk.parent]
            wanted = rows.select(*[F.col(c).alias(p) for c, p in zip(fk.cols, fk.parent_cols)]).distinct()
            parent = parent.select(*fk.parent_cols).join(wanted, list(fk.parent_cols), "left_semi")
            frames.append(audit_foreign_key(batch, table, [NUMBER], list(fk.cols), parent, list(fk.parent_cols),
                                            rule=f"foreign_key({','.join(fk.cols)})->{fk.parent}"))
    keyed = _trigger_findings(rows, stored, table, current)
    if collation:
        keyed += [_keyed(repeated_value(rows, stored, pk, c, collation), pk, f"unique({','.join(c)})", table, "value is taken") for c in uniques]
    numbers = batch.select(F.col(NUMBER).cast("string").alias("__number"), key_text(pk).alias("__key"))
    found = [f.join(numbers, f["key_value"] == numbers["__number"]) for f in frames]
    found += [f.join(numbers, f["key_value"] == numbers["__key"]) for f in keyed]
    found = materialise(union_all([f.select("__number", "rule", "detail") for f in found]).distinct())

    # rules between rows of the table: one by one, in the order of the key
    values = [("primary_key", pk)] + ([] if collation else [(f"unique({','.join(c)})", c) for c in uniques])
    bad = found.select(F.col("__number").cast("long").alias(NUMBER)).distinct().withColumn(BARRED, F.lit(True))
    asked = _timed(batch.join(bad, NUMBER, "left"), table, current)
    held = _timed(stored, table, current)
    accepted, refused = accept_in_order(asked, held, pk, EXCLUSIONS.get(table, ()), values, barred=F.col(BARRED))
    detail = F.when(F.col("rule") == "primary_key", "key is taken").when(F.col("rule").startswith("unique"), "value is taken").otherwise("overlap")
    late = refused.select(F.col(NUMBER).cast("string").alias("__number"), "rule", detail.alias("detail"))
    rejected = found.unionByName(late).join(numbers, "__number").select("rule", F.lit(table).alias("table_name"), F.col("__key").alias("key_value"), "detail")
    return accepted.select(*rows.columns), materialise(rejected.select(*AUDIT_COLUMNS))


def run_stream_gate(
    spark: SparkSession,
    source: DataFrame,
    stored: DataFrame,
    gate: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
    out_dir: str,
    *,
    checkpoint_location: str,
) -> StreamingQuery:
    """Run ``gate(batch, stored_so_far)`` on every micro-batch of the streaming ``source``.

    ``stored_so_far`` is ``stored`` plus the rows accepted by earlier batches
    (read back from ``out_dir/accepted``, ``batch_id < N``).  Output goes to
    ``out_dir/accepted|rejected/batch_id=N`` with overwrite, so a replayed batch
    rewrites the same files.  Processes what is available, then stops.
    """
    accepted_dir, rejected_dir = f"{out_dir}/accepted", f"{out_dir}/rejected"
    with_batch = T.StructType([*stored.schema.fields, T.StructField("batch_id", T.LongType())])

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = materialise(batch_df)
        so_far = stored
        try:
            prior = spark.read.schema(with_batch).parquet(accepted_dir)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":  # anything else must not pass for "nothing accepted yet"
                raise
        else:
            so_far = so_far.unionByName(prior.filter(F.col("batch_id") < batch_id).drop("batch_id"))
        accepted, rejected = gate(batch_df, so_far)
        accepted.write.mode("overwrite").parquet(f"{accepted_dir}/batch_id={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{rejected_dir}/batch_id={batch_id}")

    return (
        source.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )


def run_gate(
    spark: SparkSession,
    table: str,
    source_dir: str,
    current: Tables,
    out_dir: str,
    *,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int = 1,
) -> StreamingQuery:
    """The hospital gate on a folder of parquet files holding new ``table`` rows.

    ``current`` holds the stored tables.  Accepted and rejected rows go to
    ``out_dir/accepted`` and ``out_dir/rejected``, partitioned by ``batch_id``.
    The stream's checkpoint defaults to a folder under ``spark.checkpoint.dir``.
    """
    ckpt_root = ensure_checkpoint_dir(spark)
    checkpoint_location = checkpoint_location or os.path.join(ckpt_root, f"gate-{table}")
    stream = spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    key = GENERATED_KEYS.get(table)
    state: dict[str, int | None] = {"top": None}

    def gate(batch: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
        view = dict(current)
        view[table] = stored
        if key and state["top"] is None:  # once per stream start: stored rows plus earlier acceptances
            state["top"] = stored.agg(F.max(key)).first()[0] or 0
        accepted, rejected = gate_batch(batch, table, view, top_id=state["top"])
        if key:  # advance from this batch only (small); a replay rebuilds the same value
            state["top"] = max(state["top"] or 0, accepted.agg(F.max(key)).first()[0] or 0)
        return accepted, rejected

    return run_stream_gate(spark, stream, current[table], gate, out_dir, checkpoint_location=checkpoint_location)
