"""Row-at-a-time acceptance over whole tables.

A trigger admits a row if no row admitted before it stands in its way, so a row
that clashes only with a refused row is admitted.  Here each row states
*claims*: an interval of a key (a place from start to end), or a value (a
unique key).  A row is accepted when none of its claims meets a claim
of a stored row, or of an accepted row earlier in the given order.

The claims are range-sorted by (rule, key, start), so a key is cut wherever a
partition ends; an interval that reaches over a cut is copied behind it.  Every
piece is scanned in the order of arrival with two sets of covered time: what
is accepted for certain, and what may still be.  A row that meets the first is
refused, one that meets neither is free there; a row that is free in all its
pieces is accepted.  Rows that meet what may still be wait for the next round,
which has only them and the rows accepted last.  No key has to fit into one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.calendar import epoch_micros
from wardline.operators.maintain import assign_ids
from wardline.operators.segments import PART
from wardline.session import materialise, ship

ROW = "__wl_row"  # place of a row in the order of arrival, from 1 on


class Cover:
    """Covered time as disjoint half-open intervals in order; meeting is ``a.start < b.end AND a.end > b.start``."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, s: int, e: int) -> bool:
        i = bisect_right(self.ends, s)
        return i < len(self.starts) and self.starts[i] < e

    def add(self, s: int, e: int) -> None:
        i = j = bisect_right(self.ends, s)
        while j < len(self.starts) and self.starts[j] < e:
            s, e, j = min(s, self.starts[j]), max(e, self.ends[j]), j + 1
        self.starts[i:j], self.ends[i:j] = [s], [e]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[tuple]]]:
    """Rows (row, s, e, known, sole) of sorted batches, cut where (part, space, key) changes; whether a cut starts a new piece."""
    last = None
    for batch in batches:
        piece: list[tuple] = []
        fresh = False
        cols = (batch.column(c).to_pylist() for c in (PART, "space", "key", "row", "s", "e", "known", "sole"))
        for part, space, key, *rest in zip(*cols, strict=True):
            if (part, space, key) != last:
                if piece:
                    yield fresh, piece
                piece, fresh, last = [], True, (part, space, key)
            piece.append((*rest, space))
        if piece:
            yield fresh, piece


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Claims of a piece in order of arrival -> row, verdict: -1 refused, 0 open, 1 free here."""
    taken, open_ = Cover(), Cover()
    for fresh, piece in _pieces(batches):
        if fresh:
            taken, open_ = Cover(), Cover()
        rows, verdicts = [], []
        for row, s, e, known, sole, _ in piece:
            if known:
                taken.add(s, e)
                continue
            verdict = -1 if taken.meets(s, e) else 0 if open_.meets(s, e) else 1
            if verdict == 1 and sole:
                taken.add(s, e)  # nothing else can refuse it
            elif verdict >= 0:
                open_.add(s, e)
            rows.append(row)
            verdicts.append(verdict)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(verdicts, pa.int32())], ["row", "verdict"])


def _refusals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Claims with every decision known -> row, space where a refused row meets an accepted one before it."""
    taken = Cover()
    for fresh, piece in _pieces(batches):
        if fresh:
            taken = Cover()
        rows, spaces = [], []
        for row, s, e, known, _, space in piece:
            if known:
                taken.add(s, e)
            elif taken.meets(s, e):
                rows.append(row)
                spaces.append(space)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(spaces, pa.string())], ["row", "rule"])


def _scanned(claims: DataFrame) -> DataFrame:
    """Pieces whole in one task each, in order of arrival, stored rows (no ``row``) first."""
    return claims.repartition(PART, "space", "key").sortWithinPartitions(PART, "space", "key", F.col("row").asc_nulls_first())


def _cut(claims: DataFrame) -> DataFrame:
    """Claims range-sorted into parts, with a copy in every later part of its key that a claim reaches into."""
    rows = materialise(claims.repartitionByRange("space", "key", "s", "row").withColumn(PART, F.spark_partition_id()))
    firsts = materialise(rows.groupBy("space", "key", PART).agg(F.min("s").alias("first")))
    order = Window.partitionBy("space", "key").orderBy(PART)
    ends = firsts.withColumn("next", F.lead("first").over(order)).where(F.col("next").isNotNull()).drop("first")
    ends = materialise(ends)
    if ends.isEmpty():  # no key is cut
        return rows
    # the claims that reach over their key's next cut
    over = rows.join(ends, ["space", "key", PART]).where(F.col("e") > F.col("next")).drop("next")
    later = firsts.select("space", "key", F.col(PART).alias("__to"), "first")
    copies = over.join(later, ["space", "key"]).where((F.col("__to") > F.col(PART)) & (F.col("e") > F.col("first")))
    return rows.unionByName(copies.withColumn(PART, F.col("__to")).select(*rows.columns))


def refused_claims(claims: DataFrame) -> DataFrame:
    """``row, rule``: the claims by which rows are refused, when rows are admitted one by one in the order of ``row``.

    A claim that is ``barred`` (an optional boolean column) belongs to a row that is refused for
    another reason: it stands in nobody's way, but what it meets is told.
    ``claims`` has ``row`` (long, the place of arrival; null for claims of stored rows),
    ``space`` (the rule's name), ``key`` (string), ``s`` and ``e`` (long): two claims meet when
    space and key are equal and ``a.s < b.e AND a.e > b.s``.  Claims with a null key, start or end, or an end
    before the start, meet nothing.  A row may have several claims; rows that aren't returned are accepted.
    """
    ship(claims.sparkSession)
    usable = F.col("key").isNotNull() & (F.col("s") <= F.col("e"))
    barred = F.coalesce("barred", F.lit(False)) if "barred" in claims.columns else F.lit(False)
    claims = materialise(claims.where(usable).select("row", "space", "key", "s", "e", barred.alias("barred")))
    # a claim that is alone on its key can't be met
    groups = claims.groupBy("space", "key").agg(F.count(F.lit(1)).alias("n"), F.count("row").alias("fresh"))
    crowded = materialise(groups.where((F.col("n") > 1) & (F.col("fresh") > 0)).select("space", "key"))
    if crowded.isEmpty():
        return claims.select("row", F.col("space").alias("rule")).limit(0)
    pieces = materialise(_cut(claims.join(crowded, ["space", "key"], "left_semi")))
    counts = pieces.where(F.col("row").isNotNull()).groupBy("row").agg((F.count(F.lit(1)) == 1).alias("sole"))
    pieces = materialise(pieces.join(counts, "row", "left").withColumn("known", F.col("row").isNull()))
    pending, decided = pieces.where(~F.col("barred")), []
    while True:
        verdicts = _scanned(pending).mapInArrow(_decide, "row long, verdict int")
        verdicts = materialise(verdicts.groupBy("row").agg(F.min("verdict").alias("verdict")))
        # a row from an earlier round is known by now and has no verdict here
        decided.append(verdicts.where("verdict <> 0"))
        if verdicts.where("verdict = 0").isEmpty():
            break
        live = verdicts.where("verdict >= 0").select("row", (F.col("verdict") == 1).alias("known"))
        pending = materialise(pieces.drop("known").join(live, "row"))
    settled = decided[0]
    for d in decided[1:]:
        settled = settled.unionByName(d)
    final = pieces.drop("known").join(settled, "row", "left")
    final = final.withColumn("known", F.col("row").isNull() | (F.col("verdict") == 1)).drop("verdict")
    return materialise(_scanned(final).mapInArrow(_refusals, "row long, rule string").distinct())


def _claims(
    df: DataFrame, row: Column, intervals: Sequence[tuple[str, str, str, str]], values: Sequence[tuple[str, Sequence[str]]], barred: Column
) -> DataFrame:
    types = dict(df.dtypes)
    time = lambda c: epoch_micros(c) if types[c].startswith(("timestamp", "date")) else F.col(c).cast("long")
    out = [F.struct(F.lit(rule).alias("space"), F.col(key).cast("string").alias("key"), time(s).alias("s"), time(e).alias("e")) for rule, key, s, e in intervals]
    for rule, cols in values:
        known = F.lit(True)
        for c in cols:
            known = known & F.col(c).isNotNull()
        key = F.when(known, F.to_json(F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(cols)))))
        out.append(F.struct(F.lit(rule).alias("space"), key.alias("key"), F.lit(0).cast("long").alias("s"), F.lit(1).cast("long").alias("e")))
    return df.select(row.alias("row"), barred.alias("barred"), F.explode(F.array(*out)).alias("c")).select("row", "c.*", "barred")


def accept_in_order(
    batch: DataFrame,
    stored: DataFrame | None,
    order: Sequence[str],
    intervals: Sequence[tuple[str, str, str, str]] = (),
    values: Sequence[tuple[str, Sequence[str]]] = (),
    barred: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, refused)`` rows of ``batch`` when they are admitted one by one in ``order``.

    ``intervals`` lists (rule, key column, start column, end column): no two
    admitted rows of a key may overlap.  ``values`` lists (rule, columns): no two
    may agree in all of them (a null agrees with nothing).  ``stored`` rows are
    admitted already; they may have been inconsistent.  ``refused`` has the
    batch's columns and ``rule``, one row per rule that refuses the row.  Rows that
    are ``barred`` (for a reason outside) are in ``refused`` if they meet
    something, and not in ``accepted``; they stand in nobody's way.  Ties
    in ``order`` are broken by the other columns; of wholly equal rows any is first.

    Stored rows are narrowed to the batch's keys and times before anything else.
    """
    cols = batch.columns
    numbered = materialise(assign_ids(batch, [*order, *(c for c in cols if c not in order)], id_col=ROW))
    out = F.coalesce(barred, F.lit(False)) if barred is not None else F.lit(False)
    claims = _claims(numbered, F.col(ROW), intervals, values, out)
    if stored is not None:
        asked = materialise(claims.groupBy("space", "key").agg(F.min("s").alias("__from"), F.max("e").alias("__to")))
        old = _claims(stored, F.lit(None).cast("long"), intervals, values, F.lit(False)).join(asked, ["space", "key"])
        claims = claims.unionByName(old.where((F.col("s") < F.col("__to")) & (F.col("e") > F.col("__from"))).drop("__from", "__to"))
    refused = refused_claims(claims).withColumnRenamed("row", ROW)
    return numbered.where(~out).join(refused, ROW, "left_anti").select(*cols), numbered.join(refused, ROW).select(*cols, "rule")
