"""Relational operators the reports and rules are built from.

Each takes column names as arguments, so the same code runs on the hospital
schema and on any other table with the same shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.joins import self_pairs
from wardline.operators.segments import PART, ordered_parts, with_carry
from wardline.operators.spans import TAG, micros, points_in_spans, tagged
from wardline.session import materialise


# --------------------------------------------------------------------------
# Interval overlap (half-open: [start, end); touching intervals do not overlap)
# --------------------------------------------------------------------------


def _timed(df: DataFrame, keys: list[str], id_col: str, start: str, end: str) -> DataFrame:
    """Rows that can overlap, with start and end in microseconds."""
    rows = df.select(*keys, id_col, start, end).filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    s, e = micros(df, start, end)
    return rows.withColumn("__wl_s", s).withColumn("__wl_e", e)


def _prefixed(rows: DataFrame, prefix: str, also: Sequence[str] = ()) -> DataFrame:
    return rows.select(*[F.col(c) if c in also else F.col(c).alias(prefix + c) for c in rows.columns])


def overlap_pairs(df: DataFrame, key: str | Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Every pair of rows with the same ``key`` whose ``[start, end)`` intervals overlap.

    Output: ``key`` columns, ``{id}_a``, ``{id}_b`` (``a < b``) and both
    intervals.  The test is exactly ``a.start < b.end AND a.end > b.start``,
    so an empty interval strictly inside another still counts, as in the
    reference.  The pairs are the starts inside a row's interval
    (``points_in_spans``), so the work follows the rows and the pairs, not the
    lengths.  k intervals that all overlap give k(k-1)/2 pairs: where only
    the rows matter, ``overlap_flags`` and ``overlapped_by`` find them in one sweep.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = tagged(_timed(df, keys, id_col, start, end))
    early, late = _prefixed(rows, "__e_", [*keys, TAG]), _prefixed(rows.drop(TAG), "__l_")
    hits = points_in_spans(early, late, [(k, f"__l_{k}") for k in keys], "__e___wl_s", "__e___wl_e", "__l___wl_s")
    es, ee, ei = F.col(f"__e_{start}"), F.col(f"__e_{end}"), F.col(f"__e_{id_col}")
    ls, le, li = F.col(f"__l_{start}"), F.col(f"__l_{end}"), F.col(f"__l_{id_col}")
    hits = hits.filter((F.col("__e___wl_s") < F.col("__l___wl_e")) & ((F.col("__l___wl_s") > F.col("__e___wl_s")) | (li > ei)))
    pick = lambda x, y: F.when(ei < li, x).otherwise(y)
    return hits.select(
        *keys,
        pick(ei, li).alias(f"{id_col}_a"), pick(li, ei).alias(f"{id_col}_b"),
        pick(es, ls).alias(f"{start}_a"), pick(ee, le).alias(f"{end}_a"),
        pick(ls, es).alias(f"{start}_b"), pick(le, ee).alias(f"{end}_b"),
    )


def cross_overlap_pairs(left: DataFrame, right: DataFrame, key: str | Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Pairs of a ``left`` row and a ``right`` row with the same ``key`` whose intervals overlap.

    Output: ``key``, ``left_{id}``, ``right_{id}`` and both intervals.  Used for
    "participant of one procedure while chief of an overlapping one".  One sorted
    pass serves both sides: a row asks for starts of the other side, and of two
    that start together only the left one asks.
    """
    keys, cols = [key] if isinstance(key, str) else list(key), (id_col, start, end)
    sides = (_timed(x, keys, id_col, start, end).withColumn("__wl_side", F.lit(i)) for i, x in enumerate((left, right)))
    rows = next(sides).unionByName(next(sides))
    rows = rows.withColumn("__wl_other", 1 - F.col("__wl_side")).withColumn("__wl_lo", F.col("__wl_s") + F.col("__wl_side"))
    rows = tagged(rows)
    early, late = _prefixed(rows, "__e_", [*keys, TAG]), _prefixed(rows.drop(TAG, "__wl_lo", "__wl_other"), "__l_")
    on = [*((k, f"__l_{k}") for k in keys), ("__e___wl_other", "__l___wl_side")]
    hits = points_in_spans(early, late, on, "__e___wl_lo", "__e___wl_e", "__l___wl_s")
    hits = hits.filter(F.col("__e___wl_s") < F.col("__l___wl_e"))
    asks = F.col("__e___wl_side") == 0
    of = lambda c, l, r: F.when(asks, F.col(l + c)).otherwise(F.col(r + c))
    return hits.select(
        *keys, of(id_col, "__e_", "__l_").alias(f"left_{id_col}"), of(id_col, "__l_", "__e_").alias(f"right_{id_col}"),
        *[of(c, "__e_", "__l_").alias(f"left_{c}") for c in cols[1:]], *[of(c, "__l_", "__e_").alias(f"right_{c}") for c in cols[1:]])


def overlap_flags(df: DataFrame, key: str | Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Rows of ``df`` overlapped by an earlier row of the same ``key``, with the latest ``overlap_end`` before them.

    "Earlier" is the order ``(start, id)``.  A row is flagged when the largest
    ``end`` among earlier rows exceeds its ``start``; for non-empty intervals
    that is the same as overlapping an earlier row, so the flags are empty
    exactly when ``overlap_pairs`` is.  One range sort and a running maximum:
    the cost doesn't depend on how many intervals overlap, nor on how hot a key is.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = ordered_parts(df, keys, [start, id_col])
    known_end = F.when(F.col(start).isNotNull(), F.col(end))  # a row without a start is earlier than nothing
    above = Window.partitionBy(PART, *keys).orderBy(start, id_col).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__wl_prev", F.max(known_end).over(above))
    parts = rows.groupBy(PART, *keys).agg(F.max(known_end).alias("__wl_top"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(PART, *keys, F.max("__wl_top").over(before).alias("__wl_carry"))
    out = with_carry(rows, carry, keys, ["__wl_carry"]).withColumn("overlap_end", F.greatest("__wl_prev", "__wl_carry"))
    return out.filter(F.col("overlap_end") > F.col(start)).select(*df.columns, "overlap_end")


def overlaps_any(df: DataFrame, key: str | Sequence[str], id_col: str, start: str, end: str) -> DataFrame:
    """Rows of ``df`` that overlap another row of the same ``key``, before or behind them in the order ``(start, id)``.

    One sweep: an earlier row's largest ``end`` passes the row's start, or the
    next row starts before its end.  For intervals that aren't empty that is
    "overlaps another row"; rows with a null key or time overlap nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = ordered_parts(df.filter(known), keys, [start, id_col])
    here = Window.partitionBy(PART, *keys).orderBy(start, id_col)
    rows = rows.withColumn("__wl_prev", F.max(end).over(here.rowsBetween(Window.unboundedPreceding, -1))).withColumn("__wl_next", F.lead(start).over(here))
    parts = rows.groupBy(PART, *keys).agg(F.max(end).alias("__wl_top"), F.min(start).alias("__wl_first"))
    over = Window.partitionBy(*keys).orderBy(PART)
    carry = parts.select(PART, *keys, F.max("__wl_top").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__wl_carry"), F.lead("__wl_first").over(over).alias("__wl_ahead"))
    out = with_carry(rows, carry, keys, ["__wl_carry", "__wl_ahead"])
    before = F.greatest("__wl_prev", "__wl_carry") > F.col(start)
    behind = F.least("__wl_next", "__wl_ahead") < F.col(end)
    return out.filter(F.coalesce(before, F.lit(False)) | F.coalesce(behind, F.lit(False))).select(*df.columns)


def overlapped_by(rows: DataFrame, others: DataFrame, key: str | Sequence[str], start: str, end: str) -> DataFrame:
    """Rows of ``rows`` that overlap some row of ``others`` with the same ``key`` (both have ``key``, ``start``, ``end``).

    Exactly ``EXISTS (other.start < row.end AND other.end > row.start)``, by one
    sweep: others stand at their start, rows at their end and before others of
    that time; a row is hit when the largest ``end`` so far exceeds its start.
    """
    keys = [key] if isinstance(key, str) else list(key)
    asked = rows.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    asked = asked.select("*", F.col(end).alias("__wl_at"), F.lit(0).alias("__wl_kind"), F.lit(None).cast(rows.schema[end].dataType).alias("__wl_end"))
    there = others.select(*keys, F.col(start).alias("__wl_at"), F.lit(1).alias("__wl_kind"), F.col(end).alias("__wl_end"))
    both = asked.unionByName(there.filter(F.col("__wl_at").isNotNull()), allowMissingColumns=True)
    dealt = ordered_parts(both, keys, ["__wl_at", "__wl_kind"])
    above = Window.partitionBy(PART, *keys).orderBy("__wl_at", "__wl_kind").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("__wl_prev", F.max("__wl_end").over(above))
    parts = dealt.groupBy(PART, *keys).agg(F.max("__wl_end").alias("__wl_top"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(PART, *keys, F.max("__wl_top").over(before).alias("__wl_carry"))
    out = with_carry(dealt, carry, keys, ["__wl_carry"])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()  # NULL keys match nothing
    hit = (F.col("__wl_kind") == 0) & known & (F.greatest("__wl_prev", "__wl_carry") > F.col(start))
    return out.filter(hit).select(*rows.columns)


# --------------------------------------------------------------------------
# Pairs and periods
# --------------------------------------------------------------------------


SEEDS = 64  # most frequent items whose pairs give the first bound of a top-k


def pair_cooccurrence(
    df: DataFrame, basket: str | Sequence[str], item: str, *, top: int | None = None, count_col: str = "co_occurrence_count"
) -> DataFrame:
    """How many baskets hold each unordered pair of distinct items.

    Output ``item_1, item_2, count_col`` with ``item_1 < item_2``.  Items are
    first made distinct per basket; pairs are emitted per basket with
    ``self_pairs`` (hot baskets dealt as a grid) and counted with a partial + final
    aggregate.  ``top`` keeps the ``top`` largest counts (ties broken by the
    item values), planned as a single top-k, not a full sort.

    With ``top`` and more than ``SEEDS`` items most pairs are never made: a pair
    is in no more baskets than its rarer item, so items rarer than the
    ``top``-th count among the pairs of the ``SEEDS`` most frequent items can't be in
    the answer.  Ties with that count stay, and the answer is the same.
    """
    baskets = [basket] if isinstance(basket, str) else list(basket)
    items = materialise(df.select(*baskets, item).distinct())

    def counted(some: DataFrame) -> DataFrame:
        pairs = self_pairs(some, baskets, item, written=True)
        return pairs.groupBy(F.col(f"{item}_a").alias("item_1"), F.col(f"{item}_b").alias("item_2")).agg(F.count(F.lit(1)).alias(count_col))

    if top is None:
        return counted(items)
    in_order = [F.col(count_col).desc(), "item_1", "item_2"]
    sizes = materialise(items.filter(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("__wl_n")))
    first = sizes.orderBy(F.col("__wl_n").desc(), item).limit(SEEDS + 1).collect()
    if len(first) > SEEDS:
        seeds = items.filter(F.col(item).isin([r[0] for r in first[:SEEDS]]))
        best = counted(materialise(seeds)).orderBy(*in_order).limit(top).collect()
        if len(best) == top:
            often = materialise(sizes.filter(F.col("__wl_n") >= best[-1][count_col]).select(item))
            items = materialise(items.join(often, item, "left_semi"))
    return counted(items).orderBy(*in_order).limit(top)


def equal_measure_pairs(totals: DataFrame, entity: str, partition: Sequence[str], measure: str) -> DataFrame:
    """Pairs of entities with the same ``measure`` in the same ``partition``.

    Output: ``{entity}_a``, ``{entity}_b`` (``a < b``), ``measure`` and the
    ``partition`` columns.  The group key is ``(partition, measure)``.  A group of k
    entities has k(k-1)/2 pairs; ``equal_measure_groups`` states the same in k rows.
    """
    return self_pairs(totals, [*partition, measure], entity)


def equal_measure_groups(totals: DataFrame, entity: str, partition: Sequence[str], measure: str) -> DataFrame:
    """Entities that share their ``measure`` with another one of the same ``partition``: one row per member.

    Output: ``partition``, ``measure``, ``group_size``, ``entity``.  Linear in
    the input: sizes are a partial aggregate that is written and joins back to the members.
    """
    keys = [*partition, measure]
    members = materialise(totals.select(*keys, entity))
    sizes = members.groupBy(*keys).agg(F.count_distinct(entity).alias("group_size")).filter(F.col("group_size") > 1)
    sizes = materialise(sizes)  # written, so that both sides of the join are exchanges that can be split where a group is hot
    return members.join(sizes, keys).select(*keys, "group_size", entity)


def consecutive_equal(counts: DataFrame, code: Sequence[str], period: str, measure: str) -> DataFrame:
    """Rows whose ``measure`` equals the one of the same ``code`` in ``period + 1``.

    Output: the ``code`` columns, ``period`` as ``period_1`` and ``period_2``,
    and ``measure``.  ``counts`` holds one row per ``(code, period)``; the next
    period comes from ``lead`` over a window per code, whose rows are that
    code's periods only.
    """
    w = Window.partitionBy(*code).orderBy(period)
    nxt = counts.select(
        *code,
        F.col(period).alias("period_1"),
        F.col(measure),
        F.lead(period).over(w).alias("period_2"),
        F.lead(measure).over(w).alias("__wl_next"),
    )
    return nxt.filter((F.col("period_2") == F.col("period_1") + 1) & (F.col("__wl_next") == F.col(measure))).drop(
        "__wl_next"
    )


def gap_to_max(counts: DataFrame, measure: str, gap: int, max_col: str = "max_value") -> DataFrame:
    """Rows with ``measure <= max(measure) - gap``, with the maximum attached.

    The maximum is a scalar subquery (one partial + final aggregate, run once
    and used as a value): no join, and no unpartitioned window forcing all rows
    into one task.
    """
    mx = counts.agg(F.max(measure)).scalar()
    return counts.filter(F.col(measure) <= mx - gap).withColumn(max_col, mx)


def distinct_counts(
    base: DataFrame,
    base_key: str | Sequence[str],
    branches: Sequence[tuple[DataFrame, str | Sequence[str], str, str]],
) -> DataFrame:
    """``base`` left-joined to several optional branches, with one distinct count per branch.

    Each branch is ``(df, join_key, counted_col, alias)``.  The literal form
    ``COUNT(DISTINCT x), COUNT(DISTINCT y)`` over a chain of LEFT JOINs multiplies
    the branches together before counting; here each branch is reduced to one
    row per key first (partial aggregation, shuffle of the reduced rows only)
    and then left-joined, with missing counts set to 0.  The result is the same
    because the counts are distinct counts.
    """
    bkeys = [base_key] if isinstance(base_key, str) else list(base_key)
    out = base
    for df, key, counted, alias in branches:
        keys = [key] if isinstance(key, str) else list(key)
        agg = df.groupBy(*[F.col(k).alias(bk) for k, bk in zip(keys, bkeys)]).agg(
            F.count_distinct(counted).alias(alias)
        )
        out = out.join(agg, bkeys, "left").withColumn(alias, F.coalesce(F.col(alias), F.lit(0).cast("long")))
    return out


def flag_any(base: DataFrame, base_key: str | Sequence[str], events: DataFrame, key: str | Sequence[str], alias: str,
             yes: str = "YES", no: str = "NO") -> DataFrame:
    """``base`` with ``alias`` = ``yes`` when ``events`` holds any row for the key, else ``no``."""
    bkeys = [base_key] if isinstance(base_key, str) else list(base_key)
    keys = [key] if isinstance(key, str) else list(key)
    hits = events.select(*[F.col(k).alias(bk) for k, bk in zip(keys, bkeys)]).distinct().withColumn("__wl_hit", F.lit(True))
    return (
        base.join(hits, bkeys, "left")
        .withColumn(alias, F.when(F.col("__wl_hit"), F.lit(yes)).otherwise(F.lit(no)))
        .drop("__wl_hit")
    )


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | str, how: str = "inner") -> DataFrame:
    """Join a dimension; Spark broadcasts it if its real size allows."""
    if isinstance(on, str):
        return fact.join(dim, on, how)
    cond: Column | None = None
    for fk, dk in on:
        c = fact[fk] == dim[dk]
        cond = c if cond is None else cond & c
    return fact.join(dim, cond, how)


def next_in_key(df: DataFrame, key: str | Sequence[str], ts: str, tiebreak: str, out_col: str) -> DataFrame:
    """``df`` with ``out_col`` = the ``ts`` of the next row of the same key in ``(ts, tiebreak)`` order.

    Same result as ``lead(ts) OVER (PARTITION BY key ORDER BY ts, tiebreak)``,
    NULL keys and times included, without a window that holds every row of a
    hot key: the last row of a part takes the first ``ts`` of the key's next part.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = ordered_parts(df, keys, [ts, tiebreak])
    here = Window.partitionBy(PART, *keys).orderBy(ts, tiebreak)
    rows = rows.withColumn("__wl_next", F.lead(ts).over(here)).withColumn("__wl_last", F.lead(F.lit(1)).over(here).isNull())
    first = F.struct(F.col(ts).isNotNull().alias("known"), F.col(ts).alias("ts"))  # NULL sorts first, as in the window
    parts = rows.groupBy(PART, *keys).agg(F.min(first).alias("__wl_first"))
    ahead = Window.partitionBy(*keys).orderBy(PART)
    carry = parts.select(PART, *keys, F.lead("__wl_first.ts").over(ahead).alias("__wl_ahead"))
    out = with_carry(rows, carry, keys, ["__wl_ahead"])
    nxt = F.when(F.col("__wl_last"), F.col("__wl_ahead")).otherwise(F.col("__wl_next"))
    return out.select(*df.columns, nxt.alias(out_col))
