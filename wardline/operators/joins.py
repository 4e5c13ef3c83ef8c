"""Join building blocks: skew-safe equality joins, interval join, self pairs.

Scale notes
-----------
* No side is broadcast by hand: Spark compares the real size with
  ``spark.sql.autoBroadcastJoinThreshold``, at planning and again from shuffle sizes.
* ``grid_join`` counts both sides per key (a partial aggregate).  A key with
  more than ``CELL`` rows on a side is cut into slices by a hash of the row, and every
  left slice meets every right slice in a cell of its own, so a cell compares at
  most about ``CELL`` x ``CELL`` rows however hot its key is.  ``CELL`` shapes the
  plan only; every key above it is split, and the result is the same for any value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.calendar import epoch_micros
from wardline.operators.spans import BLOCK, points_in_spans, tagged
from wardline.session import materialise

CELL = 10_000  # rows of one key that meet in one place, per side


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, cell: int = CELL, alike: bool = False) -> DataFrame:
    """Inner join on ``keys`` (in both sides; the other columns are disjoint), hot keys dealt as a grid.

    Both inputs are read twice, once for the counts: pass tables or
    materialised frames.  ``alike`` says that both have as many rows of each key,
    which are then counted once.  The counts are a job of their own, so without a hot
    key the join stays a plain one.  NULL keys match nothing.
    """
    keys = list(keys)
    n_l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__wl_nl"))
    if alike:
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        counts = n_l.filter(known).withColumn("__wl_nr", F.col("__wl_nl"))
    else:
        counts = n_l.join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__wl_nr")), keys)
    slices = counts.select(
        *keys, F.ceil(F.col("__wl_nl") / cell).cast("int").alias("__wl_sl"), F.ceil(F.col("__wl_nr") / cell).cast("int").alias("__wl_sr")
    )
    slices = materialise(slices.filter((F.col("__wl_sl") > 1) | (F.col("__wl_sr") > 1)))
    if slices.isEmpty():  # no key over a cell: the grid would be one cell per key
        return left.join(right, keys)

    def dealt(df: DataFrame, own: str, mine: str, other: str, theirs: str) -> DataFrame:
        """Every row in one slice of its side, copied to each slice of the other side."""
        cut = df.join(slices, keys, "left")
        at = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce(F.col(own), F.lit(1))).cast("int")
        to = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return cut.withColumn(mine, at).withColumn(theirs, to).select(*df.columns, "__wl_i", "__wl_j")

    l = dealt(left, "__wl_sl", "__wl_i", "__wl_sr", "__wl_j")
    r = dealt(right, "__wl_sr", "__wl_j", "__wl_sl", "__wl_i")
    return l.join(r, [*keys, "__wl_i", "__wl_j"]).drop("__wl_i", "__wl_j")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    hours: int,
    how: str = "left",
    cell: int = BLOCK,
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` that share the keys and fall in ``[left_ts, left_ts + hours]``.

    Both bounds are inclusive, as in ``r BETWEEN l AND l + INTERVAL hours HOUR``.
    ``how='left'`` keeps unmatched left rows once, with NULL right columns;
    ``how='inner'`` keeps only matches.  Left and right column names must be
    disjoint; two TIMESTAMPs are compared as instants, other types by the clock.

    Plan: ``points_in_spans``.  Both sides are range-sorted together, a left row
    learns the numbers of its matches from a running count and meets them in
    blocks of ``cell`` right rows.  No side is joined back, and a hot key is
    spread like any other rows.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"interval_join supports how='left' or 'inner', not {how!r}")
    wall = not all(isinstance(df.schema[c].dataType, T.TimestampType) for df, c in ((left, left_ts), (right, right_ts)))
    clock = epoch_micros if wall else (lambda c: F.unix_micros(F.col(c)))
    window = hours * 3600 * 1_000_000
    spans = tagged(left.withColumn("__wl_lo", clock(left_ts)).withColumn("__wl_hi", clock(left_ts) + window + 1))
    points = right.withColumn("__wl_right", clock(right_ts))
    met = points_in_spans(spans, points, keys, "__wl_lo", "__wl_hi", "__wl_right", how=how, block=cell)
    return met.drop("__wl_lo", "__wl_hi", "__wl_right")


def self_pairs(
    df: DataFrame, group_cols: Sequence[str], order_col: str, carry: Sequence[str] = (), *, cell: int = CELL, written: bool = False
) -> DataFrame:
    """Every unordered pair of rows that share ``group_cols``, ordered by ``order_col``.

    Output columns: ``group_cols``, then ``{c}_a`` and ``{c}_b`` for
    ``order_col`` and every ``carry`` column, with ``order_col_a < order_col_b``.
    The input is evaluated once (``written``: it is a table already) and its
    groups are counted once; a hot group is dealt as a grid on both sides.
    """
    group_cols, cols = list(group_cols), [order_col, *carry]
    base = df.select(*group_cols, *cols)
    base = base if written else materialise(base)
    side = lambda x: base.select(*group_cols, *[F.col(c).alias(f"{c}_{x}") for c in cols])
    pairs = grid_join(side("a"), side("b"), group_cols, cell=cell, alike=True)
    return pairs.filter(F.col(f"{order_col}_a") < F.col(f"{order_col}_b"))


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """``left`` rows whose key has no match in ``right`` (``NOT EXISTS``).

    The same result as ``NOT IN`` when the right key holds no NULL, which the
    reference's keys guarantee (they are declared NOT NULL).  Unlike ``NOT IN``
    this plans as an ordinary shuffle or broadcast anti join instead of the
    null-aware broadcast one.
    """
    cond: Column | None = None
    for lk, rk in on:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, "left_anti")
