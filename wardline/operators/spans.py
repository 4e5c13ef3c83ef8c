"""Points inside spans, by running numbers: the join behind interval overlap and time windows.

Bounds of spans and points are range-sorted together by (keys, time), and a
running count of the points is written with them once.  It gives every point its
number and every span the numbers ``[lo, hi)`` of the points inside it.  Numbers run
through the whole table, so no key has to be in one task, and an empty span is
known without a comparison.  Points are dealt in blocks of consecutive numbers; a
span goes once to every block that it touches.  Work follows the number of
spans, points and matches, whatever the lengths of the spans.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.calendar import epoch_micros
from wardline.operators.segments import PART
from wardline.session import materialise

BLOCK = 64  # consecutive points that a span meets together; shapes the plan, never the result
TAG = "__wl_tag"


def micros(df: DataFrame, *columns: str) -> list[Column]:
    """The columns on one exact time line: instants if all are TIMESTAMP, else wall-clock microseconds."""
    instants = all(isinstance(df.schema[c].dataType, T.TimestampType) for c in columns)
    return [F.unix_micros(F.col(c)) if instants else epoch_micros(c) for c in columns]


def tagged(spans: DataFrame) -> DataFrame:
    """``spans`` written once, each row with a number of its own in ``TAG``."""
    return materialise(spans.withColumn(TAG, F.monotonically_increasing_id()))


def _known(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def numbered(spans: DataFrame, points: DataFrame, on: Sequence[tuple[str, str]], lo: str, hi: str, at: str) -> tuple[DataFrame, DataFrame]:
    """``spans`` with the numbers ``__wl_from`` and ``__wl_to`` (exclusive) of their points, and ``points`` with their number ``__wl_no``.

    ``spans`` come from ``tagged``.  Rows with a null key or time have no
    numbers: such spans get nulls, such points are left out.  A span whose
    ``hi`` isn't above its ``lo`` is like one with a null.
    """
    names = [f"__wl_k{i}" for i in range(len(on))]
    asked = spans.filter(_known(*[s for s, _ in on], lo, hi) & (F.col(lo) < F.col(hi)))
    bounds = asked.select(*[F.col(s).alias(n) for (s, _), n in zip(on, names)], TAG, F.explode(F.array(lo, hi)).alias("__wl_at"))
    there = points.filter(_known(*[p for _, p in on], at))
    there = there.select(*[F.col(p).alias(n) for (_, p), n in zip(on, names)], F.col(at).alias("__wl_at"), F.struct(*points.columns).alias("__wl_point"))
    both = bounds.unionByName(there, allowMissingColumns=True)
    # bounds stand before the points of their time; the hash lets a range end among equal times
    is_point, order = F.col("__wl_point").isNotNull(), [*names, "__wl_at", "__wl_is"]
    both = both.select("*", is_point.alias("__wl_is"), F.xxhash64(TAG, "__wl_point").alias("__wl_tie"))
    dealt = both.repartitionByRange(*order, "__wl_tie").withColumn(PART, F.spark_partition_id())
    above = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum(F.col("__wl_is").cast("long")).over(above)
    dealt = materialise(dealt.select(PART, running.alias("__wl_n"), "__wl_is", TAG, "__wl_point"))
    # one row per partition: read here, not written, as a job less on small tables
    sizes = sorted(dealt.groupBy(PART).agg(F.max("__wl_n")).collect())
    ends = list(accumulate((n for _, n in sizes), initial=0))
    starts = pa.table({PART: pa.array([p for p, _ in sizes], pa.int32()), "__wl_before": pa.array(ends[: len(sizes)], pa.int64())})
    starts = F.broadcast(spans.sparkSession.createDataFrame(starts))
    dealt = dealt.join(starts, PART)
    count = F.col("__wl_before") + F.col("__wl_n")
    spread = dealt.filter(~F.col("__wl_is")).groupBy(TAG).agg(F.min(count).alias("__wl_from"), F.max(count).alias("__wl_to"))
    dots = dealt.filter("__wl_is").select((count - 1).alias("__wl_no"), "__wl_point.*")
    return spans.join(spread, TAG, "left"), dots


def in_blocks(spans: DataFrame, block: int = BLOCK) -> DataFrame:
    """Spans that hold points, once for every block ``__wl_block`` that they touch."""
    first, last = F.floor(F.col("__wl_from") / block), F.floor((F.col("__wl_to") - 1) / block)
    return spans.filter(F.col("__wl_to") > F.col("__wl_from")).withColumn("__wl_block", F.explode(F.sequence(first, last)))


def points_in_spans(
    spans: DataFrame,
    points: DataFrame,
    on: Sequence[tuple[str, str]],
    lo: str,
    hi: str,
    at: str,
    *,
    how: str = "inner",
    block: int = BLOCK,
) -> DataFrame:
    """Rows of ``spans`` with the ``points`` that share the keys and lie in ``lo <= at < hi`` (longs).

    ``on`` pairs the spans' key columns with the points'; all column names are
    disjoint.  ``spans`` come from ``tagged``.  ``how='left'`` keeps spans
    without a point once, with nulls: their numbers tell, nothing is joined back.
    """
    asked, dots = numbered(spans, points, on, lo, hi, at)
    dots = dots.withColumn("__wl_block", F.floor(F.col("__wl_no") / block))
    met = in_blocks(asked, block).join(dots, "__wl_block")
    met = met.filter((F.col("__wl_no") >= F.col("__wl_from")) & (F.col("__wl_no") < F.col("__wl_to")))
    cols = [c for c in spans.columns if c != TAG]
    out = met.select(*cols, *points.columns)
    if how == "left":
        alone = asked.filter(~F.coalesce(F.col("__wl_to") > F.col("__wl_from"), F.lit(False)))
        out = out.unionByName(alone.select(*cols), allowMissingColumns=True)
    return out
