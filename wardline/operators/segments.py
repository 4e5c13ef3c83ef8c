"""Ordering a table by (key, time) without putting a whole key in one task.

Rows are range-partitioned by (key, time, tie) and written once with the number
of their partition, so a key is cut wherever a partition ends, and only there.
Windows run per (partition, key); what crosses a cut is carried by one
aggregate row per (partition, key).  There is no threshold: a key of any size is
spread over as many partitions as its share of the rows needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import materialise

PART = "__wl_part"


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` range-sorted by (keys, order) and written, with its partition number in ``PART``."""
    return materialise(df.repartitionByRange(*keys, *order).withColumn(PART, F.spark_partition_id()))


def with_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attach ``columns`` of ``carry`` (one row per (partition, key)); NULL keys are a key like any other."""
    other = carry.select(F.col(PART).alias("__wl_p"), *[F.col(k).alias(f"__wl_k{i}") for i, k in enumerate(keys)], *columns)
    on = F.col(PART) == F.col("__wl_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__wl_k{i}"))
    return rows.join(other, on).select(*rows.columns, *columns)
