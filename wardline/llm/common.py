"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import materialise

__all__ = ["fresh", "materialise", "read", "running_sum", "ship", "slices", "texts", "whole_runs"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder; also lets Python workers import this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Put the repository on the Python workers' path (a session may start elsewhere)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each piece holds about ``limit`` bytes of ``column`` (one row at least)."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < len(sizes):
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of key-sorted batches as arrays, cut where a run of equal keys (the first ``keys`` columns) ends, and run numbers.

    A run that a batch leaves open is held back and joined to the next batch.
    """
    held: list[np.ndarray] | None = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:keys]])
        run = np.concatenate([[0], np.cumsum(new)])
        last = int(np.searchsorted(run, run[-1]))
        held = [c[last:] for c in cols]
        if last:
            yield [c[:last] for c in cols], run[:last]
    if held is not None and len(held[0]):
        yield held, np.zeros(len(held[0]), np.int64)


def running_sum(df: DataFrame, groups: list[str], order: list[Column | str], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before this one in its group, a group spread over many tasks.

    Rows are range-sorted by (groups, order) and written once; each partition
    sums its own part of a group, and the sums of the parts before it (one row
    per partition and group) are added.  With value 1 this is the row's place
    from 0 on.  Nulls form a group of their own.  Ties get an arbitrary but
    fixed order.
    """
    ranged = df.withColumn("__value", value.cast("long")).repartitionByRange(*groups, *order)
    rows = materialise(ranged.withColumn("__part", F.spark_partition_id()))
    parts = rows.groupBy(*groups, "__part").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    above = Window.partitionBy(*groups, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__above", F.coalesce(F.sum("__value").over(above), F.lit(0)))
    on = [rows["__part"] == offsets["__part"], *(rows[g].eqNullSafe(offsets[g]) for g in groups)]
    out = rows.join(offsets, on).select(*(rows[c] for c in df.columns), (F.col("__above") + F.col("__before")).alias(name))
    return out
