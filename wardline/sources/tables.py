"""Parquet sources and sinks.

Tables are read with an explicit schema when one is known (no inference), and
column pruning / filter pushdown are left to the scan: callers select and
filter lazily, and Catalyst pushes both into ``FileSourceScanExec``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()



class TableSet:
    """Lazy access to one folder of ``<name>.parquet`` tables.

    ``tables['orders']`` returns a DataFrame; nothing is read until an action.
    ``schemas`` may pin a StructType per table (the hospital schema does).
    ``suffix`` names the folder suffix (``""`` for folders written by
    ``write_hospital``, ``".parquet"`` for the test tables).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: dict[str, StructType] | None = None,
        suffix: str | None = None,
    ):
        self.spark = spark
        self.suffix = suffix
        self.root = root.rstrip("/")
        self.schemas = schemas or {}
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """``root/<name><suffix>``; with no suffix given, a local root is checked for
        ``<name>.parquet`` and then ``<name>`` (a remote root assumes ``.parquet``)."""
        if self.suffix is not None:
            return f"{self.root}/{name}{self.suffix}"
        p = f"{self.root}/{name}.parquet"
        if not p.startswith(("s3", "gs", "abfs", "hdfs", "file:", "dbfs")) and not os.path.exists(p):
            alt = f"{self.root}/{name}"
            if os.path.exists(alt):
                return alt
        return p

    def __getitem__(self, name: str) -> DataFrame:
        df = self._cache.get(name)
        if df is None:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            df = reader.parquet(self.path(name))
            if name in self.schemas:  # declared columns only, whatever else the folder holds
                df = df.select(*self.schemas[name].fieldNames())
            self._cache[name] = df
        return df

    def _exists(self, name: str) -> bool:
        p = self.path(name)
        return not p.startswith("/") or os.path.exists(p)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and (name in self._cache or self._exists(name))

    def keys(self) -> list[str]:
        names = list(self.schemas) if self.schemas else list(TEST_TABLES)
        return [n for n in names if n in self]

    def __iter__(self):
        return iter(self.keys())

    def __len__(self) -> int:
        return len(self.keys())

    def register(self, names: Iterable[str] | None = None) -> None:
        """Expose tables as temp views, for ``spark.sql`` callers."""
        for n in names or TEST_TABLES:
            self[n].createOrReplaceTempView(n)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink; ``partition_by`` names low-cardinality columns (e.g. an admission month)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_hospital(tables: dict[str, DataFrame], root: str, *, mode: str = "overwrite") -> None:
    """Write hospital tables to ``root/<table>`` with the layout of ``schemas.LAYOUT``.

    Tables with a layout are range-partitioned and sorted on its columns, which
    keeps Parquet min/max statistics tight: a point lookup (one patient's stays)
    or a date range (one week's shifts) pushed to the scan skips most row groups.
    """
    from wardline.sources.schemas import LAYOUT

    for name, df in tables.items():
        cols = LAYOUT.get(name, ())
        out = df.repartitionByRange(*cols).sortWithinPartitions(*cols) if cols else df
        write_table(out, f"{root.rstrip('/')}/{name}", mode=mode)
