"""Exact deduplication by a tree merge of sorted digest runs.

Arrow batches become sorted runs of (digest, size, keeper, copies).  Runs meet
in rounds: with P nodes and radix r, round j moves a record to the node whose
j-th base-r digit is the j-th digit of the record's digest, so groups of r nodes
exchange parts of their runs and merge them.  After log_r(P) rounds a node
holds one merged run of its share of the digests.  At every level equal digests are
verified (whole SHA-256 and byte length) and only the identifier to keep and
the copy count go on, so a text that fills a third of all rows is one record
per batch from the start and one per node after the first round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import fresh, materialise, ship, texts

RADIX = 16  # runs that one merge takes at most
KEY = ["__sha", "__size"]


def with_digest(df: DataFrame, text_col: str = "text", names: tuple[str, str] = ("__sha", "__size")) -> DataFrame:
    """``df`` plus the SHA-256 of the text's UTF-8 bytes, A-Z lower-cased (null as empty), and their number."""
    ship(df.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts(batch, text_col)
            sha = pa.array([hashlib.sha256(t.lower()).digest() for t in raw], pa.binary())
            size = pa.array([len(t) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sha, size], [*batch.schema.names, *names])

    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.BinaryType()), T.StructField(names[1], T.LongType())])
    return df.mapInArrow(digest, schema)


def sorted_runs(rows: DataFrame, nodes: int, keep: str) -> DataFrame:
    """Turn each Arrow batch of ``__sha, __size, id, row`` into a sorted run without repeated digests, at some node."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            nulls = "at_start" if keep == "largest" else "at_end"  # a null id loses
            by = [(c, "ascending") for c in [*KEY, "id", "row"]]
            table = batch.take(pc.sort_indices(batch, sort_keys=by, null_placement=nulls))
            sha, size = table.column("__sha"), table.column("__size")
            new = np.ones(table.num_rows, bool)
            if table.num_rows > 1:
                same = pc.and_(pc.equal(sha[1:], sha[:-1]), pc.equal(size[1:], size[:-1]))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(new)
            last = np.append(first[1:], table.num_rows) - 1
            out = table.take(pa.array(last if keep == "largest" else first))
            copies = pa.array((last - first + 1).astype(np.int64))
            at = pa.array(np.full(len(first), node % nodes, np.int32))
            node += 1
            yield pa.RecordBatch.from_arrays([*out.columns, copies, at], [*out.schema.names, "copies", "node"])

    fields = [T.StructField("copies", T.LongType()), T.StructField("node", T.IntegerType())]
    return rows.mapInArrow(runs, T.StructType([*rows.schema.fields, *fields]))


def merge_runs(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """Tree-merge digest rows ``__sha, __size, id, row`` to one row per text: key, ``keeper`` (struct of id, row), ``copies``."""
    want = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rounds = max(1, math.ceil(math.log(want, RADIX)))
    radix = max(2, math.ceil(round(want ** (1 / rounds), 6)))
    nodes = radix**rounds
    # null ids lose in either direction
    rank = F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()
    best = F.max if keep == "largest" else F.min
    head = F.conv(F.hex(F.substring("__sha", 1, 4)), 16, 10).cast("long")
    cur = sorted_runs(rows, nodes, keep).select(
        *KEY,
        F.struct(rank.alias("rank"), "id", "row").alias("keeper"),
        "copies",
        "node",
        (head % nodes).cast("int").alias("home"),
    )

    def digit(name: str, unit: int) -> F.Column:
        return F.floor(F.col(name) / unit) % radix * unit

    for j in range(rounds):
        unit = radix**j
        cur = cur.withColumn("node", (F.col("node") - digit("node", unit) + digit("home", unit)).cast("int"))
        # up to `radix` runs meet in one sorted run; equal neighbours become one record
        met = cur.repartitionById(nodes, F.col("node")).sortWithinPartitions("node", "home", *KEY)
        cur = met.groupBy("node", "home", *KEY).agg(best("keeper").alias("keeper"), F.sum("copies").alias("copies"))
    return cur.select(*KEY, "keeper", "copies")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, sha`` (digest bytes), texts compared after A-Z lower-casing.

    Null texts count as empty; empty texts are equal to each other.  A row with
    a null id stays only if no copy has an id.  Repeated rows (same id, same
    text) count as copies, and exactly one of them has ``kept`` true.  Extra
    columns are ignored; an empty table gives an empty result.
    """
    rows = with_digest(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    rows = materialise(rows.select("id", *KEY, F.monotonically_increasing_id().alias("row")))
    best = merge_runs(rows, keep)
    return rows.join(best, KEY).select(
        "id",
        F.col("keeper.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        F.col("__sha").alias("sha"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``df`` that stay, all columns kept; of repeated rows one stays, of copies without any id one."""
    sha, size, ident, again = (fresh(df, x) for x in ("__sha", "__size", "__ident", "__again"))
    named = lambda c: F.to_json(F.struct(c.alias("i")))  # null has a value of its own
    kept = exact_groups(df, id_col, text_col, keep).where("kept").select(F.col("sha").alias(sha), named(F.col("id")).alias(ident))
    rows = with_digest(df, text_col, (sha, size)).withColumn(ident, named(F.col(id_col))).join(kept, [sha, ident], "left_semi")
    nth = F.row_number().over(Window.partitionBy(sha, ident).orderBy(sha))
    return rows.withColumn(again, nth).where(F.col(again) == 1).select(*df.columns)
