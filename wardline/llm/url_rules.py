"""URL filters by a sort-merge range join of canonical keys.

A key is a host's labels in reverse, a slash, and the path, so the urls that a
rule's key covers are one interval of the key order.  A rule fits its host and
all subdomains, so a url has one key per number of host labels that any rule
has.  Rules and urls are range-sorted together; a sweep over each partition
keeps the stack of nested rules that are open, and its top is the rule with the
longest path at that host.  Rules opened in earlier partitions are those whose
key is a prefix of a partition's first key, found by an equality join on the
prefixes as long as some rule's key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise, ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``); both empty without ``://`` or url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, kind): kind 0 opens a rule, kind 1 asks for the innermost open one."""
    open_keys: list[str] = []
    open_rules: list[tuple[str, str, int]] = []
    for batch in batches:
        rows, rules, verdicts, hosts = [], [], [], []
        cols = (batch.column(c).to_pylist() for c in ("key", "kind", "row", "rule", "verdict", "host_size"))
        for key, kind, row, rule, verdict, host_size in zip(*cols, strict=True):
            while open_keys and not key.startswith(open_keys[-1]):
                open_keys.pop()
                open_rules.pop()
            if kind == 0:
                open_keys.append(key)
                open_rules.append((rule, verdict, host_size))
            elif open_rules:
                rule, verdict, host_size = open_rules[-1]
                rows.append(row)
                rules.append(rule)
                verdicts.append(verdict)
                hosts.append(host_size)
        if rows:
            cols = [pa.array(rows, pa.int64()), pa.array(rules), pa.array(verdicts), pa.array(hosts, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, ["row", "rule", "verdict", "host_size"])


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: ``id, host, path, rule, verdict``; the longest fitting rule decides, ``default`` where none fits.

    ``rules`` has ``host, path, verdict``; rows with a null are ignored, of equal rules with
    several verdicts the last in text order holds.  Of rules equally long the
    longer host wins.  Repeated pages and null ids are judged like any other row.
    """
    ship(pages.sparkSession)
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = materialise(urls.withColumn("row", F.monotonically_increasing_id()))
    rules = rules.where("host is not null and path is not null and verdict is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = F.split("host", r"\.", -1)
    depths = sorted(r[0] for r in rules.select(F.size(labels)).distinct().collect())  # as many as a host has labels, at most
    opens = rules.select(
        _key(labels, F.col("path")).alias("key"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"),
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_size"),
    )
    tail = F.slice(labels, -F.col("depth"), F.col("depth"))
    asks = urls.withColumn("depth", F.explode(F.array(*map(F.lit, depths)).cast("array<int>"))).where(F.size(labels) >= F.col("depth"))
    none = F.lit(None).cast("string")
    asks = asks.select(_key(tail, F.col("path")).alias("key"), F.lit(1).alias("kind"), "row", none.alias("rule"), none.alias("verdict"), F.lit(0).alias("host_size"))
    dealt = asks.unionByName(opens).repartitionByRange("key", "kind", "row")
    dealt = materialise(dealt.withColumn("part", F.spark_partition_id()))
    # rules that an earlier partition opened and that reach into this one; a url may be far longer than any rule
    first = dealt.groupBy("part").agg(F.min("key").alias("first"))
    sizes = sorted(r[0] for r in opens.select(F.length("key")).distinct().collect())  # as many as a key has characters, at most
    sized = first.withColumn("size", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>"))).where(F.length("first") >= F.col("size"))
    carried = sized.select("part", F.substring("first", F.lit(1), F.col("size")).alias("key")).join(opens, "key").select(*dealt.columns)
    parts = (first.agg(F.max("part")).first()[0] or 0) + 1
    swept = dealt.unionByName(carried).repartitionById(parts, F.col("part")).sortWithinPartitions("key", "kind")
    fits = swept.drop("part").mapInArrow(_sweep, "row long, rule string, verdict string, host_size int")
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("host_size")))
    found = fits.groupBy("row").agg(best.alias("best"))
    return urls.join(found, "row", "left").select(
        "id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
