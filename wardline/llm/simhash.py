"""SimHash near-deduplication: pigeonhole blocks over 64-bit fingerprints, Hamming checks, components.

Two fingerprints that differ in at most d bits agree on at least b - d of b
blocks, so rows are dealt by every choice of b - d blocks and meet there.
Equal fingerprints are one row from the start.  Within a bucket the distance
of every pair is checked, but only a spanning forest goes on as links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import fresh, materialise, ship, slices, texts, whole_runs
from wardline.llm.components import components

BITS = 64
CHUNK = 1 << 16  # shingles whose bits are counted at once
TILE = 4096  # fingerprints of one bucket that a task compares at once


def fingerprint(text: bytes, n: int = 4, seed: int = 42) -> int:
    """SimHash of the text's word n-grams (A-Z lower-cased, repeats counted), as a signed 64-bit number."""
    words = text.lower().split()  # bytes.split() cuts at space and 0x09-0x0D
    if not words:
        return 0
    if len(words) <= n:
        grams, m = [b" ".join(words)], 1
    else:
        m = len(words) - n + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, m)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, m, CHUNK):
        rows = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > m, bitorder="little").view(np.int64)[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", name: str = "fingerprint", n: int = 4, seed: int = 42) -> DataFrame:
    """``df`` without ``text_col`` plus a signed 64-bit SimHash of it; null text has no words, so 0."""
    ship(df.sparkSession)
    rest = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                marks = pa.array([fingerprint(t, n, seed) for t in texts(part, text_col)], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), marks], [*rest, name])

    return df.mapInArrow(run, df.select(*rest, F.lit(0).cast("long").alias(name)).schema)


def masks(blocks: int, distance: int) -> list[int]:
    """Signed bit masks, one per choice of blocks - distance blocks of 64 bits cut as evenly as can be."""
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    picks = (sum(block[i] for i in pick) for pick in combinations(range(blocks), blocks - distance))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in picks]


def block_count(rows: int, distance: int) -> int:
    """Blocks that make copies sent plus chance meetings fewest; any count finds the same links."""
    cost = {b: math.comb(b, distance) * (1 + rows / 2 ** (BITS * (b - distance) / b)) for b in range(distance + 1, distance + 5)}
    return min(cost, key=cost.get)


def forest(marks: np.ndarray, distance: int) -> np.ndarray:
    """For every fingerprint the smallest index of its component under links of at most ``distance`` bits."""
    label = np.arange(len(marks))
    step = max(1, (1 << 21) // len(marks))
    while True:
        old = label
        low = np.empty_like(label)
        for i in range(0, len(marks), step):
            near = np.bitwise_count(marks[i : i + step, None] ^ marks[None, :]) <= distance
            low[i : i + step] = np.where(near, label[None, :], len(marks)).min(axis=1)
        label = np.minimum(low, low[low])
        np.minimum.at(label, old, label[:])  # a root learns what its members saw
        label = label[label]
        if np.array_equal(label, old):
            return label


def _short_links(marks: np.ndarray, node: np.ndarray, run: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside runs of a few rows: rows are compared with those 1, 2, ... places on."""
    for step in range(1, len(run)):
        same = run[step:] == run[:-step]
        if not same.any():
            return
        i = np.flatnonzero(same)
        i = i[np.bitwise_count(marks[i] ^ marks[i + step]) <= distance]
        yield node[i], node[i + step]


def _link(distance: int, keys: list[str], short: int = 8):
    """mapInArrow function: rows sorted by ``keys`` in, a spanning forest of each run's links (a, b) out."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, run in whole_runs(batches, len(keys)):
            marks, node = cols[-2].view(np.uint64), cols[-1]
            found: list[tuple[np.ndarray, np.ndarray]] = []
            sizes = np.bincount(run)[run]
            small = (sizes > 1) & (sizes <= short)
            if small.any():
                found += _short_links(marks[small], node[small], run[small], distance)
            for r in np.unique(run[sizes > short]):
                lo, hi = np.searchsorted(run, (r, r + 1))
                own, low = node[lo:hi], forest(marks[lo:hi], distance)
                away = low != np.arange(hi - lo)
                found.append((own[low[away]], own[away]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def bucket_links(marks: DataFrame, distance: int = 4, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that join all ``(mark, node)`` rows whose marks differ in at most ``distance`` bits into components.

    ``marks`` are distinct.  A bucket over ``tile`` rows is cut into chunks by a
    hash of the mark, and every two chunks meet in a task of their own, so no
    task holds a whole hot bucket; the links found are the same.
    """
    n = marks.count()
    picks = masks(block_count(n, distance), distance)
    dealt = marks.select(
        F.explode(F.array(*(F.struct(F.lit(i).alias("pick"), F.col("mark").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(picks)))).alias("b"),
        "mark",
        "node",
    ).select("b.pick", "b.key", "mark", "node")
    met = dealt.groupBy("pick", "key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = met.select("pick", "key", F.ceil(F.col("rows") / tile).cast("int").alias("chunks"))
    met = materialise(met)  # joined as a plain table, so a hot bucket's rows may be split before they are tiled
    dealt = dealt.join(met, ["pick", "key"])
    own = F.pmod(F.xxhash64("mark", F.lit(7)), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    keys = ["pick", "key", "lo", "hi"]
    dealt = dealt.select("pick", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "mark", "node")
    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys, "mark")
    return sorted_rows.mapInArrow(_link(distance, keys), "a long, b long")


def _grouped(df: DataFrame, id_col: str, text_col: str, n: int, distance: int, seed: int) -> DataFrame:
    """``id, tag`` (a hash of the text), ``fingerprint, component`` of every row."""
    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    rows = materialise(with_fingerprint(rows, "text", "fingerprint", n, seed))
    classes = materialise(rows.groupBy(F.col("fingerprint").alias("mark")).agg(F.min("id").alias("node")))
    of = components(bucket_links(classes.where(F.col("node").isNotNull()), distance))
    named = classes.join(of, "node", "left").select(F.col("mark").alias("fingerprint"), F.coalesce("component", "node").alias("component"))
    return rows.join(named, "fingerprint").select("id", "tag", "fingerprint", "component")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """One row per input row: ``id, fingerprint`` (signed long), ``component`` (smallest id reachable by links).

    Texts that are null, empty or without words have fingerprint 0 and link
    like any other.  Null ids are no names: such a row gets the component of
    its fingerprint, null if no id is in it.  Rows that share an id are one
    node.  Extra columns are ignored; an empty table gives an empty result.
    """
    return _grouped(df, id_col, text_col, n, distance, seed).drop("tag")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """One row per component, the one whose id is the smallest; all columns kept.

    Rows that share an id are one document.  Rows with a null id stay, one
    per text, where no row with an id has their fingerprint.
    """
    key, again = fresh(df, "__key"), fresh(df, "__again")

    def named(ident, tag):  # a null id goes by its text
        return F.to_json(F.struct(ident.alias("i"), F.when(ident.isNull(), tag).alias("t")))

    groups = _grouped(df, id_col, text_col, n, distance, seed).where(F.col("id").eqNullSafe(F.col("component")))
    stay = groups.select(named(F.col("id"), F.col("tag")).alias(key)).distinct()
    own = named(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string")))
    rows = df.withColumn(key, own).join(stay, key, "left_semi")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return rows.withColumn(again, nth).where(F.col(again) == 1).select(*df.columns)
