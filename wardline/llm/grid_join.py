"""Embedding near-deduplication by an epsilon grid order join.

Unit vectors within cosine t of each other lie within eps = sqrt(2 - 2t).  A
rotation to leading principal dimensions (any rotation keeps distances, so it
may come from a bounded sample) gives grid cells of width eps; vectors are
sorted by label and cells and cut into blocks.  Intervals of the block sequence
are joined recursively, starting with each label's whole sequence: a pair of intervals whose
bounding boxes are farther apart than eps is skipped, others are
split.  What is left is pairs of blocks, each compared by one matrix product
in a task of its own; link counts and a spanning forest go on, not the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise, running_sum, ship
from wardline.llm.components import components

SAMPLE = 4096  # vectors that the principal dimensions are fitted on, at most
LEAD = 8  # principal dimensions of the grid
BLOCK = 1024  # vectors of a block
SPLIT = 8  # parts an interval is split into


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, group, embedding -> id, group (label and length; null for what links with nothing), digest, vector bytes."""
    for batch in batches:
        groups, digests, vectors = [], [], []
        for group, values in zip(batch.column("group").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            good = group is not None and values and None not in values
            v = np.array(values, np.float64) + 0.0 if good else None  # -0.0 is 0.0
            good = good and np.isfinite(v).all() and v.any()
            raw = v.tobytes() if good else None
            groups.append(f"{len(v)}|{group}" if good else None)
            digests.append(hashlib.sha256(raw).digest() if good else None)
            vectors.append(raw)
        cols = [batch.column("id"), pa.array(groups, pa.string()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["id", "group", "digest", "vector"])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal(rows: list[bytes]) -> dict[int, np.ndarray]:
    """Per vector length the leading principal directions of the sampled unit vectors."""
    by_size: dict[int, list[np.ndarray]] = {}
    for raw in rows:
        v = np.frombuffer(raw)
        by_size.setdefault(len(v), []).append(v)
    out = {}
    for size, some in by_size.items():
        u = _unit(np.array(some))
        out[size] = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, : min(LEAD, size)]
    return out


def _projected(vectors: np.ndarray, basis: dict[int, np.ndarray]) -> np.ndarray:
    """Leading coordinates, always LEAD of them; a length that the sample lacks keeps its first coordinates."""
    u = _unit(vectors)
    p = u @ basis[u.shape[1]] if u.shape[1] in basis else u[:, :LEAD]
    return np.pad(p, ((0, 0), (0, LEAD - p.shape[1])))


def _cells(basis: dict[int, np.ndarray], eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = np.array(batch.column("vector").to_pylist(), object)
            size = np.fromiter(map(len, raws), np.int64, len(raws))
            cells = np.zeros((len(raws), LEAD), np.int32)
            for n in np.unique(size):  # vectors of one length at a time
                at = np.flatnonzero(size == n)
                vectors = np.frombuffer(b"".join(raws[at].tolist())).reshape(len(at), -1)
                cells[at] = np.floor(_projected(vectors, basis) / eps)
            cells = cells.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    return run


def _blocks(basis: dict[int, np.ndarray]):
    """Rows sorted by (group, cells) -> blocks of up to BLOCK rows of one group with their bounding box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, bytes]] = []
        now = None

        def block() -> pa.RecordBatch:
            nonlocal number, held
            nodes, copies, raws = zip(*held, strict=True)
            p = _projected(np.frombuffer(b"".join(raws)).reshape(len(raws), -1), basis)
            number, held = number + 1, []
            cols = [[now], [part], [number], [p.min(axis=0).tolist()], [p.max(axis=0).tolist()]]
            cols += [[np.array(nodes, np.int64).tobytes()], [np.array(copies, np.int64).tobytes()], [b"".join(raws)]]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())] + [pa.binary()] * 3
            names = ["group", "part", "number", "lo", "hi", "nodes", "copies", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in batches:
            for group, *row in zip(*(batch.column(c).to_pylist() for c in ("group", "node", "copies", "vector")), strict=True):
                if held and (group != now or len(held) == BLOCK):
                    yield block()
                now = group
                held.append(tuple(row))
        if held:
            yield block()

    return run


def _star(near: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a link matrix the smallest index of its component; columns count on after rows, unless both are the same."""
    a = np.arange(near.shape[0])
    b = a if same else np.arange(near.shape[1]) + len(a)
    top = near.shape[0] + near.shape[1]
    while True:
        was_a, was_b = a, b
        a = np.minimum(a, np.where(near, b[None, :], top).min(axis=1))
        b = a if same else np.minimum(b, np.where(near, a[:, None], top).min(axis=0))
        if np.array_equal(a, was_a) and np.array_equal(b, was_b):
            return a, b


def _compare(threshold: float):
    """Pairs of blocks -> link counts (node, copies linked) and links that join what is linked (node, other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                na, nb = np.frombuffer(one["a_nodes"], np.int64), np.frombuffer(one["b_nodes"], np.int64)
                ca, cb = np.frombuffer(one["a_copies"], np.int64), np.frombuffer(one["b_copies"], np.int64)
                va = np.frombuffer(one["a_vectors"]).reshape(len(na), -1)
                vb = np.frombuffer(one["b_vectors"]).reshape(len(nb), -1)
                va, vb = (v / np.abs(v).max(axis=1, keepdims=True) for v in (va, vb))
                cosine = (va @ vb.T) / (np.linalg.norm(va, axis=1)[:, None] * np.linalg.norm(vb, axis=1)[None, :])
                near = cosine >= threshold
                if one["same"]:
                    np.fill_diagonal(near, False)
                rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if not len(rows):
                    continue
                near = near[np.ix_(rows, cols)]
                low_a, low_b = _star(near, one["same"])
                nodes = na[rows] if one["same"] else np.concatenate([na[rows], nb[cols]])
                root = nodes[low_a] if one["same"] else nodes[np.concatenate([low_a, low_b])]
                linked = near @ cb[cols] if one["same"] else np.concatenate([near @ cb[cols], ca[rows] @ near])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(linked), pa.array(root)], ["node", "linked", "root"])

    return run


def _gap(a: str, b: str) -> Column:
    """Square of the distance between two bounding boxes."""
    apart = F.zip_with(F.col(f"{a}.lo"), F.col(f"{b}.hi"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    apart_2 = F.zip_with(F.col(f"{b}.lo"), F.col(f"{a}.hi"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    both = F.zip_with(apart, apart_2, lambda x, y: x * x + y * y)
    return F.aggregate(both, F.lit(0.0), lambda s, x: s + x)


def block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """``group, a, b`` (block places, a <= b) of all blocks that may hold vectors within ``eps``, by recursive splitting."""
    boxes = materialise(blocks.select("group", "seq", "lo", "hi"))
    top = boxes.agg(F.max("seq")).first()[0]
    if top is None:
        return boxes.select("group", F.col("seq").alias("a"), F.col("seq").alias("b"))
    levels = 0
    while SPLIT**levels <= top:
        levels += 1
    ends = lambda f, c: F.array(*(f(F.col(c)[i]).alias(str(i)) for i in range(LEAD)))
    pairs = boxes.select("group").distinct().select("group", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in range(levels - 1, -1, -1):
        at = F.floor(F.col("seq") / SPLIT**level).cast("long")
        level_boxes = boxes.groupBy("group", at.alias("i")).agg(ends(F.min, "lo").alias("lo"), ends(F.max, "hi").alias("hi"))
        child = lambda c: F.explode(F.sequence(F.col(c) * SPLIT, F.col(c) * SPLIT + SPLIT - 1))
        split = pairs.withColumn("a", child("a")).withColumn("b", child("b")).where("a <= b")
        box = lambda c: level_boxes.select("group", F.col("i").alias(c), F.struct("lo", "hi").alias(f"box_{c}"))
        met = split.join(box("a"), ["group", "a"]).join(box("b"), ["group", "b"])
        pairs = materialise(met.where(_gap("box_a", "box_b") <= eps * eps + 1e-9).select("group", "a", "b"))
    return pairs


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """One row per vector: ``id, n_links`` (other vectors of its label within the cosine), ``component`` (smallest id reachable, itself included).

    Null and zero vectors, vectors with null or non-finite components and null
    labels link with nothing; vectors of different length don't link.  Equal
    vectors are one class from the start and link with each other.  Rows with
    a null id aren't linked and have a null component; rows that share an id are one node of the
    links.  Extra columns are ignored; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(F.col(id_col).isNotNull(), F.col(label_col).cast("string")).alias("group"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    rows = materialise(rows.mapInArrow(_prepared, "id long, group string, digest binary, vector binary"))
    linkable = rows.where("group is not null")
    classes = linkable.groupBy("group", "digest").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")
    )
    classes = materialise(classes)
    eps = math.sqrt(2 - 2 * threshold)
    sampled = classes.orderBy(F.xxhash64("node"), "group", "digest").limit(SAMPLE).select("vector").collect()
    basis = principal([r[0] for r in sampled])
    celled = classes.select("group", "node", "copies", "vector")
    celled = celled.mapInArrow(_cells(basis, eps), "group string, node long, copies long, vector binary, cells array<int>")
    order = ["group", "cells", "node"]
    blocks = celled.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks(basis),
        "group string, part int, number long, lo array<double>, hi array<double>, nodes binary, copies binary, vectors binary",
    )
    blocks = materialise(running_sum(blocks, ["group"], ["part", "number"], F.lit(1), "seq"))
    pairs = block_pairs(blocks, eps)
    side = lambda c: blocks.select("group", F.col("seq").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("nodes", "copies", "vectors")))
    met = pairs.join(side("a"), ["group", "a"]).join(side("b"), ["group", "b"]).withColumn("same", F.expr("a = b")).drop("group", "a", "b")
    found = materialise(met.mapInArrow(_compare(threshold), "node long, linked long, root long"))
    links = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    of = components(found.where("node <> root"), "node", "root")
    known = classes.join(links, "node", "left").join(of, "node", "left")
    known = known.select("group", "digest", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    out = rows.join(known, ["group", "digest"], "left")
    return out.select("id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component"))
