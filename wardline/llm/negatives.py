"""Hard-negative mining by lists that an anchor cluster shares.

Vectors are integers (components scaled and floored), scores their exact inner products.
Anchors of a label are clustered by direction; a cluster knows its centre and
the largest angle of a member to it.  No member u can score more with a
candidate v than |u| |v| cos(angle(v, centre) - that angle), so the cluster
sorts candidates by this bound once, and every member walks the list in slabs
until what it still needs lies above the bound of all that follow.

Candidates lie in blocks of one label, anchors in tiles of one label.  A tile meets its
nearest blocks first; what its members then have says which of the other blocks can still
matter, by the same bound on whole blocks, and only those are shipped.
Two passes run this way: the first over the anchors' own labels finds
positives, the second over all other labels finds negatives in the score ranges
that the positives open.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import materialise, running_sum, ship

SAMPLE = 4096  # anchors that the cluster directions are fitted on, at most
CLUSTERS = 256  # cluster directions, at most
PER_CLUSTER = 64  # anchors for which one more direction is fitted
MEMBERS = 256  # anchors of a cluster that share a list
TILE = 16384  # anchors of a tile
BLOCK = 16384  # candidates of a block
SLAB = 512  # candidates that are scored at a time
HEAD = 8  # blocks that a tile meets before it asks which others matter
LARGEST = 2.0**55  # squared length from which a vector takes no part (100 times a score must fit into a long)
NO_LOW, NO_HIGH = -(1 << 62), 1 << 62


def _prepared(scale: float):
    """id, label, embedding -> id, label, dim, norm2, vec (little-endian integers of 2 or 8 bytes); rows that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, dims, norms, vecs = [], [], [], []
            for row, values in enumerate(batch.column("embedding").to_pylist()):
                if not values or None in values:
                    continue
                v = np.array(values, np.float64)
                if not np.isfinite(v).all():
                    continue
                with np.errstate(over="ignore"):
                    v = np.floor(scale * v)
                    norm2 = float(v @ v)
                if not norm2 < LARGEST:
                    continue
                small = np.abs(v).max() < 1 << 15
                keep.append(row)
                dims.append(len(v))
                norms.append(norm2)
                vecs.append(v.astype("<i2" if small else "<i8").tobytes())
            rows = batch.select(["id", "label"]).take(pa.array(keep, pa.int64()))
            cols = [*rows.columns, pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(vecs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "label", "dim", "norm2", "vec"])

    return run


def _numbers(raws: list[bytes], dim: int) -> np.ndarray:
    """Vectors of one length as rows of 64-bit integers."""
    if all(len(r) == 2 * dim for r in raws):
        return np.frombuffer(b"".join(raws), "<i2").reshape(-1, dim).astype(np.int64)
    return np.array([np.frombuffer(r, "<i2" if len(r) == 2 * dim else "<i8") for r in raws], np.int64).reshape(-1, dim)


def _directions(v: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    v = v.astype(np.float64)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def fit_clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` directions by spherical k-means with a fixed start."""
    u = _directions(vectors)
    centres = u[np.random.default_rng(7).permutation(len(u))[:k]]
    for _ in range(8):
        near = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, u)
        centres = _directions(np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, sums, centres))
    return centres


def _cells(centres: dict[int, np.ndarray]):
    """Adds the number of the nearest direction; 0 for a vector length that the sample lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
            cell = np.zeros(len(raws), np.int32)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) in centres:
                    cell[at] = (_directions(_numbers([raws[i] for i in at], int(d))) @ centres[int(d)].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return run


def _ball(v: np.ndarray) -> tuple[np.ndarray, float]:
    """Centre direction of some vectors and the largest angle to it."""
    u = _directions(v)
    centre = u.sum(axis=0)
    if not np.linalg.norm(centre) > 1e-9:
        return np.zeros(v.shape[1]), math.pi
    centre /= np.linalg.norm(centre)
    return centre, float(np.arccos(np.clip(u @ centre, -1, 1)).max()) + 1e-6  # arccos is that exact near 0


def _with_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows plus centre, radius and largest length."""
    for batch in batches:
        centres, radii, lengths = [], [], []
        for row in range(batch.num_rows):
            v = _numbers(batch.column("vecs")[row].as_py(), batch.column("dim")[row].as_py())
            centre, radius = _ball(v)
            centres.append(centre.tolist())
            radii.append(radius)
            lengths.append(float(np.linalg.norm(v.astype(np.float64), axis=1).max()))
        cols = [*batch.columns, pa.array(centres, pa.list_(pa.float64())), pa.array(radii, pa.float64()), pa.array(lengths, pa.float64())]
        yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "centre", "radius", "longest"])


def walk(u: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, v: np.ndarray, ids: np.ndarray, top: int) -> list[np.ndarray]:
    """One cluster's list walked by all members: arrays member, slot, score, id.

    Member m wants, for each slot k, the ``top`` candidates with
    ``low[m, k] <= score <= high[m, k]``, higher scores and then smaller ids
    first, without the candidate of its own id.  ``low`` may already be raised
    to what other blocks gave.
    """
    lengths = np.linalg.norm(u.astype(np.float64), axis=1)
    sizes = np.linalg.norm(v.astype(np.float64), axis=1)
    centre, radius = _ball(u)
    angles = np.arccos(np.clip(_directions(v) @ centre, -1, 1))
    bound = sizes * np.maximum(np.cos(np.maximum(angles - radius, 0)), 0) * (1 + 1e-9)
    order = np.lexsort((ids, -bound))
    v, ids, bound = v[order], ids[order], bound[order]
    exact = lengths.max() * sizes.max() < 2.0**52
    u, v = (u.astype(np.float64), v.astype(np.float64)) if exact else (u, v)
    slots = low.shape[1]
    need, open_ = low.copy(), low <= high
    held = [np.zeros(0, np.int64)] * 3  # member and slot, score, id
    for start in range(0, len(v), SLAB):
        active = np.flatnonzero((open_ & (need <= (lengths * bound[start])[:, None])).any(axis=1))
        if not len(active):
            break  # nothing behind can reach what any member needs
        score = (u[active] @ v[start : start + SLAB].T).astype(np.int64)
        other = own[active][:, None] != ids[start : start + SLAB][None, :]
        found = [held]
        for k in range(slots):
            m, c = np.nonzero((score >= need[active, k][:, None]) & (score <= high[active, k][:, None]) & other)
            found.append([active[m] * slots + k, score[m, c], ids[start + c]])
        key, got, who = (np.concatenate(x) for x in zip(*found, strict=True))
        at = np.lexsort((who, -got, key))
        key, got, who = key[at], got[at], who[at]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        full = place == top - 1
        need.reshape(-1)[key[full]] = got[full]  # low rises to the last that counts; ties with it still do
        held = [x[place < top] for x in (key, got, who)]
    return [held[0] // slots, held[0] % slots, held[1], held[2]]


def _meet(top: int):
    """A tile of anchors and a block of candidates -> node, slot, score, other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                u, v = _numbers(one["vecs"], one["dim"]), _numbers(one["b_vecs"], one["dim"])
                ids, cells = np.array(one["b_ids"], np.int64), np.array(one["cells"])
                node, own = np.array(one["nodes"], np.int64), np.array(one["ids"], np.int64)
                low, high = np.array(one["low"], np.int64), np.array(one["high"], np.int64)
                starts = np.r_[0, np.flatnonzero(np.diff(cells)) + 1, len(cells)].tolist()
                for a, b in zip(starts, starts[1:], strict=False):
                    for c in range(a, b, MEMBERS):
                        part = slice(c, min(c + MEMBERS, b))
                        m, slot, score, other = walk(u[part], own[part], low[part], high[part], v, ids, top)
                        if len(m):
                            cols = [pa.array(node[part][m]), pa.array(slot.astype(np.int32)), pa.array(score), pa.array(other)]
                            yield pa.RecordBatch.from_arrays(cols, ["node", "slot", "score", "other"])

    return run


def _reach(a: str, b: str) -> Column:
    """Most that a vector of length one in ball ``a`` can score with one of ``b``."""
    dot = F.aggregate(F.zip_with(F.col(f"{a}centre"), F.col(f"{b}centre"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.least(F.greatest(dot, F.lit(-1.0)), F.lit(1.0))) - F.col(f"{a}radius") - F.col(f"{b}radius") - 1e-6
    return F.col(f"{b}longest") * F.greatest(F.cos(F.greatest(angle, F.lit(0.0))), F.lit(0.0)) * (1 + 1e-9)


def _best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each node and slot, with ``place`` from 1 on; parts of a node are cut before the shuffle."""
    order = Window.partitionBy("node", "slot").orderBy(F.col("score").desc(), "other")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def _search(anchors: DataFrame, blocks: DataFrame, slots: DataFrame, same: bool, top: int) -> DataFrame:
    """``node, slot, score, other, place`` for the slots (``node, low, high``: arrays) among blocks of the anchors' label, or of all others."""
    meta = materialise(blocks.select("block", "dim", "label", "centre", "radius", "longest"))
    b_side = meta.select("block", F.col("dim").alias("b_dim"), F.col("label").alias("b_label"), *(F.col(c).alias(f"b_{c}") for c in ("centre", "radius", "longest")))

    def tiles(slots: DataFrame) -> DataFrame:
        """Tiles of the anchors that still look for something, and the least that a member needs over its length."""
        wants = F.exists(F.zip_with("low", "high", lambda a, b: a <= b), lambda x: x)
        rows = anchors.join(slots.where(wants), "node")
        least = F.array_min(F.zip_with("low", "high", lambda a, b: F.when(a <= b, a)))  # null where nothing is wanted
        length = F.sqrt("norm2")
        rows = rows.withColumn("need", F.when(length > 0, least / length).otherwise(F.when(least <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))))
        packed = rows.groupBy("tile", "dim", "label").agg(
            F.sort_array(F.collect_list(F.struct("cell", "node", "id", "low", "high", "vec"))).alias("m"), F.min("need").alias("need")
        )
        names = [("m.cell", "cells"), ("m.node", "nodes"), ("m.id", "ids"), ("m.low", "low"), ("m.high", "high"), ("m.vec", "vecs")]
        packed = packed.select("tile", "dim", "label", "need", *(F.col(a).alias(b) for a, b in names))
        balls = T_TILE + ", centre array<double>, radius double, longest double"
        return materialise(packed.mapInArrow(_with_balls, balls))

    def pairs(tiles: DataFrame) -> DataFrame:
        """Tile and block numbers with the bound of the pair."""
        t = tiles.select("tile", "dim", "label", "need", "centre", "radius", "longest")
        if same:
            met = t.join(b_side, (F.col("dim") == F.col("b_dim")) & (F.col("label") == F.col("b_label")))
        else:
            last = t.agg(F.max("tile")).first()[0]
            every = b_side.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last or 0).cast("long"))))
            met = t.join(every, "tile").where((F.col("dim") == F.col("b_dim")) & (F.col("label") != F.col("b_label")))
        return met.select("tile", "block", "need", _reach("", "b_").alias("reach"))

    def meet(tiles: DataFrame, pairs: DataFrame) -> DataFrame:
        side = blocks.select("block", F.col("ids").alias("b_ids"), F.col("vecs").alias("b_vecs"))
        t = tiles.select("tile", "dim", "cells", "nodes", "ids", "low", "high", "vecs")
        met = pairs.select("tile", "block").join(t, "tile").join(side, "block").drop("tile", "block")
        found = materialise(met.mapInArrow(_meet(top), "node long, slot int, score long, other long"))
        return _best(found, top)

    near = tiles(slots)
    nearest = Window.partitionBy("tile").orderBy(F.col("reach").desc(), "block")
    ranked = materialise(pairs(near).withColumn("n", F.row_number().over(nearest)))
    best = meet(near, ranked.where(F.col("n") <= HEAD))
    if ranked.agg(F.max("n")).first()[0] in range(HEAD + 1) or ranked.isEmpty():
        return best
    best = materialise(best)
    # what the slots need now: the last of a full one, else the range's end as before
    full = best.where(F.col("place") == top).groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("full"))
    raised = slots.join(full, "node", "left").select(
        "node", F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("full", i), x))).alias("low"), "high"
    )
    left = tiles(raised)
    rest = ranked.where(F.col("n") > HEAD).select("tile", "block", "reach").join(left.select("tile", "need"), "tile").where("reach >= need")
    return _best(best.drop("place").unionByName(meet(left, rest).drop("place")), top)


T_TILE = "tile long, dim int, label string, need double, cells array<int>, nodes array<long>, ids array<long>, low array<array<long>>, high array<array<long>>, vecs array<binary>"
T_BLOCK = "block long, dim int, label string, ids array<long>, vecs array<binary>, centre array<double>, radius double, longest double"


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every row that the condition ``anchor`` marks.

    A component x becomes floor(scale * x); a score is the integer inner
    product.  An anchor's positives are its first ``positives`` other rows of
    the same label by score, then by smaller id; the negatives of each are the first
    ``negatives`` rows of other labels with ``low`` to ``high`` percent of the
    positive's score (0 < low <= high: a negative positive score has none).

    Rows with a null id, label or vector, an empty vector, null or non-finite components or a
    scaled length of 2**27.5 and more take no part.  Vectors of different length
    have no score.  Equal rows are one row; rows that share an id are never
    each other's positive or negative.  Equal vectors of a label tie: only the
    smallest ids of such a class can be among the first, so no more are searched.  Extra
    columns are ignored; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    if not 0 < low <= high <= 100:
        raise ValueError("0 < low <= high <= 100 is wanted")
    cols = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor")]
    rows = df.select(*cols, F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = rows.where("id is not null and label is not null and embedding is not null")
    plain = rows.select("id", "label", "embedding").mapInArrow(_prepared(scale), "id long, label string, dim int, norm2 double, vec binary")
    plain = materialise(plain.distinct())
    marked = rows.where("anchor").select("id", "label").distinct()
    anchors = plain.join(marked, ["id", "label"], "left_semi")

    sample = anchors.orderBy(F.xxhash64("id", "vec"), "id").limit(SAMPLE).select("dim", "vec").collect()
    centres, by_dim = {}, {}
    for r in sample:
        by_dim.setdefault(r.dim, []).append(r.vec)
    k = min(CLUSTERS, 1 + anchors.count() // PER_CLUSTER)
    for dim, raws in by_dim.items():
        centres[dim] = fit_clusters(_numbers(raws, dim), k)
    shape = "id long, label string, dim int, norm2 double, vec binary, cell int"

    def dealt(some: DataFrame, size: int, name: str) -> DataFrame:
        """Rows sorted by (label, cell) and numbered by blocks of at most ``size``, all of one label and vector length."""
        placed = running_sum(some.mapInArrow(_cells(centres), shape), ["dim", "label"], ["cell", "id", "vec"], F.lit(1), "seq")
        placed = materialise(placed.withColumn("part", F.floor(F.col("seq") / size).cast("long")))
        parts = placed.select("dim", "label", "part").distinct()
        parts = running_sum(parts, [], [F.col("dim"), F.col("label"), F.col("part")], F.lit(1), name)
        return placed.join(parts, ["dim", "label", "part"]).drop("part", "seq")

    # of equal vectors only so many can be first for anybody
    same_vector = Window.partitionBy("label", "dim", "vec").orderBy("id")
    few = plain.withColumn("n", F.row_number().over(same_vector)).where(F.col("n") <= max(positives, negatives) + 1).drop("n")
    members = materialise(dealt(anchors, TILE, "tile").withColumn("node", F.monotonically_increasing_id()))
    packed = dealt(few, BLOCK, "block").groupBy("block", "dim", "label").agg(F.sort_array(F.collect_list(F.struct("id", "vec"))).alias("m"))
    packed = packed.select("block", "dim", "label", F.col("m.id").alias("ids"), F.col("m.vec").alias("vecs"))
    blocks = materialise(packed.mapInArrow(_with_balls, T_BLOCK))

    every = members.select("node", F.array(F.lit(NO_LOW)).alias("low"), F.array(F.lit(NO_HIGH)).alias("high"))
    best = materialise(_search(members, blocks, every, True, positives))
    score = F.col("score")
    ends = best.select(
        "node",
        "place",
        F.when(score >= 0, F.expr(f"({low} * score + 99) div 100")).otherwise(F.lit(1)).cast("long").alias("a"),
        F.when(score >= 0, F.expr(f"({high} * score) div 100")).otherwise(F.lit(0)).cast("long").alias("b"),
    )
    slots = ends.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "a", "b"))).alias("m"))
    # anchors with fewer positives get empty ranges, so that all have as many slots
    missing = lambda x: F.array_repeat(F.lit(x).cast("long"), (F.lit(positives) - F.size("m")).cast("int"))
    slots = materialise(slots.select("node", F.concat("m.a", missing(1)).alias("low"), F.concat("m.b", missing(0)).alias("high")))
    mined = _search(members, blocks, slots, False, negatives)
    mined = mined.select("node", (F.col("slot") + 1).alias("p"), F.col("place").alias("rank"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    known = best.select("node", F.col("place").alias("p"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    out = mined.join(known, ["node", "p"]).join(members.select("node", F.col("id").alias("anchor_id")), "node")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
