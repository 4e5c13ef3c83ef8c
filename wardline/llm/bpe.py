"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

A text is cut by the tokenizer's pattern and each match merged separately.  A
segment tree over the match's byte positions holds, per live position, the rank
of the pair that starts there, and in every inner node the leftmost minimum.
A merge reads the root, joins the pair, and updates three leaves (the merged
position, its live neighbour before it, and the position that dies) in
logarithmic time each.  Short matches run through the same tree many at a
time, as rows of arrays; long ones run alone on lists.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import ship, slices

WIDTHS = (8, 16, 32)  # bytes of the matches that are merged many at a time
CACHE = 300_000  # encoded matches that a worker remembers
SLICE = 1 << 20  # bytes of text that are cut into matches at a time, one text at least
ROWS = 20_000  # matches merged at a time
NONE = np.int64(1) << 62


class Vocabulary:
    """Ranks, the pairs that merge, and an encoder; ``lines`` is the content of a rank file."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        size = max(self.ranks.values()) + 1
        self.bytes = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.size = size
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = rank
        self.pairs = pairs
        order = sorted(pairs)
        self.pair_keys = np.array([*order, NONE], np.int64)
        self.pair_ranks = np.array([*(pairs[k] for k in order), 0], np.int64)
        both = self.single[:, None] * size + self.single[None, :]
        self.byte_pairs = self.pair_rank(both // size, both % size).ravel()
        self.cache: dict[str, bytes] = {}  # ids of a match as 32-bit numbers

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where they don't merge."""
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def encode_long(self, piece: bytes) -> list[int]:
        """Ids of one match, by a segment tree in lists."""
        n = len(piece)
        leaves = 1 << max(0, (n - 1).bit_length())
        pairs, size, none = self.pairs, self.size, (int(NONE), 0)
        token = [int(self.single[b]) for b in piece]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        tree = [none] * (2 * leaves)

        def value(i: int) -> tuple[int, int]:
            rank = pairs.get(token[i] * size + token[after[i]]) if after[i] >= 0 else None
            return none if rank is None else (rank, i)

        def put(i: int, x: tuple[int, int]) -> None:
            i += leaves
            tree[i] = x
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        for i in range(n):
            tree[leaves + i] = value(i)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] is not none and tree[1][0] < none[0]:
            rank, i = tree[1]
            gone = after[i]
            token[i], after[i] = rank, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            put(gone, none)
            put(i, value(i))
            if before[i] >= 0:
                put(before[i], value(before[i]))
        out, i = [], 0
        while 0 <= i < n:
            out.append(token[i])
            i = after[i]
        return out

    def encode_short(self, pieces: Sequence[bytes], width: int) -> list[bytes]:
        """Ids (32-bit numbers) of many matches of at most ``width`` bytes (a power of two): row k of flat arrays is match k's tree."""
        n = len(pieces)
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)
        length = np.fromiter(map(len, pieces), np.int64, n)[:, None]
        place = np.arange(width)
        live = (place < length).ravel()
        token = self.single[raw].ravel()
        after = np.where(place + 1 < length, place + 1, width).ravel()
        before = np.tile(place - 1, n)
        rank = self.byte_pairs[raw[:, :-1].astype(np.int64) * 256 + raw[:, 1:]]
        tree = np.full((n, 2 * width), NONE, np.int64)
        tree[:, width : 2 * width - 1] = np.where((place[1:] < length) & (rank < NONE), rank * width + place[:-1], NONE)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        tree = tree.ravel()

        def put(row: np.ndarray, i: np.ndarray, x: np.ndarray) -> None:
            root, at = row * (2 * width), i + width
            tree[root + at] = x
            for _ in range(width.bit_length() - 1):  # all leaves are equally deep
                x = np.minimum(x, tree[root + (at ^ 1)])
                at = at >> 1
                tree[root + at] = x

        def value(row: np.ndarray, i: np.ndarray) -> np.ndarray:
            at = row * width
            nxt = after[at + i]
            got = self.pair_rank(token[at + i], token[at + np.minimum(nxt, width - 1)])
            return np.where((nxt < width) & (got < NONE), got * width + i, NONE)

        row = np.flatnonzero(tree[1 :: 2 * width] < NONE)
        while len(row):
            at, top = row * width, tree[row * (2 * width) + 1]
            i = top & (width - 1)
            gone = after[at + i]
            nxt = after[at + gone]
            token[at + i], after[at + i], live[at + gone] = top // width, nxt, False
            has = nxt < width
            before[(at + nxt)[has]] = i[has]
            put(row, gone, np.full(len(row), NONE))
            put(row, i, value(row, i))
            prev = before[at + i]
            has = prev >= 0
            put(row[has], prev[has], value(row[has], prev[has]))
            row = row[tree[row * (2 * width) + 1] < NONE]
        flat = token[live].astype("<i4").tobytes()
        ends = (4 * np.cumsum(live.reshape(n, width).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of matches into the cache."""
        if len(self.cache) + len(pieces) > CACHE:
            self.cache.clear()
        by_width = {w: [] for w in WIDTHS}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            width = next((w for w in WIDTHS if len(raw) <= w), None)
            if rank is not None:
                self.cache[piece] = rank.to_bytes(4, "little")
            elif width:
                by_width[width].append((piece, raw))
            else:
                self.cache[piece] = np.array(self.encode_long(raw), "<i4").tobytes()
        for width, some in by_width.items():
            for i in range(0, len(some), ROWS):
                part = some[i : i + ROWS]
                self.cache.update(zip((piece for piece, _ in part), self.encode_short([raw for _, raw in part], width), strict=True))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of every text."""
        cut = [self.pattern.findall(t) for t in texts]
        seen = set(chain.from_iterable(cut))
        missing = seen - self.cache.keys()
        if len(self.cache) + len(missing) > CACHE:  # it will be emptied: learn all that is needed here
            missing = seen
        if missing:
            self.learn(missing)
        known = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(known, pieces)), "<i4") for pieces in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


_LOADED: dict[tuple[bytes, str], Vocabulary] = {}  # one per worker process and rank file


def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    key = (lines, pattern)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(lines, pattern)
    return _LOADED[key]


def encode(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``df`` plus ``name``, the ids (array of int) of each whole text; null and empty texts have none.

    ``ranks`` is the path of a rank file on the driver, sent to the workers once (its size is that of the vocabulary).
    A column called ``name`` is replaced.
    """
    ship(df.sparkSession)
    df = df.drop(name)
    with open(ranks, "rb") as f:
        lines = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(lines.value, pattern)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                found = words.encode([t or "" for t in part.column(text_col).to_pylist()])
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` plus ``name``, the bytes of each row's ids; a null list gives no bytes, a null or unknown id raises an error."""
    ship(df.sparkSession)
    df = df.drop(name)
    with open(ranks, "rb") as f:
        lines = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _vocabulary(lines.value, ".").bytes
        for batch in batches:
            col = batch.column(ids_col)
            flat = col.flatten().to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)).tolist()
            spans = zip([0, *ends], ends, strict=False)
            decoded = pa.array([b"".join(map(token.__getitem__, flat[a:b])) for a, b in spans], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())]))


def round_trip(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id, n_tokens, ids_sha256, decoded_sha256``: the text encoded, the ids decoded again, both digested.

    Encoder and decoder share a pass, so the ids, larger than the text, stay in
    the worker.  Null and empty texts have no ids; repeated rows and null ids
    are rows of their own; extra columns are ignored.
    """
    ship(df.sparkSession)
    with open(ranks, "rb") as f:
        lines = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(lines.value, pattern)
        number = list(map(str, range(words.size)))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                counts, coded, decoded = [], [], []
                for ids in words.encode([t or "" for t in part.column("text").to_pylist()]):
                    counts.append(len(ids))
                    coded.append(sha256(",".join(map(number.__getitem__, ids.tolist())).encode()).hexdigest())
                    decoded.append(sha256(words.decode(ids)).hexdigest())
                cols = [part.column("id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ("ids_sha256", "decoded_sha256")
    fields = [T.StructField("n_tokens", T.LongType()), *(T.StructField(n, T.StringType()) for n in names)]
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *fields]))
