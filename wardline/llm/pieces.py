"""SentencePiece (BPE model) encoding and decoding, by vectorised merge rounds.

A text becomes one line of symbols (spaces as U+2581, one more in front).  The
line is cut wherever no piece of the vocabulary spans the two characters, which
no merge can cross; what lies between two cuts is a word.  Words are merged many at a
time on flat numpy arrays of their symbols: every round takes each word's
smallest pair rank (a segmented minimum), merges that pair's occurrences from
the left, and compacts the arrays, until no pair remains.  Occurrences are
merged together only as far as one after the other would give the same: behind
the first whose new neighbours could merge at the same rank or earlier, a word
waits for its next round.  Long words that have to wait so each time (runs
of thousands of spaces) end on a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from wardline.llm.common import ship, slices

SPACE = "▁"
CACHE = 300_000  # encoded words that a worker remembers
SLICE = 1 << 20  # bytes of text that are cut into words at a time, one text at least
SYMBOLS = 1 << 18  # symbols merged at a time, one word at least
LONG = 512  # symbols of a word that may end on the heap
NONE = np.int64(1) << 40
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # fixed values: the model file's kinds of pieces


def _valid_text(raw: bytes) -> str:
    """UTF-8 to text, one U+FFFD for each byte that starts no character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode())
            except UnicodeDecodeError:
                continue
            i += n
            break
        else:
            out.append("�")
            i += 1
    return "".join(out)


class Model:
    """Pieces, the pairs that merge, an encoder and a decoder; ``content`` is that of a model file.

    Takes BPE models with byte fallback that leave the text as it is but for
    spaces; a model with another kind, a character map, or pieces of the user's
    own raises ``ValueError``.
    """

    def __init__(self, content: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(content)
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = [p.type for p in proto.pieces]
        plain = norm.escape_whitespaces and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        if trainer.model_type != trainer.BPE or not plain or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without a character map are encoded here")
        if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or kinds.count(BYTE) != 256:
            raise ValueError("only models with byte fallback and without unused or user-defined pieces are encoded here")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.eos = trainer.eos_id
        self.size = len(kinds)
        self.kinds = kinds
        self.texts = [p.piece for p in proto.pieces]
        self.unk_surface = trainer.unk_surface
        self.byte_ids = np.zeros(256, np.int32)
        self.byte_of = {}
        for i, (text, kind) in enumerate(zip(self.texts, kinds, strict=True)):
            if kind == BYTE:
                self.byte_of[i] = int(text[3:-1], 16)
                self.byte_ids[self.byte_of[i]] = i
        # symbols: pieces by their id, then characters that are only parts of pieces, then one for all other characters
        normal = {t: i for i, (t, k) in enumerate(zip(self.texts, kinds, strict=True)) if k == NORMAL}
        symbols = dict(normal)
        for c in sorted(set("".join(normal))):
            symbols.setdefault(c, len(kinds) + len(symbols) - len(normal))
        self.other = len(kinds) + len(symbols) - len(normal)
        self.char_symbol = np.full(0x110000, self.other, np.int64)
        chars = [c for c in symbols if len(c) == 1]
        self.char_symbol[[ord(c) for c in chars]] = [symbols[c] for c in chars]
        self.char_class = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.classes = len(chars) + 1
        self.inside = np.zeros(self.classes**2, bool)  # pairs of characters that some piece spans
        order = {s: n for n, s in enumerate(sorted({proto.pieces[i].score for i in normal.values()}, reverse=True))}
        pairs = {}
        for text, i in normal.items():
            for a, b in zip(text, text[1:], strict=False):
                self.inside[int(self.char_class[ord(a)]) * self.classes + int(self.char_class[ord(b)])] = True
            for cut in range(1, len(text)):
                a, b = symbols.get(text[:cut]), symbols.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * (self.other + 1) + b] = (order[proto.pieces[i].score], i)
        self.pairs = pairs
        keys = sorted(pairs)
        self.pair_keys = np.array([*keys, NONE], np.int64)
        self.pair_ranks = np.array([*(pairs[k][0] for k in keys), NONE], np.int64)
        self.pair_pieces = np.array([*(pairs[k][1] for k in keys), 0], np.int64)
        self.cache: dict[str, bytes] = {}  # ids of a word as 32-bit numbers

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where they don't merge) and piece of pairs of symbols."""
        key = a * (self.other + 1) + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE), self.pair_pieces[at]

    def _on_a_heap(self, symbols: list[int]) -> list[int]:
        """One word merged to its end, pair by pair: the places in ``symbols`` that stay; the list is changed."""
        n, width, pairs = len(symbols), self.other + 1, self.pairs
        after, before, heap = [*range(1, n + 1)], [*range(-1, n - 1)], []

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                key = symbols[i] * width + symbols[after[i]]
                if key in pairs:
                    heap.append((pairs[key][0], i, key)) if filling else heapq.heappush(heap, (pairs[key][0], i, key))

        filling = True
        for i in range(n):
            push(i)
        filling = False
        heapq.heapify(heap)
        while heap:
            _, i, key = heapq.heappop(heap)
            gone = after[i]
            if symbols[i] < 0 or gone >= n or symbols[i] * width + symbols[gone] != key:
                continue  # one of the two is merged by now
            symbols[i], symbols[gone], after[i] = pairs[key][1], -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            push(before[i])
        return [i for i in range(n) if symbols[i] >= 0]

    def _merge(self, cps: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words as one line of characters -> word number, symbol and first character of all that is left, in order."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        symbol, first = self.char_symbol[cps], np.arange(len(cps))
        rank = np.full(len(cps), NONE)
        rank[:-1] = np.where(word[1:] == word[:-1], self._pair(symbol[:-1], symbol[1:])[0], NONE)
        done = []
        while len(word):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(rank, starts)
            live = np.repeat(best < NONE, sizes)
            if not live.all():
                done.append((word[~live], symbol[~live], first[~live]))
                word, symbol, first, rank = word[live], symbol[live], first[live], rank[live]
                sizes, best = sizes[best < NONE], best[best < NONE]
                if not len(word):
                    break
            number = np.repeat(np.arange(len(sizes)), sizes)  # of the word, from 0 on
            hits = np.flatnonzero(rank == best[number])
            # of hits that overlap in a row, every other one, from the left
            row = np.maximum.accumulate(np.where(np.r_[True, np.diff(hits) != 1], np.arange(len(hits)), 0))
            take = hits[(np.arange(len(hits)) - row) % 2 == 0]
            piece = self._pair(symbol[take], symbol[take + 1])[1]
            mine = number[take]
            # what one merge after the other would meet: the merged or old symbol before, the old one behind
            ended = np.r_[False, (take[1:] == take[:-1] + 2)]
            prev = np.where(ended, np.r_[0, piece[:-1]], symbol[take - 1])
            new = self._pair(prev, piece)[0]
            new = np.where((take > 0) & (number[take - 1] == mine), new, NONE)
            behind = np.minimum(take + 2, len(word) - 1)
            next_ = self._pair(piece, symbol[behind])[0]
            next_ = np.where((take + 2 < len(word)) & (number[behind] == mine), next_, NONE)
            stops = np.minimum(new, next_) <= best[mine]
            if stops.any():
                before = np.cumsum(stops) - stops  # stops before this one, in all words
                own = before - before[np.searchsorted(mine, mine)]
                slow = np.unique(mine[stops & (own == 0) & (sizes[mine] > LONG)])
                take, piece, mine = take[own == 0], piece[own == 0], mine[own == 0]
                if len(slow):
                    ends = np.cumsum(sizes)
                    gone = np.zeros(len(word), bool)
                    for k in slow.tolist():
                        part = slice(ends[k] - sizes[k], ends[k])
                        gone[part] = True
                        line = symbol[part].tolist()
                        left = self._on_a_heap(line)
                        done.append((word[part][left], np.array(line)[left], first[part][left]))
                    kept = ~gone[take]
                    take, piece = take[kept], piece[kept]
                else:
                    gone = np.zeros(len(word), bool)
            else:
                gone = np.zeros(len(word), bool)
            symbol[take] = piece
            gone[take + 1] = True
            stays = ~gone
            place = np.cumsum(stays) - 1
            word, symbol, first, rank = word[stays], symbol[stays], first[stays], rank[stays]
            at = place[take]
            at = np.unique(np.r_[at, np.maximum(at - 1, 0)])
            follows = np.minimum(at + 1, len(word) - 1)
            rank[at] = np.where((at + 1 < len(word)) & (word[follows] == word[at]), self._pair(symbol[at], symbol[follows])[0], NONE)
        word, symbol, first = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(first, kind="stable")
        return word[order], symbol[order], first[order]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (32-bit numbers) of some words."""
        cps = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        word, symbol, first = self._merge(cps, np.fromiter(map(len, words), np.int64, len(words)))
        counts = np.ones(len(symbol), np.int64)
        unknown = np.flatnonzero(symbol >= self.size)  # characters that are no piece go as their UTF-8 bytes
        spelt = [chr(c).encode() for c in cps[first[unknown]].tolist()]
        counts[unknown] = list(map(len, spelt))
        ids = np.repeat(symbol, counts).astype(np.int32)
        if len(unknown):
            ids[np.repeat(symbol, counts) >= self.size] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        per_word = np.bincount(word, weights=counts, minlength=len(words)).astype(np.int64)
        flat, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(per_word)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, words: set[str]) -> None:
        """Put the ids of words into the cache."""
        if len(self.cache) + len(words) > CACHE:
            self.cache.clear()
        some, held = [], 0
        for w in words:
            if held and held + len(w) > SYMBOLS:
                self.cache.update(zip(some, self._encode_words(some), strict=True))
                some, held = [], 0
            some.append(w)
            held += len(w)
        if some:
            self.cache.update(zip(some, self._encode_words(some), strict=True))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of every text, the end id last."""
        lines = [self.prefix + t.replace(" ", SPACE) if t else "" for t in texts]
        joined = "".join(lines)
        cut = [0]
        if joined:
            cls = self.char_class[np.frombuffer(joined.encode("utf-32-le"), "<u4")].astype(np.int64)
            open_ = np.zeros(len(joined), bool)
            open_[1:] = self.inside[cls[:-1] * self.classes + cls[1:]]
            starts = np.cumsum([0, *map(len, lines)])
            open_[starts[:-1][np.diff(starts) > 0]] = False
            cut = np.flatnonzero(~open_).tolist()
        else:
            starts = np.zeros(len(lines) + 1, np.int64)
        words = [joined[a:b] for a, b in zip(cut, [*cut[1:], len(joined)], strict=True)] if joined else []
        seen = set(words)
        missing = seen - self.cache.keys()
        if len(self.cache) + len(missing) > CACHE:  # it will be emptied: learn all that is needed here
            missing = seen
        if missing:
            self.learn(missing)
        known = self.cache.__getitem__
        ends = np.searchsorted(cut, starts).tolist() if joined else [0] * (len(lines) + 1)
        end = np.array([self.eos], "<i4").tobytes()
        return [np.frombuffer(b"".join(map(known, words[a:b])) + end, "<i4") for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: np.ndarray | Sequence[int]) -> str:
        """Text of a sequence of ids: the space in front goes, control ids are silent, byte runs are read as UTF-8."""
        out, raw, front = [], bytearray(), bool(self.prefix)
        kinds, texts = self.kinds, self.texts
        for i in map(int, ids):
            if not 0 <= i < self.size:
                raise ValueError(f"no piece has the id {i}")
            kind = kinds[i]
            if kind == BYTE:
                raw.append(self.byte_of[i])
                front = False
                continue
            if raw:
                out.append(_valid_text(bytes(raw)))
                raw.clear()
            if kind == CONTROL:
                continue
            text = self.unk_surface if kind == UNKNOWN else texts[i]
            if kind == NORMAL and front and text.startswith(SPACE):
                text = text[1:]
            front = False
            out.append(text)
        if raw:
            out.append(_valid_text(bytes(raw)))
        return "".join(out).replace(SPACE, " ")


_LOADED: dict[bytes, Model] = {}  # one per worker process and model file


def _model(content: bytes) -> Model:
    if content not in _LOADED:
        _LOADED[content] = Model(content)
    return _LOADED[content]


def _sent(df: DataFrame, model: str):
    """The model file, sent to the workers once (its size is that of the vocabulary)."""
    ship(df.sparkSession)
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, model: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``df`` plus ``name``, the ids (array of int, the end id last) of each whole text; null and empty texts have the end id alone.

    ``model`` is the path of a model file on the driver.  A column called ``name`` is replaced.
    """
    df = df.drop(name)
    content = _sent(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(content.value)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                found = pieces.encode([t or "" for t in part.column(text_col).to_pylist()])
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` plus ``name``, the text of each row's ids; a null list gives an empty text, a null or unknown id raises an error."""
    df = df.drop(name)
    content = _sent(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(content.value)
        for batch in batches:
            col = batch.column(ids_col)
            flat = col.flatten().to_pylist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)).tolist()
            decoded = pa.array([pieces.decode(flat[a:b]) for a, b in zip([0, *ends], ends, strict=False)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def round_trip(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id, n_tokens, ids_sha256, decoded_sha256``: the text encoded, the ids decoded again, both digested.

    Encoder and decoder share a pass, so the ids, larger than the text, stay in
    the worker.  Null and empty texts have the end id alone and decode to an
    empty text; repeated rows and null ids are rows of their own; extra columns
    are ignored; an empty table gives an empty result.
    """
    content = _sent(df, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(content.value)
        number = list(map(str, range(pieces.size)))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                counts, coded, decoded = [], [], []
                for ids in pieces.encode([t or "" for t in part.column("text").to_pylist()]):
                    listed = ids.tolist()
                    counts.append(len(listed))
                    coded.append(sha256(" ".join(map(number.__getitem__, listed)).encode()).hexdigest())
                    decoded.append(sha256(pieces.decode(listed).encode()).hexdigest())
                cols = [part.column("id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ("ids_sha256", "decoded_sha256")
    fields = [T.StructField("n_tokens", T.LongType()), *(T.StructField(n, T.StringType()) for n in names)]
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *fields]))
