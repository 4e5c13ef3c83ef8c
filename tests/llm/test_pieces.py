"""SentencePiece encoding and decoding, held against the sentencepiece library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tests.llm.helpers import DOCS, frame, messy, sha
from wardline.llm import pieces
from wardline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL, add_eos=True)


@pytest.fixture
def model():
    with open(MODEL, "rb") as f:
        return pieces.Model(f.read())


def some_texts() -> list[str]:
    rnd = random.Random(11)
    parts = ["▁", " ", "  ", "a", "aa", "The ", " the", "\n", "\t", "日本語", "é", "\U0001f600", "\0", "</s>", "<unk>", "<0x41>", "22", "==", "Limit", "́", "\r\n", "�"]
    out = ["", " ", "a" * 3000, " " * 3001 + "x", "ab" * 999, "=-" * 999, "\n" * 1500]
    out += ["".join(rnd.choice("abcdefghijklmnop") for _ in range(5000)), "".join(rnd.choice("etaoin shrdlu") for _ in range(5000))]
    out += ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 25))) for _ in range(1500)]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x400, 0x460), rnd.randrange(0x4E00, 0x9FFF), rnd.randrange(0x10000, 0x10FFFF)]))
                    for _ in range(rnd.randrange(1, 60))) for _ in range(800)]
    return out


@pytest.mark.parametrize("long", [4, 512])  # 4: words go to the heap as soon as they must wait
def test_encoder_equals_library(library, model, monkeypatch, long):
    monkeypatch.setattr(pieces, "LONG", long)
    monkeypatch.setattr(pieces, "SYMBOLS", 3000)
    texts = some_texts()
    want = library.encode(texts)
    assert [a.tolist() for a in model.encode(texts)] == want
    monkeypatch.setattr(pieces, "CACHE", 50)  # emptied at every call
    model.cache.clear()
    assert [model.encode([t])[0].tolist() for t in texts[:60]] == want[:60]


def test_decoder_equals_library(library, model):
    rnd = random.Random(12)
    lists = library.encode(some_texts())
    lists += [[rnd.randrange(model.size) if rnd.random() < 0.5 else rnd.randrange(262) for _ in range(rnd.randrange(12))] for _ in range(4000)]
    assert [model.decode(x) for x in lists] == library.decode(lists)
    with pytest.raises(ValueError):
        model.decode([model.size])


def test_merges_wait_where_order_matters(model):
    """Words whose pairs tie or give better pairs on the way: one line and a heap agree."""
    rnd = random.Random(13)
    for _ in range(300):
        word = "▁" * rnd.randrange(0, 40) + "".join(rnd.choice(["lim", "it", "Li", "uo", "s", "in", "c", "l"]) for _ in range(rnd.randrange(1, 9)))
        line = model.char_symbol[[ord(c) for c in word]].tolist()
        kept = model._on_a_heap(line)
        cps = np.array([ord(c) for c in word], "<u4")
        assert model._merge(cps, np.array([len(word)]))[1].tolist() == [line[i] for i in kept]


def test_other_models_are_refused():
    with open(MODEL, "rb") as f:
        proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.Model(proto.SerializeToString())
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        pieces.Model(proto.SerializeToString())


def test_frames(spark, library):
    rows = messy()
    df = frame(spark, rows)
    got = sorted(((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.round_trip(df, MODEL).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode())))
    assert got == sorted(want, key=str)
    coded = pieces.encode(df, MODEL)  # a column called ids is there and is replaced
    assert set(coded.columns) == set(df.columns) and len(coded.columns) == len(df.columns)
    assert all(r.ids == library.encode(r.text or "") for r in coded.collect())
    back = pieces.decode(coded.withColumn("ids", F.when(F.col("doc_id") != 8, F.col("ids"))), MODEL)
    for r in back.collect():
        assert r.decoded == ("" if r.ids is None else library.decode(r.ids))
    empty = spark.createDataFrame([], DOCS)
    assert pieces.round_trip(empty, MODEL).count() == pieces.encode(empty, MODEL).count() == 0


def test_query(spark, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_piece_round_trip"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = library.encode([d.text or "" for d in docs])
    for d, x in zip(docs, ids, strict=True):
        assert got[d.doc_id] == (len(x), sha(" ".join(map(str, x)).encode()), sha(library.decode(x).encode()))
    assert len(got) == len(docs)
