"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A bounded, documented sample of labelled documents (``SAMPLE`` rows, by a hash
of their ids) becomes a term matrix; its leading singular vectors map any text
to a short latent vector.  The labelled vectors are broadcast, and every
document gets its exact cosine with each of them, a block of documents at a
time; the nearest vote with their labels, weighted by similarity.

Terms are byte n-grams of the text as it stands and of its shape (letters by
case, digits, white space; marks stay themselves), the share of words that
repeat, and the length; counts are damped and weighted by rarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.common import ship, slices, texts

SAMPLE = 4096  # labelled rows that the classifier is fitted on, at most
HALF = 2048  # terms of each kind of n-gram, hashed
EXTRA = 64  # terms for repetition and length
TERMS = 2 * HALF + EXTRA
RANK = 48  # length of a latent vector
NEIGHBOURS = 15
BLOCK = 256  # documents whose cosines are taken at once
CHUNK = 1 << 20  # bytes of a text whose n-grams are counted at once


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes (letters by case, digits, space, line end; other marks themselves) and a hash of 18-bit codes."""
    kind = np.full(256, 1, np.int64)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[marks] = np.arange(len(marks)) + 6
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[[9, 11, 12, 13, 32]] = 4
    kind[10] = 5
    codes = np.arange(1 << 18, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return kind, ((codes >> np.uint64(40)) % np.uint64(HALF)).astype(np.int64)


KIND, SPREAD = _tables()


def term_counts(text: bytes) -> np.ndarray:
    """Damped counts of the text's terms; each of the three kinds has length 1 unless it is empty."""
    out = np.zeros(TERMS, np.float32)
    raw = np.frombuffer(text, np.uint8)
    grams, shapes = np.zeros(HALF), np.zeros(HALF)
    for at in range(0, len(raw), CHUNK):
        part = raw[at : at + CHUNK + 2].astype(np.int64)
        if len(part) < 3:
            break
        code = ((part[:-2] & 63) << 12) | ((part[1:-1] & 63) << 6) | (part[2:] & 63)
        grams += np.bincount(SPREAD[code], minlength=HALF)
        part = KIND[part]
        shapes += np.bincount(SPREAD[(part[:-2] << 12) | (part[1:-1] << 6) | part[2:]], minlength=HALF)
    for i, counts in enumerate((grams, shapes)):
        damped = np.log1p(counts)
        norm = np.linalg.norm(damped)
        if norm:
            out[i * HALF : (i + 1) * HALF] = damped / norm
    words = text.split()
    fresh = len(set(words)) / len(words) if words else 1.0
    out[2 * HALF + min(int(fresh * 16), 15)] = 0.7
    out[2 * HALF + 16 + min(len(words).bit_length(), 31)] = 0.3
    return out


@dataclass
class Model:
    """What scoring needs; its size is bounded by SAMPLE, TERMS and RANK."""

    rarity: np.ndarray  # weight of each term
    basis: np.ndarray  # TERMS x RANK
    vectors: np.ndarray  # labelled latent vectors, of length 1
    labels: np.ndarray
    prior: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Latent vectors of length 1 of rows of term counts."""
        x = (counts * self.rarity) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by cosine; the prior where none is near."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 8
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1)
        return np.clip((vote + 1e-6 * self.prior) / (total + 1e-6), 0.0, 1.0)


def fit_counts(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Latent-semantic model of labelled term counts (rows), by a randomised SVD with a fixed seed."""
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, RANK), np.float32), np.zeros((0, RANK), np.float32), labels, 0.5)
    rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    rows = counts * rarity
    basis = np.random.default_rng(0).standard_normal((TERMS, min(RANK + 16, len(rows)))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    small = np.linalg.eigh(np.asarray((rows @ basis).T @ (rows @ basis), np.float64))[1][:, ::-1][:, :RANK]
    model = Model(rarity, (basis @ small).astype(np.float32), np.zeros((0, 0)), labels, float(labels.mean()))
    model.vectors = model.latent(counts)
    return model


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents, those with the smallest hash of their id.

    Labels other than 0 and 1, null ids, and labels without a document are
    ignored; labels of one id are averaged; of documents with one id each counts.
    """
    ship(documents.sparkSession)
    mark = F.xxhash64(F.col("id").cast("string"))
    good = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    good = good.where(F.col("id").isNotNull() & F.col("label").isin(0.0, 1.0)).groupBy("id").agg(F.avg("label").alias("label"))
    ids = documents.select(F.col(id_col).alias("id")).distinct()
    chosen = good.join(ids, "id", "left_semi").orderBy(mark, "id").limit(sample)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "id")  # at most `sample` rows of two numbers

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, value = [], []
            for text in texts(batch, "text"):
                counts = term_counts(text)
                at = np.flatnonzero(counts)
                where.append(at.astype("<u2").tobytes())
                value.append(counts[at].tobytes())
            cols = [batch.column("id"), batch.column("label"), pa.array(where, pa.binary()), pa.array(value, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["id", "label", "at", "value"])

    fields = [T.StructField("at", T.BinaryType()), T.StructField("value", T.BinaryType())]
    schema = T.StructType([rows.schema["id"], T.StructField("label", T.DoubleType()), *fields])
    got = rows.mapInArrow(terms, schema).orderBy(mark, "id", "at", "value").limit(sample).collect()
    counts = np.zeros((len(got), TERMS), np.float32)
    for i, r in enumerate(got):
        counts[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["value"], np.float32)
    return fit_counts(counts, np.array([r["label"] for r in got], np.float64))


def score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``df`` plus ``name`` in 0 .. 1, higher where label 1 is likelier; null and empty texts are scored by their length term.

    A column called ``name`` is replaced.  Repeated rows and null ids are rows of their own.
    """
    ship(df.sparkSession)
    df = df.drop(name)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                for at in range(0, part.num_rows, BLOCK):
                    rows = part.slice(at, BLOCK)
                    found = sent.value.score(np.stack([term_counts(t) for t in texts(rows, text_col)]))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.float64())], [*rows.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(id_col: Column) -> Column:
    """True for ids whose labels are never learnt: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", name: str = "score") -> DataFrame:
    """``documents`` plus ``name``; labels of held-out ids are never learnt.  An empty document table gives an empty result."""
    learn = labels.where(~held_out(F.col(id_col))).select(id_col, F.col(label_col).alias("label"))
    return score(documents, fit(documents, learn, id_col, text_col), text_col, name)
