"""Rows with everything that may go wrong, and small brute-force answers."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASH = ["id", "row", "key", "size", "score", "ids", "fingerprint", "component", "node", "__sha", "__size", "__key", "__again", "__times", "__score", "keep_id", "kept", "slot"]


def lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


def frame(spark, rows, clash: bool = True):
    """(doc_id, text, source) rows as a documents table, with columns that clash."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df


def messy() -> list[tuple]:
    """(doc_id, text, source): nulls, empties, ties, repeated rows, a very long text, several bytes a character."""
    base = " ".join(f"word{i}" for i in range(60))
    return [
        (1, base, "a"),
        (2, base.upper(), "a"),
        (3, base, None),
        (3, base, None),  # a repeated row
        (4, base.replace("word59", "end"), "b"),
        (5, None, "a"),
        (6, "", "b"),
        (7, " \n\t ", "b"),
        (8, "short", "c"),
        (None, "short", "c"),
        (None, "only here", None),
        (9, "Été à la plage, 日本語 \U0001f600 " * 3, "c"),
        (10, "ÉTÉ À LA PLAGE, 日本語 \U0001f600 " * 3, "c"),  # other letters than A-Z stay
        (11, " ".join(f"w{i % 977}" for i in range(60_000)), "b"),
        (12, "a" * 30_000, "b"),
    ]


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text: str | None, n: int = 4) -> int:
    words = lower(text).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def exact_groups(rows) -> dict:
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lower(t)].append(i)
    return groups


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
