"""Spelling variants, held against plain Python over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, frame, messy
from wardline.llm import spelling
from wardline.llm.queries import QUERIES, _one_lost

SF = "/root/testdata/sf0.001"


def brute_counts(rows) -> Counter:
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def brute_variants(counts: dict, ratio: int = 10) -> set:
    """By the words that one lost or replaced code point leaves open."""
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1 :]] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * n:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def rows_of(df) -> set:
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def some_words(rnd, letters: str, n: int) -> dict:
    """Words and words one or two edits from them."""
    out = {}
    for _ in range(n):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 12)))
        out[word] = rnd.choice([1, 2, 30, 400, 5000])
        for _ in range(rnd.randrange(4)):
            i, c = rnd.randrange(len(word)), rnd.choice(letters)
            word = rnd.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])
            if len(word) > 1:
                out[word] = rnd.choice([1, 2, 3, 40, 500])
    return out


@pytest.mark.parametrize(("letters", "hot"), [("ab", 1), ("ab", 1 << 14), ("aéÿ日\U0001f600", 8), ("abcdefgh", 20)])
def test_all_pairs_are_found(spark, monkeypatch, letters, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    words = some_words(random.Random(len(letters) + hot), letters, 150)
    df = spark.createDataFrame([*words.items(), (None, 5), ("nothing", None)], "word string, n long")
    assert rows_of(spelling.spelling_variants(df)) == brute_variants(words)
    assert rows_of(spelling.spelling_variants(df, ratio=2)) == brute_variants(words, 2)


def test_a_common_stem_is_split(spark, monkeypatch):
    """Thousands of words with one head: pairs that are compared stay near the number of words."""
    rnd = random.Random(4)
    words = {"institutional" + "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(13)): 2 for _ in range(1500)}
    words |= {w[:20] + w[21:]: 40 for w in list(words)[:50]}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(spelling, "HOT", 64)
    compared = spark.sparkContext.accumulator(0)
    real = F.levenshtein

    def counted(a, b, k):
        @F.udf("int")
        def one(d):
            compared.add(1)
            return d

        return one(real(a, b, k))

    monkeypatch.setattr(spelling.F, "levenshtein", counted)
    got = rows_of(spelling.spelling_variants(df))
    monkeypatch.undo()
    assert got == brute_variants(words)
    assert compared.value < 10 * len(words)


def test_counts_of_messy_rows(spark):
    rows = [(i, t) for i, t, _ in messy()]
    rows += [(20, "Zebrafinch zebrafinch ZEBRAFINCH zebrafincé Écoleverte écoleverte a×bcdefgh short"), (21, "x" * 5000 + " " + "x" * 5000), (22, "x" * 5001 + " " + "x" * 5001)]
    df = frame(spark, [(i, t, "a") for i, t in rows])
    counts = spelling.count_words(df, change=_one_lost)
    assert {r.word: r.n for r in counts.collect()} == brute_counts(rows)
    assert rows_of(spelling.spelling_variants(counts)) == brute_variants(brute_counts(rows))


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert spelling.spelling_variants(spelling.count_words(docs)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(spelling.count_words(docs), ratio=1)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(QUERIES["op12_spelling_variants"](spark, SF))
    assert got == brute_variants(brute_counts(docs))
    assert any(form for _, form, *_ in got)
