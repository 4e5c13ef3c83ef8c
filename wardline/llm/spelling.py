"""Spelling variants: words one edit apart, met by asymmetric q-chunks.

Of two words one edit apart the longer (of equal length: either) contributes
two disjoint chunks of half its length, its head and its tail; the other
contributes its positional grams of that length.  One edit leaves a chunk whole
and moves it by at most one place, so the words meet on a chunk within shift
one (which shift, the two lengths tell), and an edit distance verifies them.

Where too many words share a chunk the same is done again with what is left of the words: given
an equal head (or tail), the rests are one edit apart and have an equal head or
tail of their own.  So a common stem is split as often as it takes, and words
are only compared when they agree in nearly all their letters; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import fresh, materialise

LETTERS = "A-Za-zÀ-ÿ"  # fixed values: what a word may consist of
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT = 1 << 14  # comparisons of a chunk from which its words are split further


def count_words(
    df: DataFrame,
    text_col: str = "text",
    min_length: int = 7,
    min_count: int = 2,
    change: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``word, n``: maximal runs of letters in whole texts, A-Z lower-cased, at least so long and so frequent over all rows.

    ``change`` maps a lower-cased run to the word that counts, which may be
    shorter (it may use other columns of the row); lengths are judged before
    and after it.  Null and empty texts have no words; every row of a repeated
    document counts.  Shorter runs never leave the text; counts are summed in
    each task before the shuffle.
    """
    run = fresh(df, "__run")
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    rows = df.select(*df.columns, F.explode(found).alias(run))
    word = F.translate(F.col(run), UPPER, LOWER)
    word = change(word) if change else word
    words = rows.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _part(start: Column, n: Column) -> Column:
    """Code points of ``word`` from place ``start`` (from 0 on)."""
    return F.col("word").substr((start + 1).cast("int"), n.cast("int"))


def _split(side: DataFrame) -> DataFrame:
    """Each row (``key``; ``word, n``; ``lo, hi``: the rest; ``short``: how much shorter the rest is than that of the chunks' word) as two.

    The chunk's length follows from the chunks' word, on both sides; a row's chunk goes into the key and leaves the rest.
    """
    q = F.floor((F.col("hi") - F.col("lo") + F.col("short")) / 2).cast("int")
    head = F.struct(F.xxhash64("key", F.lit(0), _part(F.col("lo"), q)).alias("key"), (F.col("lo") + q).alias("lo"), F.col("hi").alias("hi"))
    tail = F.struct(F.xxhash64("key", F.lit(1), _part(F.col("hi") - q, q)).alias("key"), F.col("lo").alias("lo"), (F.col("hi") - q).alias("hi"))
    return side.withColumn("s", F.explode(F.array(head, tail))).select("s.key", "word", "n", "s.lo", "s.hi", "short")


def near_words(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: all pairs of distinct words that differ by one inserted, deleted or replaced code point, once each; ``a`` is the longer or else the smaller one.

    ``words`` has one row per word (``word, n``); words of a single code point aren't compared.
    """
    size = F.length("word")
    base = words.where(size > 1).select("word", "n", F.lit(0).alias("lo"), size.alias("hi"))
    chunks = base.withColumn("short", F.lit(0)).withColumn("key", F.xxhash64("hi"))
    # grams meet the chunks of words as long as this one, or one longer
    grams = base.withColumn("short", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("key", F.xxhash64(F.col("hi") + F.col("short")))
    found = None
    while True:
        chunks, grams = materialise(_split(chunks)), materialise(_split(grams))
        sizes = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("c")).join(grams.groupBy("key").agg(F.count(F.lit(1)).alias("g")), "key")
        # words that differ in one last code point are all near: there is nothing left to split
        hot = materialise(sizes.where(F.col("c") * F.col("g") > HOT).select("key"))
        more = not hot.isEmpty()
        last = lambda side: side.where(F.col("hi") - F.col("lo") + F.col("short") < 2)
        cold = lambda side: side.join(hot, "key", "left_anti").unionByName(last(side).join(hot, "key", "left_semi")) if more else side
        a, b = cold(chunks), cold(grams)
        a = a.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        b = b.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "short")
        met = a.join(b, "key").where((F.col("short") == 1) | (F.col("a") < F.col("b")))
        met = met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")
        met = materialise(met)
        found = met if found is None else found.unionByName(met)
        if not more:
            return found.distinct()  # two words may share their head as well as their tail
        chunks, grams = (s.join(hot, "key", "left_semi").where(F.col("hi") - F.col("lo") + F.col("short") >= 2) for s in (chunks, grams))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: ``forms`` (``word, form``) followed to the last, by doubling; a form is always more frequent, so there is no cycle."""
    cur = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        cur = materialise(cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if cur.where("moved").isEmpty():
            return cur.drop("moved")
        cur = cur.drop("moved")


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    ``words`` has one row per word (``word, n``, as ``count_words`` gives).
    Two words are near when one inserted, deleted or replaced code point is all
    that differs.  ``form`` is the near word of largest n (ties: the smallest in
    code-point order) if that n is at least ``ratio`` times the word's, else
    null, as is ``form_n``; ``root`` follows forms to the last (the word itself
    if it has none); ``n_near`` counts near words.  Rows with a null word or n
    are ignored; an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its word")
    words = materialise(words.where("word is not null and n is not null").select("word", F.col("n").cast("long").alias("n")))
    pairs = near_words(words).withColumn(
        "both", F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
                        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    )
    pairs = pairs.select(F.explode("both").alias("p")).select("p.*")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
    known = words.join(best, "word", "left")
    takes = -F.col("first.less") >= ratio * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("first.near")).alias("form"), F.when(takes, -F.col("first.less")).alias("form_n"),
    )
    known = materialise(known)
    roots = _roots(known.where("form is not null"))
    out = known.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
