"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

Each source's documents are put in a shuffled order on a line of words that
repeats once per pass, and the line up to the source's quota is cut into blocks of equal
word count.  The schedule has one slot per block of any source: slot i is the
van der Corput point of i, mapped through the sources' cumulative block counts,
so every stretch of the schedule mixes the sources in proportion.  The j-th
slot of a source takes its j-th block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import fresh, materialise, running_sum

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1024  # words of a block
BINS = 1024  # of the cumulative line, for the range lookup of points


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """``sources`` plus ``weight``: the given weights in turn, sources by code point, null last."""
    placed = running_sum(sources, [], [F.col("source").asc_nulls_last()], F.lit(1), "__place")
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("__place") % len(weights) + 1).cast("int"))
    return placed.withColumn("weight", pick.cast("double")).drop("__place")


def with_targets(sources: DataFrame, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size, weight) plus ``target`` words, which add up to ``share`` of all sizes.

    A target stops at ``cap`` times its source's size, and the excess is shared
    out again by weight until none is above.  Each round is one aggregate;
    what comes to the driver is two numbers.
    """
    most = F.col("source_size") * F.lit(float(cap))
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > most
        got = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, most).otherwise(F.lit(0.0))).alias("full"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["open"]:
            break
        was, level = level, (min(share, cap) * got["all"] - got["full"]) / got["open"]
        if level == was:
            break
    return sources.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def slots(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: ``slot, sid, nth`` for sources ``sid, quota`` (words); a source's slots are numbered 0, 1, ... in ``nth``."""
    spark = sources.sparkSession
    counted = sources.select("sid", F.ceil(F.col("quota") / block).cast("long").alias("blocks")).where("blocks > 0")
    line = materialise(running_sum(counted, [], ["sid"], F.col("blocks"), "start"))
    total = line.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (max(total, 1) - 1).bit_length())
    # bit reversal permutes 0 .. 2^bits - 1, so each point below `total` occurs once and every source gets its blocks
    mirrored = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long")
    points = spark.range(1 << bits).select(F.col("id").alias("slot"), mirrored.alias("point")).where(F.col("point") < total)
    width = max(1, -(-total // BINS))
    bins = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("blocks") - 1) / width)))
    spans = line.select("sid", "start", (F.col("start") + F.col("blocks")).alias("stop"), bins.alias("bin"))
    inside = (F.col("point") >= F.col("start")) & (F.col("point") < F.col("stop"))
    of = points.withColumn("bin", F.floor(F.col("point") / width)).join(spans, "bin").where(inside).select("slot", "sid")
    return running_sum(of, ["sid"], ["slot"], F.lit(1), "nth")


def mix(rows: DataFrame, sources: DataFrame, seed: int = 17, passes: int = 2, block: int = BLOCK) -> DataFrame:
    """Scheduled pieces: ``slot, row, pass, from_word, to_word`` for rows ``row, id, source, size`` and sources with targets.

    A row with no words has no piece.  Rows that tie in the shuffle (a repeated
    id) follow one another.  Reruns agree: the order is a hash of the id.
    """
    sid = running_sum(sources, [], [F.col("source").asc_nulls_last()], F.lit(1), "sid")
    sid = materialise(sid.withColumn("quota", F.floor("target").cast("long")))
    named = rows.join(sid, rows["source"].eqNullSafe(sid["source"])).select(rows["row"], "id", "size", "sid", "source_size", "quota")
    shuffled = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    line = running_sum(named.where("size > 0").withColumn("at", shuffled), ["sid"], ["at", "size", "row"], F.col("size"), "start")
    start = F.col("start") + F.col("pass") * F.col("source_size")
    line = line.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    line = line.withColumn("begin", start).withColumn("end", F.least(start + F.col("size"), F.col("quota"))).where("begin < end")
    nth = F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)))
    pieces = line.select("row", "sid", "pass", "begin", "end", nth.alias("nth"))
    low, high = F.greatest("begin", F.col("nth") * block), F.least("end", (F.col("nth") + 1) * block)
    return pieces.join(slots(sid, block), ["sid", "nth"]).select(
        "slot", "row", "pass", (low - F.col("begin")).alias("from_word"), (high - F.col("begin")).alias("to_word")
    )


def mixed_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2, seed: int = 17) -> DataFrame:
    """One row per input row: ``id, size, source_size, target, taken`` (words the mix takes, repeats counted), ``first_slot``.

    ``first_slot`` is the first slot of the schedule that takes words of the row, null if none does:
    rows read in its order come in the weights' proportions over any stretch.
    Null texts have size 0; a null source is a source of its own, the last.
    Sources without words have target 0.  Repeated rows are rows of their own.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialise(with_targets(materialise(cycled_weights(sources, weights)), share, float(passes)))
    taken = mix(rows, sources, seed, passes).select("row", "slot", (F.col("to_word") - F.col("from_word")).alias("words"))
    taken = taken.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    out = rows.join(taken, "row", "left").join(sources, rows["source"].eqNullSafe(sources["source"]))
    return out.select("id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, passes: int = 2, seed: int = 17) -> DataFrame:
    """The mix as documents: each row once per pass that takes any of its words, all columns kept.

    The one document per source that the quota cuts stays whole.  Documents
    without words take no part.  Rows alike in id, source and size share a decision.
    """
    size, key, times, time = (fresh(df, x) for x in ("__size", "__key", "__times", "__time"))
    sized = df.withColumn(size, word_count(F.col(text_col)))
    sized = sized.withColumn(key, F.to_json(F.struct(F.col(id_col).alias("i"), F.col(source_col).alias("s"), F.col(size).alias("n"))))
    rows = sized.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(size).alias("size"), F.col(key).alias("key"))
    rows = materialise(rows.distinct().withColumn("row", F.monotonically_increasing_id()))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialise(with_targets(materialise(cycled_weights(sources, weights)), share, float(passes)))
    used = mix(rows, sources, seed, passes).select("row", "pass").distinct().groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("n"))
    used = rows.join(used, "row").select(F.col("key").alias(key), F.col("n").alias(times))
    out = sized.join(used, key)
    return out.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*df.columns)
