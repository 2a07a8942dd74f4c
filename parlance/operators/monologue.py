"""Monologue extraction: a speaker's uninterrupted stretches of words, scored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import CELL_MS, overlap_pairs


@dataclass(frozen=True)
class Limits:
    """Lengths in milliseconds."""

    shortest: int = 10_000
    ideal_from: int = 15_000
    ideal_to: int = 25_000
    longest: int = 30_000
    gap: int = 1_500


def length_score(ms: Column, x: Limits) -> Column:
    return (
        F.when(ms < x.shortest, ms / float(x.shortest) * 0.5)
        .when(ms > x.longest, 0.7)
        .when((ms >= x.ideal_from) & (ms <= x.ideal_to), 1.0)
        .when(ms < x.ideal_from, 0.7 + 0.3 * (ms - x.shortest) / float(max(1, x.ideal_from - x.shortest)))
        .otherwise(0.7 + 0.3 * (F.lit(x.longest) - ms) / float(max(1, x.longest - x.ideal_to)))
    )


def spans(words: DataFrame, turns: DataFrame, limits: Limits = Limits(), own_turns_only: bool = False) -> DataFrame:
    """Candidates: session_id, turn_idx, span, speaker, s_ms, e_ms, n_words, text, words, in_range, silence_ratio, interruption_free, score.

    A turn's words (midpoint inside, 1 ms slack) part where a pause exceeds limits.gap. own_turns_only takes
    all spans for uninterrupted, as where each speaker's turns are looked at alone.
    """
    mid = F.col("ws_ms") + F.col("we_ms")
    w = words.select("session_id", "seg_idx", "word_idx", "ws_ms", "we_ms", "word").withColumn("s_ms", mid).withColumn("e_ms", mid + 1)
    t = turns.select("session_id", "idx", "speaker", (F.col("s_ms") * 2 - 2).alias("s_ms"), (F.col("e_ms") * 2 + 3).alias("e_ms"))
    inside = overlap_pairs(w, t, bucket_ms=CELL_MS * 2).select("l.*", F.col("r.idx").alias("turn_idx"), F.col("r.speaker").alias("turn_speaker")).drop("s_ms", "e_ms")
    w = W.partitionBy("session_id", "turn_idx").orderBy("ws_ms", "seg_idx", "word_idx")
    opened = inside.withColumn("_new", F.when(F.col("ws_ms") - F.lag("we_ms").over(w) > limits.gap, 1).otherwise(0))
    parts = opened.withColumn("span", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    item = F.struct("ws_ms", "seg_idx", "word_idx", "we_ms", "word")
    out = parts.groupBy("session_id", "turn_idx", "span", F.col("turn_speaker").alias("speaker")).agg(
        F.min("ws_ms").alias("s_ms"),
        F.max_by("we_ms", F.struct("ws_ms", "seg_idx", "word_idx")).alias("e_ms"),
        F.count(F.lit(1)).alias("n_words"),
        F.sum(F.greatest(F.lit(0), F.col("we_ms") - F.col("ws_ms"))).alias("spoken_ms"),
        F.array_sort(F.collect_list(item)).alias("words"),
    )
    out = out.withColumn("text", F.trim(F.array_join(F.transform("words", lambda x: F.trim(x["word"])), " "))).where(F.col("text") != "")
    ms = F.col("e_ms") - F.col("s_ms")
    out = out.withColumn("silence_ratio", F.when(ms <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.col("spoken_ms") / ms))).withColumn("in_range", (ms >= limits.shortest) & (ms <= limits.longest))
    if own_turns_only:
        out = out.withColumn("interruption_free", F.lit(True))
    else:
        o = turns.select("session_id", "speaker", "s_ms", "e_ms")
        hit = overlap_pairs(out.select("session_id", "turn_idx", "span", "speaker", "s_ms", "e_ms"), o, F.col("l.speaker") != F.col("r.speaker"))
        # gathered by turn, as spans are dealt already: their words don't travel for it
        broken = hit.groupBy("l.session_id", "l.turn_idx").agg(F.collect_set("l.span").alias("_broken"))
        out = out.join(broken, ["session_id", "turn_idx"], "left").withColumn("interruption_free", ~F.coalesce(F.array_contains("_broken", F.col("span")), F.lit(False))).drop("_broken")
    score = length_score(ms, limits) * F.greatest(F.lit(0.0), 1.0 - F.col("silence_ratio") * 1.5) * F.when(F.col("interruption_free"), 1.0).otherwise(0.5)
    return out.withColumn("score", score).drop("spoken_ms")


def best(candidates: DataFrame, key: list[str] = ["session_id"], limits: Limits = Limits(), keep_words: bool = True) -> DataFrame:
    """The best candidate of each key: those in range first, then by score, then the earliest. One that is too long is cut after the words that start in time, where the last of them ends (words of turns that overlap may end in another order).

    Without keep_words the words are not returned, and only candidates that are too long take theirs along.
    """
    if not keep_words:
        candidates = candidates.withColumn("words", F.when(((F.col("e_ms") - F.col("s_ms")) > limits.longest) & ~F.col("in_range"), F.col("words")))
    rank = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("in_range"), F.desc("score"), "turn_idx", "span"))
    top = candidates.withColumn("_r", rank).where("_r = 1").drop("_r")
    long = (F.col("e_ms") - F.col("s_ms")) > limits.longest
    kept = F.filter("words", lambda x: x["ws_ms"] <= F.col("s_ms") + limits.longest)
    top = top.withColumn("_long", long & ~F.col("in_range")).withColumn("words", F.when(F.col("_long"), kept).otherwise(F.col("words")))
    end = F.when(F.col("_long"), F.array_max(F.transform("words", lambda x: x["we_ms"]))).otherwise(F.col("e_ms"))
    text = F.when(F.col("_long"), F.trim(F.array_join(F.transform("words", lambda x: F.trim(x["word"])), " "))).otherwise(F.col("text"))
    ms = F.col("e_ms") - F.col("s_ms")
    n = F.when(F.col("words").isNull(), F.col("n_words").cast("int")).otherwise(F.size("words"))
    out = top.withColumn("e_ms", end).withColumn("text", text).withColumn("n_words", n).withColumn("in_range", (ms >= limits.shortest) & (ms <= limits.longest)).drop("_long")
    return out if keep_words else out.drop("words")
