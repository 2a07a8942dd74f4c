"""Interaction metrics of conversations: overlaps, latencies, dominance, engagement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import in_order, speaker_overlaps

#: Shortest overlap, and the length below which one is an interruption.
MIN_OVERLAP_MS, INTERRUPTION_MS = 50, 500


def overlaps(turns: DataFrame, min_ms: int = MIN_OVERLAP_MS, interruption_ms: int = INTERRUPTION_MS) -> DataFrame:
    """session_id, speaker_a, speaker_b, o_start, o_end, dur_ms, is_interruption, overlap_type."""
    short = F.col("dur_ms") < interruption_ms
    return speaker_overlaps(turns, min_ms).select("session_id", F.col("a.speaker").alias("speaker_a"), F.col("b.speaker").alias("speaker_b"), "o_start", "o_end", "dur_ms", short.alias("is_interruption"), F.when(short, "backchannel").otherwise("crosstalk").alias("overlap_type"))


def latencies(turns: DataFrame) -> DataFrame:
    """Gaps of at least 0 ms between a turn and the next one, of another speaker: session_id, ord, from_speaker, to_speaker, latency_ms."""
    w = W.partitionBy("session_id").orderBy("s_ms", "idx")
    nxt = turns.select("session_id", F.row_number().over(w).alias("ord"), F.col("speaker").alias("from_speaker"), F.lead("speaker").over(w).alias("to_speaker"), (F.lead("s_ms").over(w) - F.col("e_ms")).alias("latency_ms"))
    return nxt.where((F.col("from_speaker") != F.col("to_speaker")) & (F.col("latency_ms") >= 0))


def engagement(mean_latency_s: Column, switches_per_min: Column, interruptions: Column, turns: Column) -> Column:
    """The cube root of three scores in 0..1: quick answers, frequent switches, some but not many interruptions."""
    ratio = interruptions / F.greatest(turns, F.lit(1))
    lively = F.when(ratio < 0.05, 0.5).when(ratio < 0.20, 0.5 + 0.5 * (ratio - 0.05) / 0.15).otherwise(F.greatest(F.lit(0.25), 1.0 - ratio * 2))
    product = F.exp(-F.coalesce(mean_latency_s, F.lit(5.0)) / 3.0) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), switches_per_min / 20.0)) * lively
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.pow(product, F.lit(1.0 / 3.0))))


def speaking_time(turns: DataFrame) -> DataFrame:
    """session_id, speaker, speaking_ms, n_turns."""
    return turns.groupBy("session_id", "speaker").agg(F.sum(F.greatest(F.lit(0), F.col("e_ms") - F.col("s_ms"))).alias("speaking_ms"), F.count(F.lit(1)).alias("n_turns"))


def dominance(turns: DataFrame) -> DataFrame:
    """Each speaker's share of a session's speech: session_id, speaker, speaking_ms, share, dominant (the largest share; of equals the first name)."""
    t = speaking_time(turns)
    w = W.partitionBy("session_id")
    total = F.sum("speaking_ms").over(w)
    first = F.row_number().over(w.orderBy(F.desc("speaking_ms"), "speaker")) == 1
    return t.select("session_id", "speaker", "speaking_ms", (F.col("speaking_ms") / F.when(total == 0, 1).otherwise(total)).alias("share"), first.alias("dominant"))


def overlap_ratio(turns: DataFrame) -> DataFrame:
    """Each speaker's time in overlaps against their speaking time; an overlap counts for both."""
    both = overlaps(turns).select("session_id", F.explode(F.array("speaker_a", "speaker_b")).alias("speaker"), "dur_ms").groupBy("session_id", "speaker").agg(F.sum("dur_ms").alias("overlap_ms"))
    joined = speaking_time(turns).join(both, ["session_id", "speaker"], "left")
    ms = F.coalesce("overlap_ms", F.lit(0))
    return joined.select("session_id", "speaker", ms.cast("long").alias("overlap_ms"), (ms / F.greatest(F.col("speaking_ms"), F.lit(1))).alias("overlap_ratio"))


def report(turns: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """One row per session with all interaction metrics; sessions without turns (if given) get zeros.

    A conversation lasts from its first start to the end of the turn that starts last.
    """
    w = W.partitionBy("session_id").orderBy("s_ms", "idx")
    t = in_order(turns).withColumn("next_speaker", F.lead("speaker").over(w)).withColumn("gap_ms", F.lead("s_ms").over(w) - F.col("e_ms"))
    change = F.col("speaker") != F.col("next_speaker")
    gap = F.when(change & (F.col("gap_ms") >= 0), F.col("gap_ms"))
    base = t.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("total_turns"),
        F.count(F.when(change, 1)).alias("switches"),
        (F.max_by("e_ms", "ord") - F.min("s_ms")).alias("duration_ms"),
        F.sum(gap).alias("latency_sum"),
        F.count(gap).alias("latency_count"),
        F.median(gap).alias("latency_median_ms"),
        F.min(gap).alias("latency_min_ms"),
        F.max(gap).alias("latency_max_ms"),
    )
    o = overlaps(turns).groupBy("session_id").agg(F.count(F.lit(1)).alias("overlap_segments"), F.sum("dur_ms").alias("overlap_ms"), F.count(F.when(F.col("is_interruption"), 1)).alias("interruption_count"))
    d = dominance(turns).where("dominant").select("session_id", F.col("speaker").alias("dominant_speaker"))
    joined = base.join(o, "session_id", "left").join(d, "session_id", "left")
    if sessions is not None:
        joined = sessions.select("session_id").distinct().join(joined, "session_id", "left")
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    per_min = F.coalesce(F.col("switches") * 60000.0 / F.greatest("duration_ms", F.lit(1)), F.lit(0.0))
    mean = F.col("latency_sum") / F.nullif(F.col("latency_count"), F.lit(0))
    score = F.when(F.col("total_turns").isNull(), 0.0).otherwise(F.round(engagement(mean / 1000.0, per_min, n(F.col("interruption_count")), F.col("total_turns")), 6))
    return joined.select(
        "session_id",
        n(F.col("total_turns")).alias("total_turns"),
        n(F.col("switches")).alias("switches"),
        n(F.col("duration_ms")).alias("duration_ms"),
        n(F.col("overlap_segments")).alias("overlap_segments"),
        n(F.col("overlap_ms")).alias("overlap_ms"),
        n(F.col("interruption_count")).alias("interruption_count"),
        mean.alias("latency_mean_ms"),
        F.col("latency_median_ms").cast("double").alias("latency_median_ms"),
        F.col("latency_min_ms").cast("long").alias("latency_min_ms"),
        F.col("latency_max_ms").cast("long").alias("latency_max_ms"),
        per_min.alias("switches_per_min"),
        "dominant_speaker",
        score.alias("engagement_score"),
    )
