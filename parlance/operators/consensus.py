"""Several recognisers' transcripts of a session: routing, agreement, scores, the winner, merged segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions import text as T
from ..sources import relations as R


# ---- routing ---------------------------------------------------------------------------------------------------


def quality_signals(segments: DataFrame, timed: str = "n_words", tokens: str = "n_words") -> DataFrame:
    """Per session, of segments with text: segment_count, mean_quality, low_ratio (under 0.45), word_timestamp_ratio."""
    s = segments.where(F.length(F.trim("text")) > 0)
    return s.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("segment_count"),
        F.avg("quality_score").alias("mean_quality"),
        F.avg(F.when(F.col("quality_score") < 0.45, 1.0).otherwise(0.0)).alias("low_ratio"),
        (F.sum(timed) / F.greatest(F.sum(F.greatest(F.col(tokens), F.lit(1))), F.lit(1))).alias("word_timestamp_ratio"),
    )


def recording_condition(value: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("indoor", "quiet_indoor", "reverberant_indoor", "studio"), "indoor").when(v.isin("outdoor", "street", "traffic", "field"), "outdoor").otherwise("unknown")


def noise_level(value: Column, snr_db: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin("low", "moderate", "high", "very_high"), v).when(snr_db >= 20, "low").when(snr_db >= 12, "moderate").when(snr_db > 0, "high").otherwise("unknown")


def switch_density(score: Column, frequency: Column, count: Column, multilingual: Column) -> Column:
    """How much a session switches languages, 0 to 1."""
    top = F.greatest(score, F.least(F.lit(1.0), frequency / 10.0), F.least(F.lit(1.0), count / 8.0))
    return F.least(F.lit(1.0), F.when(multilingual, F.greatest(top, F.lit(0.45))).otherwise(top))


def route(context: DataFrame, mode: str = "offline_standard", allow_paid: bool = False) -> DataFrame:
    """context with difficulty_score, reasons, should_escalate.

    Needs recording_condition, noise_level, mean_quality, low_ratio, word_timestamp_ratio, switch_density, overlap_s, review_priority.
    """
    c = F.col
    noisy = F.when(c("noise_level") == "moderate", 0.08).when(c("noise_level") == "high", 0.18).when(c("noise_level") == "very_high", 0.24).otherwise(0.0)
    urgent = F.lower("review_priority").isin("high", "urgent")
    low = lambda cap, x: F.least(F.lit(cap), x)
    score = (
        F.when(c("recording_condition") == "outdoor", 0.20).otherwise(0.0)
        + noisy
        + F.greatest(F.lit(0.0), 0.60 - c("mean_quality")) * 0.8
        + low(0.25, c("low_ratio") * 0.35)
        + low(0.20, F.greatest(F.lit(0.0), 0.75 - c("word_timestamp_ratio")) * 0.4)
        + low(0.20, c("switch_density") * 0.3)
        + low(0.12, c("overlap_s") / 10.0)
        + F.when(urgent, 0.10).otherwise(0.0)
    )
    reasons = F.array_compact(
        F.array(
            F.when(c("recording_condition") == "outdoor", "outdoor_audio"),
            F.when(c("noise_level").isin("high", "very_high"), "high_noise"),
            F.when(c("mean_quality") < 0.58, "low_local_confidence"),
            F.when(c("low_ratio") > 0.30, "many_low_quality_segments"),
            F.when(c("word_timestamp_ratio") < 0.65, "unstable_timestamps"),
            F.when(c("switch_density") >= 0.45, "dense_code_switching"),
            F.when(c("overlap_s") > 0.75, "heavy_overlap"),
            F.when(urgent, "high_review_priority"),
        )
    )
    total = F.round(F.least(F.lit(1.0), score), 4)
    return context.withColumns({"difficulty_score": total, "reasons": reasons}).withColumn("should_escalate", F.lit(mode == "premium_accuracy" and allow_paid) & (F.col("difficulty_score") >= 0.35))


def eligible_engines(engines: DataFrame, allow_paid: bool, premium: tuple[str, ...] = ()) -> DataFrame:
    """engines (engine, paid, enabled, preference) with eligible: local ones always, listed ones where paid use is allowed, others by their own flag."""
    ok = F.when(F.col("engine") == "whisper_local", True).when(F.col("engine").isin(*premium), F.lit(allow_paid)).otherwise(F.col("enabled"))
    return engines.withColumn("eligible", ok)


# ---- agreement -------------------------------------------------------------------------------------------------


def texts(candidates: DataFrame) -> DataFrame:
    """Per session and engine: the transcript's normalised words, its number of segments with text."""
    said = F.length(F.trim("text")) > 0
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said, F.struct("idx", F.trim("text").alias("t"))))), lambda x: x["t"]), " ")
    out = candidates.groupBy("session_id", "engine").agg(whole.alias("text"), F.count(F.when(said, 1)).alias("n_segments"))
    return out.withColumn("words", T.split_words(T.for_consensus(F.col("text"))))


def pairs(df: DataFrame, *by: str) -> DataFrame:
    """Each row of a session (and of equal columns by) beside each other engine's: session_id, by, engine, peer, a, b. Engines are few, so a session's rows are gathered, not joined."""
    key = ["session_id", *by]
    rows = df.where("session_id is not null and engine is not null").groupBy(*key).agg(F.collect_list(F.struct("*")).alias("rows"))
    each = rows.select(*key, "rows", F.explode("rows").alias("a")).select(*key, "a", F.explode("rows").alias("b"))
    return each.where("a.engine <> b.engine").select(*key, F.col("a.engine").alias("engine"), F.col("b.engine").alias("peer"), "a", "b")


def _compared(words: DataFrame, **kernels: Callable[[Column], Column]) -> DataFrame:
    """session_id, engine, peer and each kernel's value of every two engines' words: a session's lists are gathered once and go to a kernel once, not once a pair."""
    R.bound_batches(words.sparkSession)
    lists = words.where("session_id is not null and engine is not null").groupBy("session_id").agg(F.collect_list(F.struct("engine", "words")).alias("x"))
    found = lists.select("session_id", F.col("x.engine").alias("engines"), *(f(F.col("x.words")).alias(c) for c, f in kernels.items()))
    each = found.select("session_id", "engines", F.explode(F.arrays_zip(*kernels)).alias("p"))
    one = F.col(f"p.{next(iter(kernels))}")
    return each.select("session_id", F.get("engines", one["i"]).alias("engine"), F.get("engines", one["j"]).alias("peer"), *(F.col(f"p.{c}.x").alias(c) for c in kernels))


def bags(words: DataFrame) -> DataFrame:
    """Per pair of engines: words in common, with their number, against the longer list (two empty ones: 1), linear in the words.

    words: session_id, engine, words.
    """
    return _compared(words, bag=S.bag_overlaps)


def sequences(words: DataFrame) -> DataFrame:
    """Per pair of engines: the similarity of their sequences of words (two empty ones: 1)."""
    return _compared(words, similarity=S.sequence_similarities)


def timing(candidates: DataFrame) -> DataFrame:
    """Per pair of engines: agreement of the times of segments at one place, and of their number; needs segments with text."""
    w = W.partitionBy("session_id", "engine")
    s = candidates.where(F.length(F.trim("text")) > 0).select("session_id", "engine", F.row_number().over(w.orderBy("idx")).alias("place"), "s_ms", "e_ms", F.count(F.lit(1)).over(w).alias("n"))
    apart = F.sum(F.abs(F.col("a.s_ms") - F.col("b.s_ms")) + F.abs(F.col("a.e_ms") - F.col("b.e_ms")))
    d = pairs(s, "place").groupBy("session_id", "engine", "peer").agg(apart.alias("delta"), (2 * F.count(F.lit(1))).alias("m"), F.max("a.n").alias("na"), F.max("b.n").alias("nb"))
    count = 1.0 - F.abs(F.col("na") - F.col("nb")) / F.greatest("na", "nb")
    near = F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), F.col("delta") / F.col("m") / 1200.0))
    return d.select("session_id", "engine", "peer", (near * 0.7 + count * 0.3).alias("timing"), count.alias("count_score"))


def switch_agreement(a: str, b: str) -> Column:
    """Agreement of two engines' languages, numbers of switches and patterns (structs a and b)."""
    share = lambda x: F.size(F.array_intersect(f"{a}.{x}", f"{b}.{x}")) / F.greatest(F.size(F.array_union(f"{a}.{x}", f"{b}.{x}")), F.lit(1))
    x, y = F.col(f"{a}.switch_count"), F.col(f"{b}.switch_count")
    count = 1.0 - F.least(F.lit(1.0), F.abs(x - y) / F.greatest(x, y, F.lit(1)))
    patterns = F.when((F.size(f"{a}.patterns") == 0) & (F.size(f"{b}.patterns") == 0), 1.0).otherwise(share("patterns"))
    return share("langs") * 0.4 + count * 0.3 + patterns * 0.3


def preservation(detected: Column, score: Column, n_langs: Column, has_peers: Column, peers_multilingual: Column) -> Column:
    """How well a candidate keeps the session's code switching."""
    s = F.least(F.lit(1.0), score + F.least(F.lit(0.3), n_langs * 0.1))
    s = F.when(detected, F.greatest(s, F.lit(0.5))).otherwise(s)
    s = F.when(has_peers & ~detected, s * 0.55).otherwise(s)
    return F.round(F.when(peers_multilingual & (n_langs < 2), s * 0.65).otherwise(s), 4)


def scores(candidates: DataFrame, signals: DataFrame, condition: str = "unknown") -> DataFrame:
    """Per session and engine: agreement, timing, switch_structure, code_switch_score, score: means over its peers, 1 without any; and peers, what it has in common with each.

    signals: session_id, engine, conf, word_conf, ts_conf (0 to 1), switch_count, switching_score, langs, patterns.
    """
    word = _compared(texts(candidates), seq=S.sequence_similarities, bag=S.bag_overlaps)
    word = word.withColumn("token", F.round(F.col("seq") * 0.65 + F.col("bag") * 0.35, 4))
    switch = pairs(signals).select("session_id", "engine", "peer", F.round(switch_agreement("a", "b"), 4).alias("switch"), (F.size("b.langs") >= 2).alias("multi"))
    both = word.select("session_id", "engine", "peer", "token").join(timing(candidates), ["session_id", "engine", "peer"], "left").join(switch, ["session_id", "engine", "peer"])
    peer = F.struct("token", F.round(F.coalesce("timing", F.lit(0.0)), 4).alias("timing"), F.coalesce("count_score", F.lit(0.0)).alias("count_score"), "switch")
    mean = both.groupBy("session_id", "engine").agg(F.map_from_entries(F.collect_list(F.struct("peer", peer.alias("x")))).alias("peers"), F.avg("token").alias("agreement"), F.avg(F.round(F.coalesce("timing", F.lit(0.0)), 4)).alias("timing"), F.avg("switch").alias("switch_structure"), F.bool_or("multi").alias("multi"))
    s = signals.join(mean, ["session_id", "engine"], "left")
    one = lambda c: F.coalesce(c, F.lit(1.0))
    kept = preservation(F.col("switch_count") > 0, F.col("switching_score"), F.size("langs"), F.col("agreement").isNotNull(), F.coalesce("multi", F.lit(False)))
    s = s.withColumn("code_switch_score", kept)
    total = F.col("conf") * 0.24 + F.col("word_conf") * 0.14 + F.col("ts_conf") * 0.16 + one("agreement") * 0.20 + one("timing") * 0.10 + one("switch_structure") * 0.08 + F.col("code_switch_score") * 0.08
    total = total * {"outdoor": 1.03, "unknown": 1.01}.get(condition, 1.0)
    return s.select("session_id", "engine", "conf", "ts_conf", one("agreement").alias("agreement"), one("timing").alias("timing"), one("switch_structure").alias("switch_structure"), "code_switch_score", F.round(F.least(F.lit(1.0), total), 4).alias("score"), "peers")


def choose(candidates: DataFrame, signals: DataFrame, condition: str = "unknown") -> DataFrame:
    """Per session: the winner, the runner-up, strategy, score, disagreement flags, review_recommended.

    Two candidates that agree in words, times, switches and number of segments, with close confidence but different
    timing, are merged: words of the more confident, times of the better timed.
    """
    s = scores(candidates, signals, condition)
    # The winner's row takes in the next one, so scores are computed once.
    w = W.partitionBy("session_id").orderBy(F.desc("score"), "engine")
    ranked = s.select("session_id", F.row_number().over(w).alias("rank"), F.struct("*").alias("t"), F.lead(F.struct("engine", "conf", "ts_conf", "score")).over(w).alias("r"))
    both = ranked.where("rank = 1")
    no = F.array().cast("array<string>")
    both = both.withColumn("x", F.element_at("t.peers", F.col("r.engine"))).withColumns({"token": F.col("x.token"), "tm": F.col("x.timing"), "sw": F.col("x.switch"), "count_score": F.col("x.count_score")})
    alone = F.col("r").isNull()
    flags = F.when(alone, no).otherwise(F.array_compact(F.array(F.when(F.col("token") < 0.72, "strong_transcript_disagreement"), F.when(F.col("tm") < 0.70, "strong_timestamp_disagreement"), F.when(F.col("sw") < 0.70, "strong_code_switch_disagreement"))))
    merge = ~alone & (F.col("token") >= 0.88) & (F.col("tm") >= 0.82) & (F.col("sw") >= 0.80) & (F.coalesce("count_score", F.lit(0.0)) >= 0.80) & (F.abs(F.col("t.conf") - F.col("r.conf")) <= 0.08) & (F.abs(F.col("t.ts_conf") - F.col("r.ts_conf")) >= 0.10)
    both = both.withColumn("flags", flags).withColumn("merge", F.coalesce(merge, F.lit(False)))
    score = F.when(alone, F.round("t.conf", 4)).when(F.col("merge"), F.greatest("t.score", "r.score")).otherwise(F.col("t.score"))
    return both.select(
        "session_id",
        F.col("t.engine").alias("top_engine"),
        F.col("r.engine").alias("runner_up"),
        F.when(F.col("merge"), "merged_consensus").otherwise(F.col("t.engine")).alias("selected_engine"),
        F.when(F.col("merge"), "merged_consensus").otherwise("best_single_engine").alias("strategy"),
        score.alias("consensus_score"),
        F.col("flags").alias("disagreement_flags"),
        F.when(alone, F.col("t.conf") < 0.65).otherwise((score < 0.78) | (F.size("flags") > 0)).alias("review_recommended"),
        F.when(F.col("t.conf") >= F.coalesce("r.conf", F.lit(-1.0)), F.col("t.engine")).otherwise(F.col("r.engine")).alias("text_engine"),
        F.when(F.col("t.ts_conf") >= F.coalesce("r.ts_conf", F.lit(-1.0)), F.col("t.engine")).otherwise(F.col("r.engine")).alias("timing_engine"),
    )


def final_segments(candidates: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen transcript's segments; of a merged one, words of text_engine and times of timing_engine at each place, tails kept."""
    c = chosen.select(F.col("session_id").alias("_s"), "strategy", "top_engine", "text_engine", "timing_engine")
    w = W.partitionBy("session_id", "engine").orderBy("idx")
    s = candidates.withColumn("place", F.row_number().over(w)).join(c, F.col("session_id") == F.col("_s"))
    merged = F.col("strategy") == "merged_consensus"
    is_text = F.col("engine") == F.when(merged, F.col("text_engine")).otherwise(F.col("top_engine"))
    is_time = F.col("engine") == F.when(merged, F.col("timing_engine")).otherwise(F.col("top_engine"))
    pick = lambda c, first, then: F.coalesce(F.max(F.when(first, F.col(c))), F.max(F.when(then, F.col(c)))).alias(c)
    out = s.where(is_text | is_time).withColumn("text", F.nullif(F.col("text"), F.lit("")))
    return out.groupBy("session_id", "place").agg(pick("s_ms", is_time, is_text), pick("e_ms", is_time, is_text), pick("text", is_text, is_time))


def even_words(segments: DataFrame) -> DataFrame:
    """Words of segments without word times: each gets an even share of its segment."""
    s = segments.where((F.col("e_ms") > F.col("s_ms")) & (F.length(F.trim("text")) > 0)).withColumn("w", T.split_words(T.collapse(F.col("text"))))
    each = s.select("session_id", "idx", "s_ms", "e_ms", F.size("w").alias("n"), F.posexplode("w").alias("word_idx", "word"))
    at = lambda k: F.col("s_ms") + k * (F.col("e_ms") - F.col("s_ms")) / F.col("n")
    return each.select("session_id", F.col("idx").alias("seg_idx"), "word_idx", "word", at(F.col("word_idx")).alias("ws_ms"), at(F.col("word_idx") + 1).alias("we_ms"))


def refine(chosen: DataFrame, vendor: bool = True) -> DataFrame:
    """chosen (timing_source, ts_conf, has_words, can_split) with timestamp_method, timestamp_confidence, synthetic, timing_quality."""
    trusted = F.lit(vendor) & (F.col("timing_source") == "vendor_word_timestamps") & (F.coalesce("ts_conf", F.lit(0.0)) >= 0.75) & F.col("has_words")
    synthetic = ~trusted & ~F.col("has_words") & F.col("can_split")
    conf = F.when(trusted, F.col("ts_conf")).when(synthetic, F.least(F.lit(0.35), F.coalesce("ts_conf", F.lit(0.35)))).otherwise(F.least(F.lit(0.55), F.greatest(F.lit(0.4), F.coalesce("ts_conf", F.lit(0.45)))))
    return chosen.withColumns(
        {
            "timestamp_method": F.when(trusted, "vendor_word_timestamps").otherwise("local_alignment_fallback"),
            "timestamp_confidence": conf,
            "synthetic": synthetic,
            "timing_quality": F.when(trusted, "high").when(synthetic, "low").otherwise("medium"),
        }
    )
