"""Segment quality: recogniser score, SNR bands, composite confidence, tiers, review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicons as lex


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def asr_quality(logprob: Column, compression: Column, no_speech: Column, rms_db: Column) -> Column:
    """exp of the log probability, times how plausible the compression, the speech and the loudness are."""
    dense = F.when(compression <= 2.4, 1.0).otherwise(clip((3.4 - compression) / 1.0))
    return F.exp(F.greatest(logprob, F.lit(-6.0))) * dense * F.greatest(F.lit(0.0), 1.0 - no_speech) * clip((rms_db + 45.0) / 25.0)


def snr_band(snr_db: Column, clipping: Column) -> Column:
    return F.when((clipping > 0.005) | snr_db.isNull(), "low").when(snr_db >= 20, "high").when(snr_db >= 10, "medium").otherwise("low")


def annotate_snr(segments: DataFrame, short_ms: int = 500) -> DataFrame:
    """segments with snr_band, snr_reason, snr_source; segments under short_ms inherit from the last one that had an SNR.

    Needs snr_db and clipping_ratio of each segment, in order of idx.
    """
    w = W.partitionBy("session_id").orderBy("idx").rowsBetween(W.unboundedPreceding, -1)
    short = (F.col("e_ms") - F.col("s_ms")) < short_ms
    band = snr_band(F.col("snr_db"), F.col("clipping_ratio"))
    clipped = F.col("clipping_ratio") > 0.005
    own = F.struct("snr_db", band.alias("band"), "clipping_ratio", F.when(clipped, "clipped").alias("quality"))
    last = F.last(F.when(~short & F.col("snr_db").isNotNull(), own), ignorenulls=True).over(w)
    nothing = F.struct(F.lit(None).cast("double").alias("snr_db"), F.lit("low").alias("band"), F.lit(0.0).alias("clipping_ratio"), F.lit(None).cast("string").alias("quality"))
    s = segments.withColumn("_l", last)
    pick = F.when(~short, own).otherwise(F.coalesce("_l", nothing))
    reason = (
        F.when(short & F.col("_l").isNotNull(), "short_segment_inherited")
        .when(short, "short_segment")
        .when(clipped, "clipped")
        .when(F.col("snr_db").isNull(), "unreliable_estimate")
    )
    s = s.withColumn("_p", pick).withColumn("snr_reason", reason).withColumn("snr_source", F.when(short, "inherited").otherwise("wada_snr"))
    return s.withColumns({"snr_db": F.col("_p.snr_db"), "snr_band": F.col("_p.band"), "clipping_ratio": F.col("_p.clipping_ratio"), "snr_quality": F.col("_p.quality")}).drop("_l", "_p")


def wpm_z(wpm: Column, language: Column) -> Column:
    """Deviation of a speech rate from its language's, in standard deviations."""
    table = F.create_map(*(x for k, (m, d) in lex.WPM.items() for x in (F.lit(k), F.struct(F.lit(m).alias("m"), F.lit(d).alias("d")))))
    base = F.split(F.lower(F.coalesce(language, F.lit("default"))), "-")[0]
    p = F.coalesce(table[F.when(base.isin(*lex.WPM), base).otherwise("default")], table["default"])
    return (wpm - p["m"]) / p["d"]


def band(score: Column) -> Column:
    return F.when(score >= 0.80, "gold").when(score >= 0.55, "silver").otherwise("bronze")


def confidence(segments: DataFrame, round_to: int = 4) -> DataFrame:
    """segments with wpm_z, confidence, confidence_band, confidence_band_relative, confidence_reasons.

    Needs avg_logprob, quality_score, snr_band, clipping_ratio, n_words, has_words, overlap, language, mid_switch
    and entropy. The relative band is the segment's place among its session's segments.
    """
    raw = F.when(F.col("avg_logprob") < 0, F.exp(F.greatest(F.col("avg_logprob"), F.lit(-6.0)))).otherwise(F.coalesce("quality_score", F.lit(0.0)))
    unsure = (F.col("entropy") > 0.6) | F.col("mid_switch")
    ms = F.greatest(F.col("e_ms") - F.col("s_ms"), F.lit(1))
    s = segments.withColumn("_asr", clip(F.when(unsure, raw * 0.75).otherwise(raw))).withColumn("wpm_z", wpm_z(F.col("n_words") * 60000.0 / ms, F.col("language")))
    odd = F.abs("wpm_z") > 2.5
    snr = F.when(F.col("snr_band") == "high", 1.0).when(F.col("snr_band") == "medium", 0.72).otherwise(0.38)
    fused = clip(0.45 * F.col("_asr") + 0.25 * snr + 0.15 * F.when(odd, 0.72).otherwise(1.0) + 0.15 * F.when(F.col("has_words"), 1.0).otherwise(0.55))
    brief, clipped = ms < 300, F.col("clipping_ratio") > 0.005
    capped = F.least(fused, F.when(F.col("overlap") | brief, 0.74).otherwise(1.0), F.when(clipped, 0.54).otherwise(1.0))
    reasons = F.array_sort(
        F.array_compact(
            F.array(
                F.when(F.col("_asr") < 0.55, "low_asr_quality"),
                F.when(F.col("entropy") > 0.6, "high_lid_entropy"),
                F.when(F.col("mid_switch"), "mid_segment_script_change"),
                F.when(F.col("snr_band") == "low", "snr_low"),
                F.when(F.col("overlap"), "overlap_crosstalk"),
                F.when(~F.col("has_words"), "missing_word_timestamps"),
                F.when(odd, F.concat(F.lit("wpm_outlier_z"), F.format_string("%+.1f", "wpm_z"))),
                F.when(brief, "short_duration"),
                F.when(clipped, "clipping_detected"),
            )
        )
    )
    s = s.withColumn("confidence", F.round(capped, round_to)).withColumn("confidence_band", band(capped)).withColumn("confidence_reasons", reasons)
    place = F.cume_dist().over(W.partitionBy("session_id").orderBy("confidence"))
    return s.withColumn("confidence_band_relative", F.when(place >= 0.70, "gold").when(place >= 0.35, "silver").otherwise("bronze")).drop("_asr")


def tier(segments: DataFrame) -> DataFrame:
    """segments with quality_tier, tier_reasons, flagged_for_review, review_reasons."""
    low, clipped = F.col("snr_band") == "low", F.array_contains("confidence_reasons", "clipping_detected")
    start = F.coalesce("confidence_band", F.lit("bronze"))
    level = F.when(F.coalesce(low, F.lit(False)) | clipped, "bronze").when(F.col("overlap") & (start == "gold"), "silver").otherwise(start)
    extra = F.array_compact(F.array(F.when(F.col("overlap"), "overlap"), F.when(low, "snr_low")))
    s = segments.withColumn("quality_tier", level).withColumn("tier_reasons", F.array_sort(F.array_distinct(F.concat("confidence_reasons", extra))))
    flagged = (F.col("quality_tier") == "bronze") | F.arrays_overlap("tier_reasons", F.array(F.lit("overlap"), F.lit("snr_low"), F.lit("clipping_detected")))
    return s.withColumn("flagged_for_review", flagged).withColumn("review_reasons", F.when(flagged, F.col("tier_reasons")).otherwise(F.array().cast("array<string>")))


def tier_histogram(segments: DataFrame) -> DataFrame:
    """Per session: gold, silver, bronze."""
    return segments.groupBy("session_id").agg(*(F.count(F.when(F.col("quality_tier") == t, 1)).alias(t) for t in ("gold", "silver", "bronze")))


def review_queue(segments: DataFrame) -> DataFrame:
    return segments.where("flagged_for_review").select("session_id", "segment_id", "audio_filepath", "s_ms", "e_ms", "quality_tier", "confidence", "review_reasons")


def transcript_quality(segments: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Per session: segment_count, word_count, mean_quality, low_ratio (1 if nothing was said), of segments with text."""
    said = F.length(F.trim(F.coalesce("text", F.lit("")))) > 0
    out = segments.groupBy("session_id").agg(
        F.count(F.when(said, 1)).alias("segment_count"),
        F.coalesce(F.sum(F.when(said, F.col("n_words"))), F.lit(0)).alias("word_count"),
        F.coalesce(F.avg(F.when(said, F.col("quality_score"))), F.lit(0.0)).alias("mean_quality"),
        F.coalesce(F.avg(F.when(said, F.when(F.col("quality_score") < threshold, 1.0).otherwise(0.0))), F.lit(1.0)).alias("low_ratio"),
    )
    return out.withColumn("empty_transcript", F.col("segment_count") == 0)


def environment(snr_db: Column, rt60: Column) -> Column:
    """Struct value, confidence."""
    pair = lambda v, c: F.struct(F.lit(v).alias("value"), F.lit(c).alias("confidence"))
    return (
        F.when((snr_db >= 20) & (rt60 < 0.3), pair("studio", 0.85))
        .when((snr_db >= 15) & (rt60 < 0.4), pair("quiet_indoor", 0.80))
        .when((snr_db >= 12) & (rt60 < 0.5), pair("quiet_indoor", 0.65))
        .when(rt60 >= 0.7, pair("reverberant_indoor", 0.75))
        .when(rt60 >= 0.5, pair("reverberant_indoor", 0.60))
        .when(snr_db < 5, pair("noisy", 0.70))
        .when(snr_db < 8, pair("noisy", 0.55))
        .otherwise(pair("unknown", 0.30))
    )


def noise_level(snr_db: Column) -> Column:
    pair = lambda v, c: F.struct(F.lit(v).alias("value"), F.lit(c).alias("confidence"))
    return F.when(snr_db >= 20, pair("low", 0.80)).when(snr_db >= 12, pair("moderate", 0.70)).when(snr_db >= 5, pair("high", 0.65)).when(snr_db > 0, pair("very_high", 0.65)).otherwise(pair("unknown", 0.30))


def device(centroid_khz: Column, rate: Column) -> Column:
    pair = lambda v, c: F.struct(F.lit(v).alias("value"), F.lit(c).alias("confidence"))
    return (
        F.when(rate <= 8000, pair("telephony_narrowband", 0.90))
        .when(centroid_khz < 1.1, pair("telephony_or_lapel", 0.75))
        .when(centroid_khz < 1.5, pair("telephony_or_lapel", 0.55))
        .when(centroid_khz < 2.0, pair("phone_mic", 0.65))
        .when(centroid_khz < 2.5, pair("phone_mic", 0.55))
        .when(centroid_khz < 3.5, pair("laptop_or_headset", 0.60))
        .otherwise(pair("studio_mic", 0.65))
    )


def audio_band(bandwidth_hz: Column) -> Column:
    return F.when(bandwidth_hz <= 3800, "narrowband").otherwise("wideband")


def loudness(rms_db: Column) -> Column:
    """Struct lufs, confidence: a stand-in from the level, or the floor for silence."""
    return F.when(rms_db <= -119.0, F.struct(F.lit(-70.0).alias("lufs"), F.lit(0.3).alias("confidence"))).otherwise(F.struct((rms_db - 0.69).alias("lufs"), F.lit(0.45).alias("confidence")))


def session_audio_qc(channels: DataFrame) -> DataFrame:
    """Per session, of its channels (clipping_ratio, silence_ratio, duration_s, errors, warnings): means, mismatch of lengths, all messages, passed."""
    out = channels.groupBy("session_id").agg(
        F.avg("clipping_ratio").alias("clipping_ratio"),
        F.avg("silence_ratio").alias("silence_ratio"),
        (F.max("duration_s") - F.min("duration_s")).alias("duration_mismatch_s"),
        F.max("duration_s").alias("duration_s"),
        F.array_sort(F.flatten(F.collect_list("errors"))).alias("errors"),
        F.array_sort(F.flatten(F.collect_list("warnings"))).alias("warnings"),
    )
    return out.withColumn("passed", F.size("errors") == 0)
