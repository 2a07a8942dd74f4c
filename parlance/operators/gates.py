"""Accuracy gates, review priority, TTS suitability, dataset purpose and validation, as ordered rules over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accuracies to reach.
TARGETS = {"word": 0.99, "speaker": 0.99, "timestamp": 0.98, "code_switch": 0.99}


def rules(*pairs: tuple[Column, str]) -> Column:
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in pairs)))


def accuracy_gate(df: DataFrame, targets: dict[str, float] = TARGETS, review_threshold: float = 0.99) -> DataFrame:
    """df with estimated_word/speaker/timestamp/code_switch, gate_reasons, gate_passed.

    Needs consensus_score and timestamp_confidence (null: none), code_switch_detected, code_switch_confidence, speaker_confidence.
    """
    score = F.coalesce("consensus_score", F.lit(0.0))
    conf = F.nullif(F.coalesce("code_switch_confidence", F.lit(0.0)), F.lit(0.0))
    d = df.withColumns(
        {
            "estimated_word": F.least(score, F.lit(review_threshold)),
            "estimated_speaker": F.coalesce("speaker_confidence", F.lit(1.0)),
            "estimated_timestamp": F.coalesce("timestamp_confidence", F.lit(0.0)),
            "estimated_code_switch": F.when(F.col("code_switch_detected"), F.coalesce(conf, F.least(score, F.lit(0.75)))).otherwise(F.least(F.lit(1.0), F.greatest(score, F.lit(0.99)))),
        }
    )
    reasons = rules(
        (F.col("estimated_word") < targets["word"], "estimated_word_accuracy_below_target"),
        (F.col("estimated_speaker") < targets["speaker"], "estimated_speaker_accuracy_below_target"),
        (F.col("estimated_timestamp") < targets["timestamp"], "estimated_timestamp_accuracy_below_target"),
        (F.col("code_switch_detected") & (F.col("estimated_code_switch") < targets["code_switch"]), "estimated_code_switch_accuracy_below_target"),
        (F.col("consensus_score") < 0.95, "consensus_score_below_review_threshold"),
    )
    return d.withColumn("gate_reasons", reasons).withColumn("gate_passed", F.size("gate_reasons") == 0)


def review_priority(df: DataFrame, mode: str = "premium_accuracy", require: bool = False, targets: dict[str, float] = TARGETS) -> DataFrame:
    """df with priority_score, priority_level, priority_reasons, review_required.

    Needs accuracy_gate()'s columns and recording_condition, synthetic, timing_quality, n_engines, disagreement_flags.
    """
    has = F.col("consensus_score").isNotNull()
    timed = F.col("timestamp_confidence").isNotNull()
    flag = lambda x: F.array_contains("disagreement_flags", x)
    word_low = F.col("estimated_word") < targets["word"]
    table = (
        (F.col("recording_condition") == "outdoor", "outdoor_audio", F.lit(0.20)),
        (has & (F.col("consensus_score") < 0.95), "low_consensus_score", F.when(F.col("consensus_score") < 0.90, 0.80).otherwise(0.45)),
        (timed & (F.col("timestamp_confidence") < targets["timestamp"]), "low_timestamp_confidence", F.lit(0.20)),
        (timed & F.col("synthetic"), "synthetic_word_timestamps", F.lit(0.25)),
        (timed & (F.col("timing_quality") == "low"), "low_timing_quality", F.lit(0.15)),
        (F.col("n_engines") > 1, "multi_engine_disagreement", F.lit(0.15)),
        (F.col("code_switch_detected"), "code_switch_detected", F.lit(0.30)),
        (F.col("code_switch_detected") & (F.coalesce("code_switch_confidence", F.lit(0.0)) < targets["code_switch"]), "low_code_switch_confidence", F.lit(0.20)),
        (F.col("speaker_confidence") < targets["speaker"], "low_speaker_attribution_confidence", F.lit(0.20)),
        (word_low, "estimated_word_accuracy_below_target", F.when(F.col("estimated_word") < 0.97, 0.80).otherwise(0.35)),
    )
    late = (
        (flag("strong_code_switch_disagreement"), "code_switch_region_disagreement", F.lit(0.18)),
        (flag("strong_timestamp_disagreement"), "timestamp_region_disagreement", F.lit(0.16)),
        (flag("strong_transcript_disagreement"), "transcript_disagreement", F.lit(0.12)),
    )
    total = sum((F.when(F.coalesce(c, F.lit(False)), x).otherwise(0.0) for c, _, x in (*table, *late)), F.lit(0.0))
    gate = F.when(~F.col("gate_passed"), F.col("gate_reasons")).otherwise(F.array().cast("array<string>"))
    reasons = F.array_distinct(F.concat(rules(*((c, n) for c, n, _ in table)), gate, rules(*((c, n) for c, n, _ in late))))
    out = df.withColumn("priority_score", F.round(F.least(total, F.lit(1.0)), 4)).withColumn("priority_reasons", reasons)
    level = F.when(F.col("priority_score") >= 0.75, "high").when(F.col("priority_score") >= 0.45, "medium").otherwise("normal")
    return out.withColumn("priority_level", level).withColumn("review_required", F.lit(require or mode == "premium_accuracy") | ~F.col("gate_passed"))


def tts_suitability(df: DataFrame) -> DataFrame:
    """df with tts_reasons, tts_eligible, tts_confidence. Needs speaker_count, overlap_s, noise_level, recording_condition, review_status, timing_quality (null: not aligned), synthetic."""
    reasons = rules(
        (F.col("speaker_count") != 1, "multi_speaker_segment"),
        (F.col("overlap_s") > 0, "overlap_detected"),
        (F.coalesce("noise_level", F.lit("")) != "low", "noise_not_low"),
        (F.col("recording_condition") == "outdoor", "outdoor_condition"),
        (~F.coalesce("review_status", F.lit("")).isin("approved", "corrected"), "review_not_final"),
        (F.col("timing_quality").isNull(), "timing_not_verified"),
        (F.col("timing_quality").isNotNull() & F.col("synthetic"), "synthetic_timestamps"),
        (F.col("timing_quality").isNotNull() & (F.col("timing_quality") != "high"), "timing_not_stable"),
    )
    out = df.withColumn("tts_reasons", reasons).withColumn("tts_eligible", F.size("tts_reasons") == 0)
    return out.withColumn("tts_confidence", F.when(F.col("tts_eligible"), 0.92).otherwise(0.2))


def purpose(df: DataFrame) -> DataFrame:
    """df with purpose_primary, purpose_secondary, not_recommended_for. Needs has_text, has_segments, has_turns, speaker_count, overlap_s, input_mode, tts_ready, validation_passed, snr_db."""
    text, seg, turn = F.col("has_text"), F.col("has_segments"), F.col("has_turns")
    pair = F.col("input_mode").isin("speaker_pair", "stereo")
    tts = F.col("tts_ready") & F.col("validation_passed") & (F.coalesce("snr_db", F.lit(0.0)) >= 20.0) & (F.col("overlap_s") <= 0.1) & turn & seg
    return df.withColumns(
        {
            "purpose_primary": rules((text, "stt"), (turn, "diarisation"), (text & turn & ((F.col("speaker_count") >= 2) | (F.col("overlap_s") > 0) | pair), "conversation_modelling")),
            "purpose_secondary": rules((text & seg, "evaluation"), ((F.col("speaker_count") >= 2) & pair, "speaker_separation"), (tts, "tts")),
            "not_recommended_for": rules((~F.coalesce(tts, F.lit(False)), "tts")),
        }
    )


ISSUE = "struct<severity:string,code:string,confidence:double>"


def validation(df: DataFrame, threshold: float = 0.35, alignment_required: bool = False) -> DataFrame:
    """df with issues (structs severity, code, confidence, in order), issue_count, passed.

    Needs audio_errors and audio_warnings (numbers), segment_count, low_ratio, speech_count, turn_count, clipping_ratio, requested_backend,
    effective_backend, align_applied, align_passed, align_confidence (null: no alignment), mismatch_s, mismatch_limit_s, peak_before,
    expected_overlap_s, observed_overlap_s, duration_s.
    """
    c = F.col
    issue = lambda cond, severity, code, conf=None: F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), (F.lit(1.0) if conf is None else conf).cast("double").alias("confidence")))
    many = lambda n, severity, code: F.transform(F.when(c(n) > 0, F.sequence(F.lit(1), c(n).cast("int"))).otherwise(F.array().cast("array<int>")), lambda _: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(1.0).alias("confidence")))
    aligned = c("align_confidence").isNotNull()
    rest = F.array_compact(
        F.array(
            issue(c("segment_count") == 0, "error", "empty_transcript"),
            issue((c("segment_count") > 0) & (c("low_ratio") > threshold), "warning", "low_transcript_quality", F.lit(0.8)),
            issue(c("speech_count") == 0, "warning", "no_speech_segments"),
            issue(c("turn_count") == 0, "warning", "no_speaker_turns"),
            issue((c("turn_count") > 0) & (c("speech_count") < 2), "warning", "too_few_speech_segments", F.lit(0.7)),
            issue(c("clipping_ratio") >= 0.01, "warning", "excessive_clipping"),
            issue(c("requested_backend") != c("effective_backend"), "warning", "diarisation_fallback"),
            issue(aligned & F.lit(alignment_required) & ~c("align_applied"), "warning", "alignment_not_applied", c("align_confidence")),
            issue(aligned & ~c("align_passed"), "warning", "low_alignment_confidence", c("align_confidence")),
            issue(aligned & (c("mismatch_s") > F.coalesce("mismatch_limit_s", F.lit(60.0))), "warning", "speaker_duration_mismatch"),
            issue(c("peak_before") > 0.98, "warning", "mono_mix_clipping"),
            issue((c("expected_overlap_s") > 0.25) & (c("observed_overlap_s") < 0.05), "warning", "missing_expected_overlap"),
            issue((c("duration_s") >= 60.0) & (c("turn_count") < 3), "warning", "suspiciously_low_turn_count"),
        )
    )
    out = df.withColumn("issues", F.concat(many("audio_errors", "error", "audio_quality_error"), many("audio_warnings", "warning", "audio_quality_warning"), rest))
    return out.withColumn("issue_count", F.size("issues")).withColumn("passed", ~F.exists("issues", lambda x: x["severity"] == "error"))
