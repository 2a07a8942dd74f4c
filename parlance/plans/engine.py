"""Whole runs: from turns, segments and words to records; from records and reviews to deliveries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates, interaction, language, monologue, overlap, quality, review, speakers
from . import record


@dataclass(frozen=True)
class Config:
    """Settings of a run; unknown names are dropped by of(), strings become numbers and booleans."""

    pipeline_mode: str = "offline_standard"
    allow_paid_apis: bool = False
    premium_engines: tuple[str, ...] = ()
    output_mode: str = "both"
    dataset_products: tuple[str, ...] = ("stt", "diarisation", "evaluation_gold")
    metadata_depth: str = "full"
    quality_score_threshold: float = 0.35
    review_threshold: float = 0.99
    word_accuracy_target: float = 0.99
    speaker_accuracy_target: float = 0.99
    timestamp_accuracy_target: float = 0.98
    code_switch_accuracy_target: float = 0.99
    turn_merge_gap_ms: int = 150
    min_turn_ms: int = 80
    target_sample_rate: int = 16_000
    require_human_review: bool = False
    fail_fast: bool = False
    seed: int = 42
    extra: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def of(cls, values: dict[str, Any]) -> Config:
        kinds = {f.name: f.default for f in fields(cls) if f.name != "extra"}
        out = {}
        for k, v in values.items():
            k = k.replace("-", "_")
            if k in kinds:
                d = kinds[k]
                if isinstance(d, bool):
                    v = v if isinstance(v, bool) else str(v).strip().lower() in ("1", "true", "yes", "on")
                elif isinstance(d, int | float):
                    v = type(d)(v)
                elif isinstance(d, tuple):
                    v = tuple(x.strip() for x in v.split(",") if x.strip()) if isinstance(v, str) else tuple(v)
                out[k] = v
        return cls(**out)

    def targets(self) -> dict[str, float]:
        return {k: getattr(self, f"{k}_accuracy_target") for k in ("word", "speaker", "timestamp", "code_switch")}

    def hash(self) -> str:
        return record.config_hash(asdict(self))


#: What annotate() finds of a segment beyond what stands in its transcript, and of a word.
ANNOTATED = ("snr_reason", "snr_source", "snr_quality", "overlap", "overlap_type", "overlap_start", "overlap_end", "wpm_z", "confidence_band_relative", "confidence_reasons", "tier_reasons", "mid_switch", "matrix_language", "cs_density")
WORD = ("seg_idx", "word_idx", "speaker", "ws_ms", "we_ms", "text", "trailing_punct", "lang")

#: Columns of a speaker's profile that stay at metadata_depth="basic".
BASIC_SPEAKER = ("session_id", "speaker", "speaking_ms", "word_count", "wpm", "n_turns")


def annotate(turns: DataFrame, segments: DataFrame, words: DataFrame, shared: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(segments, words) through the stages in their fixed order: punctuation, word languages, SNR, overlaps, confidence, tiers."""
    told = language.punctuated(words.select("session_id", "seg_idx", "word_idx", "speaker", "ws_ms", "we_ms", "word"), segments)
    spoken = told.withColumn("lang", language.word_language(F.col("text"), F.col("segment_language"))["lang"]).drop("segment_language").withColumn("word", F.concat("text", "trailing_punct"))
    spoken = shared(spoken.select("session_id", *WORD, "word", "punct_skipped"))
    switches = language.switch_points(spoken)
    per = spoken.groupBy("session_id", F.col("seg_idx").alias("idx")).agg(F.count(F.lit(1)).alias("_n"), F.first("punct_skipped").alias("punct_skipped"))
    mid = switches.where(F.col("switch_type").isin("intra_sentential", "intra_word")).join(per.select("session_id", F.col("idx").alias("seg_idx"), "_n"), ["session_id", "seg_idx"]).where("word_idx > 0 and word_idx < _n - 1")
    mid = mid.select("session_id", F.col("seg_idx").alias("idx"), F.lit(True).alias("mid_switch")).distinct()
    matrix = language.matrix_language(spoken).select("session_id", F.col("seg_idx").alias("idx"), "matrix_language", "cs_density")
    s = quality.annotate_snr(segments)
    s = overlap.annotate(s, overlap.regions(turns, segments))
    s = s.join(per, ["session_id", "idx"], "left").join(mid, ["session_id", "idx"], "left").join(matrix, ["session_id", "idx"], "left")
    s = s.withColumns({"has_words": F.col("_n").isNotNull(), "mid_switch": F.coalesce("mid_switch", F.lit(False)), "entropy": F.lit(0.0)}).drop("_n")
    return quality.tier(quality.confidence(s)), spoken


def run(turns: DataFrame, segments: DataFrame, words: DataFrame, config: Config = Config(), shared: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Records of all sessions: transcript, annotations of its segments, words, interaction, language, quality, speakers, monologue, validation, gate, delivery.

    shared keeps what many reports read (llm.common.materialise, say), so that none makes it anew and the last plan stays small.
    """
    segs, spoken = annotate(turns, segments, words, shared)
    segs = shared(segs)
    profiles = speakers.profile(spoken, turns)
    if config.metadata_depth == "basic":
        profiles = profiles.select(*BASIC_SPEAKER)
    people = profiles.groupBy("session_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", F.struct(*[c for c in profiles.columns if c not in ("session_id", "speaker")]).alias("v"))))).alias("profiles"))
    people = shared(people)
    talk = shared(interaction.report(turns))
    langs = language.report(segs)
    # summed in order of size, so that reruns print the same mean
    scores = segs.where(F.length(F.trim("text")) > 0).groupBy("session_id").agg(F.array_sort(F.collect_list("quality_score")).alias("_q"))
    mean = F.aggregate("_q", F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("_q"), F.lit(0))
    quality_report = shared(quality.transcript_quality(segs, config.quality_score_threshold).join(scores, "session_id", "left").withColumn("mean_quality", F.coalesce(mean, F.lit(0.0))).drop("_q"))
    mono = shared(monologue.best(monologue.spans(spoken, turns), keep_words=False))
    density = shared(language.code_switch_density(spoken))
    checks = quality_report.join(talk.select("session_id", "total_turns", "duration_ms", "overlap_ms"), "session_id", "left").select(
        "session_id",
        "segment_count",
        "low_ratio",
        F.lit(0).alias("audio_errors"),
        F.lit(0).alias("audio_warnings"),
        F.coalesce("total_turns", F.lit(0)).alias("speech_count"),
        F.coalesce("total_turns", F.lit(0)).alias("turn_count"),
        F.lit(0.0).alias("clipping_ratio"),
        *(F.lit(None).cast("string").alias(c) for c in ("requested_backend", "effective_backend")),
        *(F.lit(None).cast("boolean").alias(c) for c in ("align_applied", "align_passed")),
        *(F.lit(None).cast("double").alias(c) for c in ("align_confidence", "mismatch_s", "mismatch_limit_s", "peak_before")),
        F.lit(0.0).alias("expected_overlap_s"),
        (F.coalesce("overlap_ms", F.lit(0)) / 1000.0).alias("observed_overlap_s"),
        (F.coalesce("duration_ms", F.lit(0)) / 1000.0).alias("duration_s"),
    )
    valid = gates.validation(checks, config.quality_score_threshold).select("session_id", "issues", "issue_count", "passed")
    annotations = segs.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("idx", *ANNOTATED))).alias("segments"))
    said = spoken.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct(*WORD))).alias("list"))
    out = record.assemble(segs, annotations=annotations, words=said, interaction=talk, language=langs, quality=quality_report, tiers=quality.tier_histogram(segs), speakers=people, monologue=mono, validation=valid, code_switch=language.code_switch_report(segs), code_switch_density=density)
    needs = F.lit(config.require_human_review or config.pipeline_mode == "premium_accuracy")
    out = out.withColumn("review_required", needs).withColumn("config_hash", F.lit(config.hash())).withColumn("dataset_products", record.products(F.array(*map(F.lit, config.dataset_products)), F.lit(config.output_mode)))
    return record.delivery(out)


def finalise(reviewed: DataFrame, original: DataFrame, sessions: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per session: metrics, verify_reasons, stage.

    reviewed and original are rows of segments; sessions: session_id, status, reviewer_id, given_reviewer, validation_passed, approve,
    second_pass (struct required, completed, reviewer_id, sample_rate, agreement_score).
    """
    rows = review.row_errors(reviewed)
    errors = rows.groupBy("session_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("idx", "errors"))), lambda x: x["errors"])).alias("row_errors"))
    p = F.col("second_pass")
    head = gates.rules((F.coalesce("status", F.lit("")) != "completed", "review_status_not_completed"), (F.trim(F.coalesce("reviewer_id", F.lit(""))) == "", "reviewer_id_missing"))
    tail = gates.rules(((F.trim(F.coalesce("reviewer_id", F.lit(""))) != "") & (F.trim("reviewer_id") != F.trim("given_reviewer")), "reviewer_id_mismatch"))
    second = review.second_pass_errors(p["required"], p["completed"], p["reviewer_id"], p["sample_rate"], p["agreement_score"])
    s = sessions.join(errors, "session_id", "left").withColumn("review_errors", F.concat(head, F.coalesce("row_errors", F.array().cast("array<string>")), tail, F.coalesce(second, F.array().cast("array<string>")))).drop("row_errors")
    s = s.withColumn("completed", (F.col("status") == "completed") & (F.size("review_errors") == 0))
    parts = [review.delivery(rows).drop("delivery_confidence"), review.attribution_accuracy(rows, original), review.code_switch_stats(rows), review.error_rates(rows)]
    out = s
    for x in parts:
        out = out.join(x, "session_id", "left")
    clean = F.col("completed") & (F.col("n_empty") == 0) & (F.col("n_unresolved") == 0)
    out = out.withColumn("delivery_confidence", F.when(clean, review.CONFIDENCE_COMPLETE).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.98), F.coalesce("completion_rate", F.lit(0.0)) - F.coalesce("n_unresolved", F.lit(0)) * review.ISSUE_PENALTY))))
    none = {"speaker_accuracy": 0.0, "timestamp_accuracy": 0.0, "code_switch_accuracy": 0.99}
    out = out.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in none.items()})
    return review.finalise(review.verify(out, config.targets()), F.col("approve"))
