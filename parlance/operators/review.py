"""Human review: row checks, accuracy against the recogniser, gates, delivery states, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .gates import TARGETS, rules

# Confidence after a clean review, and what an unresolved issue costs.
CONFIDENCE_COMPLETE, ISSUE_PENALTY = 0.995, 0.05
# Names that stand for the first and the second speaker.
ALIASES = {
    "SPEAKER_00": ("speaker_00", "speaker00", "speaker_0", "spk0", "spk_0", "speaker_1", "speaker1", "speaker_one", "spk1", "spk_1"),
    "SPEAKER_01": ("spk01", "spk_01", "speaker_2", "speaker2", "speaker_two", "spk2", "spk_2"),
}


def speaker_key(value: Column) -> Column:
    return F.translate(F.lower(F.trim(value)), "- ", "__")


def canonical_speaker(value: Column, speaker_map: Column | None = None) -> Column:
    """The internal name of a speaker: as it is, by the session's own map (name to label), by alias, else unchanged."""
    raw, key = F.trim(F.coalesce(value, F.lit(""))), speaker_key(F.coalesce(value, F.lit("")))
    named = F.lit(None).cast("string")
    if speaker_map is not None:
        hit = F.filter(F.map_entries(speaker_map), lambda e: (e["key"] == raw) | (speaker_key(e["value"]) == key))
        named = F.get(F.transform(hit, lambda e: e["key"]), F.lit(0))
    known = F.coalesce(*(F.when(key.isin(*names), F.lit(c)) for c, names in ALIASES.items()))
    return F.when(F.upper(raw).isin("SPEAKER_00", "SPEAKER_01"), F.upper(raw)).otherwise(F.coalesce(named, known, raw))


def ambiguous_speaker(value: Column, speaker_map: Column | None = None) -> Column:
    """speaker_01 may be the first or the second speaker, unless the session's map has it for a label."""
    raw, key = F.trim(F.coalesce(value, F.lit(""))), speaker_key(F.coalesce(value, F.lit("")))
    labelled = F.lit(False) if speaker_map is None else F.coalesce(F.exists(F.map_values(speaker_map), lambda v: speaker_key(v) == key), F.lit(False))
    return ~raw.isin("SPEAKER_00", "SPEAKER_01") & key.isin("speaker_01", "speaker01") & ~labelled


def row_errors(rows: DataFrame, known: tuple[str, ...] = ("SPEAKER_00", "SPEAKER_01")) -> DataFrame:
    """rows with speaker made canonical and errors. Needs session_id, idx, segment_id, speaker, s_ms, e_ms, reviewed_text; speaker_map where there is one."""
    smap = F.col("speaker_map") if "speaker_map" in rows.columns else None
    w = W.partitionBy("session_id").orderBy("idx")
    same = F.row_number().over(W.partitionBy("session_id", "segment_id").orderBy("idx"))
    d = rows.withColumn("_raw", F.trim(F.coalesce("speaker", F.lit("")))).withColumn("_amb", ambiguous_speaker(F.col("speaker"), smap)).withColumn("speaker", canonical_speaker(F.col("speaker"), smap))
    d = d.withColumn("_again", same > 1).withColumn("_before", F.lag("s_ms").over(w))
    sid = F.trim(F.coalesce("segment_id", F.lit("")))
    at = F.when(sid == "", (F.col("idx") + 1).cast("string")).otherwise(sid)
    err = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), name)
    place = F.concat(F.lit("segment_"), (F.col("idx") + 1).cast("string"))
    errors = F.array_compact(
        F.array(
            err(F.col("s_ms").isNull() | F.col("e_ms").isNull(), F.concat(place, F.lit("_invalid_timestamps"))),
            err(sid == "", F.concat(place, F.lit("_missing_segment_id"))),
            err((sid != "") & F.col("_again"), F.concat(place, F.lit("_duplicate_segment_id"))),
            err(F.col("_amb"), F.concat(F.lit("ambiguous_speaker_alias:"), F.col("_raw"))),
            err(F.col("speaker") == "", F.concat(at, F.lit("_missing_speaker"))),
            err((F.col("speaker") != "") & ~F.col("speaker").isin(*known), F.concat(at, F.lit("_unknown_speaker"))),
            err(F.col("s_ms") < 0, F.concat(at, F.lit("_start_negative"))),
            err(F.coalesce("e_ms", F.lit(0)) <= F.coalesce("s_ms", F.lit(0)), F.concat(at, F.lit("_end_not_after_start"))),
            err(F.col("s_ms") < F.col("_before"), F.concat(at, F.lit("_segments_not_sorted"))),
            err(F.trim(F.coalesce("reviewed_text", F.lit(""))) == "", F.concat(at, F.lit("_empty_reviewed_text"))),
        )
    )
    return d.withColumn("errors", errors).drop("_raw", "_amb", "_again", "_before")


def second_pass_errors(required: Column, completed: Column, reviewer: Column, rate: Column, agreement: Column) -> Column:
    done = required & completed
    return rules(
        (required & ~F.coalesce(completed, F.lit(False)), "second_pass_review_required_not_completed"),
        (done & (F.trim(F.coalesce(reviewer, F.lit(""))) == ""), "second_pass_reviewer_id_missing"),
        (done & (F.coalesce(rate, F.lit(0.0)) <= 0), "second_pass_sample_rate_missing"),
        (done & agreement.isNotNull() & ~agreement.between(0.0, 1.0), "second_pass_agreement_score_invalid"),
    )


def matched(reviewed: DataFrame, original: DataFrame) -> DataFrame:
    """Reviewed rows beside the original row of their identifier, or else of their place: columns r and o."""
    o = original.select(F.col("session_id").alias("_s"), F.col("segment_id").alias("_id"), F.struct("*").alias("o1"))
    p = original.select(F.col("session_id").alias("_s2"), F.col("idx").alias("_i"), F.struct("*").alias("o2"))
    r = reviewed.select("session_id", F.struct("*").alias("r"))
    by_id = r.join(o, (F.col("session_id") == F.col("_s")) & (F.col("r.segment_id") == F.col("_id")) & (F.trim("_id") != ""), "left")
    both = by_id.join(p, (F.col("session_id") == F.col("_s2")) & (F.col("r.idx") == F.col("_i")), "left")
    return both.select("session_id", "r", F.coalesce("o1", "o2").alias("o"))


def attribution_accuracy(reviewed: DataFrame, original: DataFrame) -> DataFrame:
    """Per session: matched rows, how many keep their speaker, and the mean nearness of times (2 s apart in sum: none)."""
    m = matched(reviewed, original).where("o is not null")
    delta = F.abs(F.col("r.s_ms") - F.col("o.s_ms")) + F.abs(F.col("r.e_ms") - F.col("o.e_ms"))
    near = F.greatest(F.lit(0), 2000 - delta)
    return m.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("r.speaker") == F.col("o.speaker"), 1)).alias("same_speaker"),
        F.avg(F.when(F.col("r.speaker") == F.col("o.speaker"), 1.0).otherwise(0.0)).alias("speaker_accuracy"),
        (F.sum(near) / (F.count(F.lit(1)) * 2000)).alias("timestamp_accuracy"),
    )


def code_switch_stats(reviewed: DataFrame) -> DataFrame:
    """Per session: rows about code switching, those unresolved, the share resolved (0.99 where there is none). Needs language, review_reasons, unresolved."""
    open_ = F.arrays_overlap(F.coalesce("unresolved", F.array().cast("array<string>")), F.array(F.lit("code_switch"), F.lit("language_uncertain"), F.lit("unresolved")))
    about = open_ | F.lower(F.coalesce("language", F.lit(""))).isin("hinglish", "code-switch", "code_switch", "mixed") | F.coalesce(F.array_contains("review_reasons", "code_switch_detected"), F.lit(False))
    out = reviewed.groupBy("session_id").agg(F.count(F.when(about, 1)).alias("code_switch_segments"), F.count(F.when(open_, 1)).alias("unresolved_code_switch"))
    share = (F.col("code_switch_segments") - F.col("unresolved_code_switch")) / F.nullif(F.col("code_switch_segments"), F.lit(0))
    return out.withColumn("code_switch_accuracy", F.coalesce(share, F.lit(0.99)))


def error_rates(reviewed: DataFrame) -> DataFrame:
    """Per session: word and character error rate of the recogniser's text against the reviewed text. Needs idx, asr_text, reviewed_text."""
    whole = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.coalesce(c, F.lit("")).alias("t")))), lambda x: x["t"]), " ")
    t = reviewed.groupBy("session_id").agg(whole("reviewed_text").alias("ref"), whole("asr_text").alias("hyp"))
    t = t.select("session_id", T.split_words(T.for_wer(F.col("ref"))).alias("a"), T.split_words(T.for_wer(F.col("hyp"))).alias("b"))
    # Distances are quadratic in a session's few kilobytes, so sessions are dealt over all tasks, by number and not by size.
    t = t.repartition(int(t.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("session_id"))
    t = t.withColumn("d", T.word_edit_distance("a", "b"))
    chars = lambda c: F.array_join(c, "")
    cd = F.levenshtein(chars("a"), chars("b"))
    return t.select("session_id", F.size("a").alias("ref_words"), F.col("d").alias("word_errors"), T.error_rate(F.col("d"), F.size("a")).alias("wer"), F.length(chars("a")).alias("ref_chars"), cd.alias("char_errors"), T.error_rate(cd, F.length(chars("a"))).alias("cer"))


def delivery(reviewed: DataFrame, completed: Column | None = None) -> DataFrame:
    """Per session: n_rows, n_empty, n_unresolved, completion_rate, delivery_confidence."""
    d = reviewed.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.trim(F.coalesce("reviewed_text", F.lit(""))) == "", 1)).alias("n_empty"), F.sum(F.size(F.coalesce("unresolved", F.array().cast("array<string>")))).alias("n_unresolved"))
    rate = (F.col("n_rows") - F.col("n_empty")) / F.col("n_rows")
    completed = F.lit(True) if completed is None else completed
    clean = completed & (F.col("n_empty") == 0) & (F.col("n_unresolved") == 0)
    return d.withColumn("completion_rate", rate).withColumn("delivery_confidence", F.when(clean, CONFIDENCE_COMPLETE).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.98), rate - F.col("n_unresolved") * ISSUE_PENALTY))))


def verify(df: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """df with verify_reasons: earlier errors (review_errors), then each accuracy below its target, then validation. Needs delivery_confidence, *_accuracy, validation_passed."""
    below = rules(
        (F.col("delivery_confidence") < targets["word"], "verified_word_accuracy_below_target"),
        (F.col("speaker_accuracy") < targets["speaker"], "verified_speaker_accuracy_below_target"),
        (F.col("timestamp_accuracy") < targets["timestamp"], "verified_timestamp_accuracy_below_target"),
        (F.col("code_switch_accuracy") < targets["code_switch"], "verified_code_switch_accuracy_below_target"),
        (~F.col("validation_passed"), "validation_failed"),
    )
    return df.withColumn("verify_reasons", F.array_distinct(F.concat("review_errors", below)))


def finalise(df: DataFrame, approve: Column | None = None) -> DataFrame:
    """df with passed, stage (approved, reviewed, review_required, rejected), review_status, delivery_reason. Needs verify()'s columns and completed."""
    approve = F.lit(True) if approve is None else approve
    d = df.withColumn("passed", F.col("completed") & F.col("validation_passed") & (F.size("verify_reasons") == 0))
    stage = F.when(F.col("passed") & approve, "approved").when(F.col("passed"), "reviewed").when(~F.col("completed") & ~approve, "review_required").otherwise("rejected")
    d = d.withColumn("stage", stage)
    status = F.when(F.col("stage").isin("approved", "reviewed"), "completed").when(F.col("stage") == "review_required", "pending").otherwise("needs_correction")
    reason = F.when(F.col("stage") == "approved", "").when(F.col("stage") == "reviewed", "manual_approval_withheld").otherwise(F.array_join("verify_reasons", ";"))
    return d.withColumn("review_status", status).withColumn("delivery_reason", reason)


def upsert(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """table with the rows of each key replaced by, or joined with, new ones. Keys that come twice keep both new rows."""
    return table.join(rows.select(*key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete(table: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return table.join(keys.select(*key).distinct(), key, "left_anti")


def sync_status(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """One manifest of (session_id, stage, ...) in place of a file for each stage: a session stands once, in its latest stage; `reviewed` waits with review_required."""
    file = F.when(F.col("stage").isin("approved", "rejected"), F.col("stage")).otherwise("review_required")
    return upsert(manifest, rows.withColumn("manifest", file), ["session_id"])


def canonical_transcript(original: DataFrame, reviewed: DataFrame) -> DataFrame:
    """The transcript after review: reviewed rows over the original's columns, with the recogniser's text kept as asr_text_before_review."""
    o = original.select(F.col("session_id").alias("_s"), F.col("segment_id").alias("_id"), F.col("text").alias("_text"), F.col("language").alias("_lang"), F.col("quality_score").alias("quality_score"))
    j = reviewed.join(o, (F.col("session_id") == F.col("_s")) & (F.col("segment_id") == F.col("_id")), "left")
    return j.select("session_id", "idx", "segment_id", "speaker", "s_ms", "e_ms", F.col("reviewed_text").alias("text"), T.normalised(F.col("reviewed_text")).alias("text_normalized"), F.coalesce("language", "_lang").alias("language"), "quality_score", F.col("_text").alias("asr_text_before_review"), F.lit(True).alias("reviewed"))
