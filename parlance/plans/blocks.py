"""Blocks of a record: defaults for stages that did not run, policy from settings, projections and aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicons as lex

# What stands in a record for a stage that did not run, as JSON.
DEFAULTS = {
    "quality_metrics": '{"estimated_word_accuracy":null,"estimated_timestamp_accuracy":null,"estimated_code_switch_accuracy":null,"benchmark_evaluated":false,"human_review_completed":false}',
    "human_review": '{"required":true,"status":"pending","review_stage":"transcript_review","priority":{"level":"normal","score":0.0,"reasons":[]},"reviewer_id":null,"notes":null}',
    "premium_processing": '{"pipeline_mode":"offline_standard","paid_api_used":false,"engines_used":["whisper_local"],"consensus_applied":false,"timestamp_refinement_applied":false,"human_review_required":true}',
    "routing_decision": '{"pipeline_mode":"offline_standard","paid_api_allowed":false,"local_first":true,"difficulty_score":0.0,"should_escalate":false,"escalated_to_paid":false,"reasons":[],"attempted_engines":["whisper_local"],"skipped_engines":[],"engines_attempted":["whisper_local"],"engines_skipped":[],"engines_used":["whisper_local"]}',
    "timestamp_refinement": '{"timestamp_method":null,"timestamp_confidence":null,"word_timestamps_available":false,"segment_timestamps_available":false,"refinement_applied":false,"synthetic_word_timestamps":false,"timing_quality":"low","notes":[]}',
    "accuracy_gate": '{"target_word_accuracy":0.99,"estimated_word_accuracy":0.0,"verified_word_accuracy":null,"target_speaker_accuracy":0.99,"estimated_speaker_accuracy":0.0,"verified_speaker_accuracy":null,"target_timestamp_accuracy":0.98,"estimated_timestamp_accuracy":0.0,"verified_timestamp_accuracy":null,"target_code_switch_accuracy":0.99,"estimated_code_switch_accuracy":0.0,"verified_code_switch_accuracy":null,"estimated":true,"verified_accuracy":false,"passed":false,"human_review_required":true,"human_review_completed":false,"human_review_required_for_delivery":true,"word_accuracy_basis":"reviewed_delivery_confidence","asr_accuracy_basis":"asr_vs_review_only_not_delivery_claim","reviewed_delivery_target_met":false,"measured_word_accuracy_available":false,"measured_word_accuracy":null,"reviewed_delivery_confidence":null,"reasons":["accuracy_gate_not_evaluated"]}',
    "delivery_status": '{"stage":"review_required","approved_for_client_delivery":false,"reason":"accuracy_gate_not_evaluated"}',
}
# The settings that versions are named after.
MODELS = {"model_size": "whisper", "diarisation_backend": "diarisation", "vad_backend": "vad", "fasttext_model": "fasttext_lid", "language_profile": "language_profile"}
# What a basic record keeps of a speaker and of a conversation.
BASIC_SPEAKER = ("label", "total_speaking_time_s", "word_count", "wpm", "pause_frequency_per_min", "speaking_style", "turn_count", "speech_ratio", "dominance_score", "provided_metadata", "language", "speaker_id", "accent", "region", "dialect", "gender", "age_band")
BASIC_CONVERSATION = ("turn_count", "speaker_count", "avg_turn_length_s", "total_speech_time_s", "quality", "topic", "sub_topic", "domain")
#: Accuracy targets where neither an override nor a gate names one.
TARGETS = {"word": 0.99, "speaker": 0.99, "timestamp": 0.98, "code_switch": 0.99}


def with_defaults(records: DataFrame) -> DataFrame:
    """records with each block of DEFAULTS as a JSON column of its name: what is there stays, null or missing blocks get the default."""
    have = {c: F.col(c) if kind == "string" else F.to_json(c) for c, kind in records.dtypes if c in DEFAULTS}
    return records.withColumns({c: F.coalesce(have[c], F.lit(text)) if c in have else F.lit(text) for c, text in DEFAULTS.items()})


def model_versions(settings: dict) -> Column:
    """A map of model names to versions, of the settings that name one."""
    pairs = [x for key, name in MODELS.items() if settings.get(key) for x in (F.lit(name), F.lit(str(settings[key])))]
    return F.create_map(*pairs).cast("map<string,string>")


def quality_targets(settings: dict) -> Column:
    """Struct of accuracy targets: a target that settings leave out or set to 0 falls back on the transcript's, that on 0.98."""
    base = settings.get("transcript_accuracy_target") or 0.98
    word = settings.get("word_accuracy_target") or base
    review = settings.get("require_human_review")
    review = settings.get("metadata_review_required", True) if review is None else review
    values = {
        "transcript_accuracy_target": settings.get("transcript_accuracy_target") or word,
        "word_accuracy_target": word,
        "speaker_accuracy_target": settings.get("speaker_accuracy_target") or 0.99,
        "timestamp_accuracy_target": settings.get("timestamp_accuracy_target") or 0.98,
        "code_switch_accuracy_target": settings.get("code_switch_accuracy_target") or base,
    }
    return F.struct(*(F.lit(round(float(v), 4)).alias(k) for k, v in values.items()), F.lit(bool(review)).alias("human_review_required"))


def review_targets(overrides: dict[str, Column], gate: dict[str, Column]) -> Column:
    """Struct word, speaker, timestamp, code_switch: an override, else the gate's target, else TARGETS; 0 names none."""
    given = lambda c: F.when(c != 0, c)
    return F.struct(*(F.coalesce(*(given(d[k]) for d in (overrides, gate) if k in d), F.lit(v)).cast("double").alias(k) for k, v in TARGETS.items()))


def second_pass_required(reviewed: Column, policy: Column, targets: Column, enterprise: Column, premium: Column, mode: Column, enterprise_mode: Column) -> Column:
    """Whether a second review is due: asked for anywhere, or a premium run under an enterprise policy. Null is no."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return yes(reviewed) | yes(policy) | yes(targets) | yes(enterprise) | yes(premium) | (F.coalesce(mode, F.lit("")) == "premium_accuracy") & yes(enterprise_mode)


def review_source(before: Column, current: Column) -> tuple[Column, Column]:
    """The transcript that a review is held against, and where it comes from: the copy kept before an earlier review, if it has segments. Both are structs with `segments`."""
    kept = F.coalesce(F.size(before["segments"]) > 0, F.lit(False))
    return F.when(kept, before).otherwise(current), F.when(kept, "asr_transcript_before_review").otherwise("current_transcript_before_first_review")


def known_speakers(*lists: Column) -> Column:
    """All speakers named in any list (null or empty names aside), in order; where there is any, the two default ones too."""
    none = F.array().cast("array<string>")
    named = F.array_distinct(F.filter(F.concat(*(F.coalesce(x, none) for x in lists)), lambda s: F.coalesce(s, F.lit("")) != ""))
    return F.array_sort(F.when(F.size(named) > 0, F.array_union(named, F.array(F.lit("SPEAKER_00"), F.lit("SPEAKER_01")))).otherwise(named))


def delivery_status(gate_passed: Column, gate_reasons: Column, validation_passed: Column, review_required: Column) -> Column:
    """Struct stage, approved_for_client_delivery, reason at processing time: approved if all passed and no review is due; else what stands in the way."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    ok = yes(gate_passed) & yes(validation_passed) & ~yes(review_required)
    stage = F.when(ok, "approved").when(yes(review_required), "review_required").otherwise("rejected")
    gate = F.array_join(F.coalesce(gate_reasons, F.array().cast("array<string>")), ";")
    reason = F.when(ok, "").when(gate != "", gate).when(yes(review_required), "human_review_pending").when(~yes(validation_passed), "validation_failed").otherwise("")
    return F.struct(stage.alias("stage"), ok.alias("approved_for_client_delivery"), reason.alias("reason"))


def basic(df: DataFrame, keep: tuple[str, ...], keys: tuple[str, ...] = ("session_id", "speaker")) -> DataFrame:
    """The keys and those of the columns that a basic record keeps; a conversation's row says so (metadata_depth)."""
    out = df.select(*(c for c in df.columns if c in keys or c in keep))
    return out.withColumn("metadata_depth", F.lit("basic")) if keep is BASIC_CONVERSATION else out


def interaction_aliases(df: DataFrame) -> DataFrame:
    """Older names beside the newer ones of an interaction report; a column that is there stays, a report without the newer one has the value of none."""
    none = {"turn_count": F.lit(0).cast("long"), "interruptions": F.lit(0).cast("long"), "overlap_duration": F.lit(0.0), "avg_response_latency": F.lit(None).cast("double"), "speaker_dominance": F.create_map().cast("map<string,double>")}
    names = {"turn_count": "total_turns", "interruptions": "interruption_count", "overlap_duration": "overlap_duration_s", "avg_response_latency": "mean_latency_s", "speaker_dominance": "dominance"}
    return df.withColumns({new: F.coalesce(F.col(old), none[new]) if old in df.columns else none[new] for new, old in names.items() if new not in df.columns})


def language_aliases(segments: Column, confidence: Column | float = 0.5) -> Column:
    """Struct segments, switch_count, patterns of consecutive segments (start, end, language, confidence).

    Segments get times and confidence to 3 places and a lang, `unknown` where there is none; a confidence that is null is the report's, and 0 counts as 0.5.
    A pattern `a→b` stands once, in order of its first use.
    """
    report = F.lit(confidence) if isinstance(confidence, float) else confidence
    sure = lambda s: F.coalesce(F.nullif(F.coalesce(s["confidence"], report), F.lit(0.0)), F.lit(0.5))
    place = lambda s, c: F.round(F.coalesce(s[c].cast("double"), F.lit(0.0)), 3).alias(c)
    lang = lambda s: F.coalesce(F.nullif(s["language"], F.lit("")), F.lit("unknown")).alias("lang")
    named = F.transform(segments, lambda s: F.struct(place(s, "start"), place(s, "end"), lang(s), F.round(sure(s), 3).alias("confidence")))
    steps = F.arrays_zip(F.slice(named["lang"], 1, F.greatest(F.size(named) - 1, F.lit(0))).alias("a"), F.slice(named["lang"], 2, F.greatest(F.size(named) - 1, F.lit(0))).alias("b"))
    moved = F.filter(steps, lambda s: s["a"] != s["b"])
    return F.struct(named.alias("segments"), F.size(moved).alias("switch_count"), F.array_distinct(F.transform(moved, lambda s: F.concat_ws("→", s["a"], s["b"]))).alias("patterns"))


def candidate_payload(segments: Column, include_segments: bool = True, include_words: bool = True) -> tuple[Column, Column]:
    """(segments, words) of a candidate: with include_words off segments keep an empty list, with include_segments off there are none."""
    words = F.flatten(F.transform(segments, lambda s: F.coalesce(s["words"], F.array().cast("array<string>"))))
    slim = segments if include_words else F.transform(segments, lambda s: s.withField("words", F.array().cast("array<string>")))
    return slim if include_segments else F.slice(segments, 1, 0), words if include_words else F.slice(words, 1, 0)


def normalisation_notes(text: Column, words: Column, extra: Column | None = None) -> Column:
    """What a comparison of this text has to put up with, each note once, after the extra ones."""
    roman = F.array(*map(F.lit, dict.fromkeys((*lex.ROMAN_HINDI, *lex.ROMAN_PUNJABI, *lex.ROMAN_MARWADI))))
    say = lambda c, note: F.when(F.coalesce(c, F.lit(False)), note)
    notes = F.array(
        say(text.rlike(r"(?U)[^\p{L}\p{N}_\s]"), "punctuation_normalisation_applied_for_comparison"),
        say(text.rlike(r"[0-9०-९੦-੯]"), "numeral_normalisation_applied_for_comparison"),
        say(F.arrays_overlap(F.split(F.lower(F.trim(text)), r"\s+"), roman), "romanized_indic_tokens_present"),
        say(F.exists(words, lambda w: F.contains(w, F.lit("-"))), "provider_token_split_merge_variation_detected"),
    )
    none = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(none if extra is None else F.coalesce(extra, none), F.array_compact(notes)), lambda n: n != ""))


def rationale(agreement: Column, timing: Column, preservation: Column, structure: Column, notes: Column, timestamp_confidence: Column, languages: Column, detected: Column) -> Column:
    """Why a candidate scored as it did: four figures to 4 places, its notes, and what weakens it."""
    figure = lambda name, c: F.format_string(f"{name}=%.4f", c.cast("double"))
    return F.array_compact(
        F.array(
            figure("token_agreement", agreement),
            figure("timing_agreement", timing),
            figure("code_switch_preservation", preservation),
            figure("switch_structure_agreement", structure),
            F.when(F.size(notes) > 0, F.concat(F.lit("normalisation="), F.array_join(notes, ","))),
            F.when(F.coalesce(timestamp_confidence, F.lit(0.0)) < 0.55, "weak_timestamp_confidence"),
            F.when((F.size(languages) < 2) & F.coalesce(detected, F.lit(False)), "collapsed_multilingual_boundaries"),
        )
    )


def diarisation_status(requested: Column, failed: Column) -> Column:
    """The back end that did the work: a failed one is replaced by clustering, which is said."""
    # Fixed value: the status of a replaced back end.
    return F.when(F.coalesce(failed, F.lit(False)) & (requested != "kmeans"), "kmeans_fallback").otherwise(requested)


def document_language(scripts: Column, marwadi: Column, roman_language: Column, roman_strength: Column) -> Column:
    """Struct language, confidence of a whole text. scripts: its scripts; marwadi: share of Marwadi words among Devanagari ones; roman_language and its strength: the probe of Latin words (en: none)."""
    has = lambda s: F.array_contains(scripts, s)
    mixed = has("Latin")
    is_marwadi = has("Devanagari") & (marwadi >= 0.25)
    pick = lambda lang, conf: F.struct(F.lit(lang).alias("language") if isinstance(lang, str) else lang.alias("language"), conf.cast("double").alias("confidence"))
    return (
        F.when(is_marwadi, pick("mwr", F.greatest(F.when(mixed, 0.65).otherwise(0.70), marwadi)))
        .when(has("Devanagari"), pick("hi", F.when(mixed, 0.75).otherwise(0.9)))
        .when(has("Gurmukhi"), pick("pa", F.when(mixed, 0.75).otherwise(0.9)))
        .when(F.coalesce(roman_language, F.lit("en")) != "en", pick(roman_language, 0.55 + 0.3 * roman_strength))
        .otherwise(pick("en", F.lit(0.6)))
    )


def conversation_manifest(records: DataFrame, annotations: str = "") -> DataFrame:
    """One row a conversation, in the manifest's columns and types, whatever columns the records have; annotations is the folder of the records' files."""
    # The manifest's columns with their types and, where it differs, what they are called in a record.
    columns = {
        "session": ("string", "session_id"), "input_mode": ("string", ""), "generated_at": ("string", ""), "duration_s": ("double", "total_speech_time_s"), "conversation_duration_s": ("double", ""), "turn_count": ("bigint", ""), "speaker_count": ("bigint", ""), "primary_language": ("string", ""),
        "dominant_language": ("string", ""), "multilingual": ("boolean", "multilingual_flag"), "switching_score": ("double", ""), "engagement_score": ("double", ""), "dominant_speaker": ("string", ""), "alignment_applied": ("boolean", ""), "alignment_confidence": ("double", ""),
        "mono_mix_peak_after": ("double", "peak_after"), "mean_quality_score": ("double", ""), "validation_passed": ("boolean", ""), "validation_issue_count": ("bigint", "issue_count"), "mono_audio_path": ("string", "mono_wav"), "annotation_path": ("string", ""),
    }
    absent = {"session": F.lit(""), "input_mode": F.lit(""), "generated_at": F.lit(""), "multilingual": F.lit(False), "mono_audio_path": F.lit("")}
    out = {name: F.col(src or name) if (src or name) in records.columns else absent.get(name, F.lit(None)) for name, (_, src) in columns.items()}
    out["annotation_path"] = F.concat(F.lit(f"{annotations.rstrip('/')}/" if annotations else ""), F.coalesce(out["session"].cast("string"), F.lit("")), F.lit(".json"))
    return records.select(*(out[name].cast(kind).alias(name) for name, (kind, _) in columns.items()))


def speaker_manifest(speakers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all speakers of all sessions, those with a monologue's path)."""
    # The manifest's columns.
    columns = ("session", "speaker", "label", "total_speaking_time_s", "word_count", "wpm", "filler_ratio", "pause_frequency_per_min", "speaking_style", "speaking_style_confidence", "formality", "formality_confidence", "accent", "accent_confidence", "provided_metadata", "turn_count", "primary_language", "monologue_path")
    named = speakers.withColumn("session", F.col("session_id"))
    label = F.coalesce("label", "speaker") if "label" in speakers.columns else F.col("speaker")
    rows = named.withColumn("label", label).select(*(F.col(c) if c in (*named.columns, "label") else F.lit(None).cast("string").alias(c) for c in columns))
    return rows, rows.where(F.coalesce("monologue_path", F.lit("")) != "")


def write_session_tables(root: str, tables: dict[str, DataFrame], partition: str | None = None, append: bool = False) -> list[str]:
    """All artefacts of a run in the order of `tables` (raw, transcripts, review package, products, exports, manifests, validation reports), each as JSON lines under its name; with append, reruns add to what is there."""
    for name, df in tables.items():
        writer = df.write.mode("append" if append else "overwrite")
        (writer.partitionBy(partition) if partition and partition in df.columns else writer).json(f"{root.rstrip('/')}/{name}")
    return list(tables)
