"""Queries over the generic tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import lexicons as lex
from .functions import text as T
from .llm.common import materialise
from .operators import classifier, consensus, diarisation, gates, interaction, intervals, language, monologue, overlap, quality, review, speakers
from .operators import transcripts as merged
from .plans import engine, exports, record
from .sources import listing, transcripts
from .sources import relations as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def joined(column: str) -> F.Column:
    return F.array_join(column, ",").alias(column)


# ---- interaction ------------------------------------------------------------------------------------------------


@query
def interaction_report(spark: SparkSession, d: str) -> DataFrame:
    return interaction.report(R.turns(spark, d))


@query
def response_latency(spark: SparkSession, d: str) -> DataFrame:
    return interaction.latencies(R.turns(spark, d))


@query
def turn_overlap_short(spark: SparkSession, d: str) -> DataFrame:
    return interaction.overlaps(R.turns(spark, d))


@query
def turn_overlap_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The same join over events by time buckets, for sessions of any length."""
    return intervals.speaker_overlaps(R.intervals(spark, d), 50, bucket_ms=3_600_000).select("session_id", F.col("a.idx").alias("a"), F.col("b.idx").alias("b"), "dur_ms")


@query
def turn_overlap_typed(spark: SparkSession, d: str) -> DataFrame:
    return overlap.regions(R.turns(spark, d), R.segments(spark, d))


@query
def speaker_dominance(spark: SparkSession, d: str) -> DataFrame:
    return interaction.dominance(R.turns(spark, d))


@query
def overlap_ratio_by_speaker(spark: SparkSession, d: str) -> DataFrame:
    return interaction.overlap_ratio(R.turns(spark, d))


@query
def adjacent_overlap_markers(spark: SparkSession, d: str) -> DataFrame:
    return overlap.adjacent_markers(R.turns(spark, d))


# ---- intervals --------------------------------------------------------------------------------------------------


@query
def word_to_turn_nearest(spark: SparkSession, d: str) -> DataFrame:
    w = R.words(spark, d).withColumn("mid", F.col("ws_ms") + F.col("we_ms")).drop("speaker")
    return intervals.locate(w, R.turns(spark, d), "mid", ["session_id", "seg_idx", "word_idx"])


@query
def segment_to_turn_closed(spark: SparkSession, d: str) -> DataFrame:
    s = R.segments(spark, d).select("session_id", "idx", (F.col("s_ms") + F.col("e_ms")).alias("mid"))
    return intervals.locate(s.withColumnRenamed("idx", "seg_idx"), R.turns(spark, d), "mid", ["session_id", "seg_idx"], closed=True)


@query
def segment_best_speaker(spark: SparkSession, d: str) -> DataFrame:
    s = R.segments(spark, d).select("session_id", F.col("idx").alias("seg_idx"), (F.col("s_ms") + 150).alias("s_ms"), (F.col("e_ms") + 150).alias("e_ms"))
    return intervals.best_overlap(s, R.turns(spark, d), ["session_id", "seg_idx"])


@query
def utterance_manifest(spark: SparkSession, d: str) -> DataFrame:
    return overlap.utterances(R.turns(spark, d), R.segments(spark, d))


@query
def segment_overlap_annotation(spark: SparkSession, d: str) -> DataFrame:
    return overlap.annotate(R.segments(spark, d), overlap.regions(R.turns(spark, d), R.segments(spark, d))).select("session_id", "idx", "overlap", "overlap_type", "overlap_start", "overlap_end")


@query
def interval_union(spark: SparkSession, d: str) -> DataFrame:
    return intervals.union(R.intervals(spark, d))


@query
def vad_merge_pad(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge_and_pad(R.intervals(spark, d), F.lit(4_000_000_000_000).cast("long"), gap_ms=300_000, pad_ms=120)


@query
def speech_total(spark: SparkSession, d: str) -> DataFrame:
    return intervals.union(R.intervals(spark, d)).groupBy("session_id").agg(F.sum(F.col("e_ms") - F.col("s_ms")).alias("speech_ms"), F.count(F.lit(1)).alias("n"))


@query
def pairwise_overlap_seconds(spark: SparkSession, d: str) -> DataFrame:
    return intervals.pairwise_overlap(R.intervals(spark, d), "click", "view")


@query
def turns_from_vad(spark: SparkSession, d: str) -> DataFrame:
    return intervals.turns_from_vad(R.intervals(spark, d), gap_ms=60_000, min_ms=120_000)


@query
def sliding_windows(spark: SparkSession, d: str) -> DataFrame:
    return intervals.sliding_windows(R.turns(spark, d).select("session_id", "idx", "s_ms", "e_ms"))


@query
def undisturbed_turns(spark: SparkSession, d: str) -> DataFrame:
    t = R.turns(spark, d)
    return intervals.undisturbed(t.select("session_id", "idx", "speaker", "s_ms", "e_ms"), t)


# ---- language ---------------------------------------------------------------------------------------------------


@query
def tokenise_count(spark: SparkSession, d: str) -> DataFrame:
    w = T.tokens(F.col("text"))
    return R.table(spark, d, "documents").select("doc_id", F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("n_distinct"), F.get(w, F.lit(0)).alias("first"))


@query
def script_detect(spark: SparkSession, d: str) -> DataFrame:
    return R.table(spark, d, "documents").select("doc_id", F.array_join(T.scripts(F.col("text")), ",").alias("scripts"), T.script_tag(F.col("text")).alias("tag"), T.major_script(F.col("text")).alias("major"))


@query
def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return R.table(spark, d, "conversations").select("conv_id", "turn", T.for_wer(t).alias("wer_text"), T.for_consensus(t).alias("consensus_text"))


@query
def roman_lexicon_probe(spark: SparkSession, d: str) -> DataFrame:
    p = language.lexicon_probe(T.tokens(F.col("text")), legacy=True)
    return R.table(spark, d, "documents").select("doc_id", p["lang"].alias("lang"), p["hits"].alias("hits"), p["strength"].alias("strength"))


@query
def segment_language(spark: SparkSession, d: str) -> DataFrame:
    s = language.segment_language(F.col("text"), legacy=True)
    return R.table(spark, d, "documents").select("doc_id", s["lang"].alias("lang"), s["confidence"].alias("confidence"))


@query
def language_report(spark: SparkSession, d: str) -> DataFrame:
    return language.report(R.segments(spark, d))


@query
def speaker_language_report(spark: SparkSession, d: str) -> DataFrame:
    return language.report(R.segments(spark, d), ["session_id", "speaker"])


@query
def code_switch_report(spark: SparkSession, d: str) -> DataFrame:
    return language.code_switch_report(R.segments(spark, d)).withColumn("patterns", joined("patterns"))


@query
def bcp47_distribution(spark: SparkSession, d: str) -> DataFrame:
    m = language.distribution(R.segments(spark, d))
    return m.select("session_id", F.array_join(F.transform(F.map_entries("distribution"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias("distribution"))


def _tagged_words(spark: SparkSession, d: str) -> DataFrame:
    """Words with their language; every ninth counts as Hindi and every eleventh as Punjabi, so that languages switch."""
    k = F.col("session_id") + F.col("word_idx")
    lang = F.when(k % 9 == 0, "hi-Latn").when(k % 11 == 0, "pa-Latn").when(k % 13 == 0, "hi").otherwise(language.word_language(F.col("word"), F.lit("en"))["lang"])
    return R.words(spark, d).withColumn("lang", lang)


@query
def word_language(spark: SparkSession, d: str) -> DataFrame:
    w = language.word_language(F.col("word"), F.lit("en"))
    return R.words(spark, d).select("session_id", "seg_idx", "word_idx", w["lang"].alias("lang"), w["confidence"].alias("confidence"))


@query
def switch_points(spark: SparkSession, d: str) -> DataFrame:
    return language.switch_points(_tagged_words(spark, d))


@query
def cs_density(spark: SparkSession, d: str) -> DataFrame:
    return language.matrix_language(_tagged_words(spark, d))


@query
def cs_density_session(spark: SparkSession, d: str) -> DataFrame:
    return language.code_switch_density(_tagged_words(spark, d)).select("session_id", "switches", "words", "density")


@query
def punctuation_split(spark: SparkSession, d: str) -> DataFrame:
    return language.punctuate(R.words(spark, d), R.segments(spark, d))


# ---- speakers and conversations ----------------------------------------------------------------------------------


@query
def speaker_profile(spark: SparkSession, d: str) -> DataFrame:
    t = R.turns(spark, d)
    audio = t.groupBy("session_id").agg(F.max("e_ms").alias("audio_ms"))
    return speakers.profile(R.words(spark, d), t, audio, fillers=("the", "and", "la", "de", "die", *lex.FILLERS))


@query
def pause_stats(spark: SparkSession, d: str) -> DataFrame:
    return speakers.pauses(R.words(spark, d), 100)


@query
def conversation_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return speakers.conversation_quality(R.segments(spark, d))


@query
def conversation_profile(spark: SparkSession, d: str) -> DataFrame:
    return speakers.conversation_profile(R.turns(spark, d))


@query
def keyword_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = R.table(spark, d, "documents").select("source", F.col("doc_id").alias("idx"), "text")
    return speakers.keywords(docs, "source")


@query
def keyword_tfidf(spark: SparkSession, d: str) -> DataFrame:
    c = R.table(spark, d, "conversations").select("conv_id", F.col("turn").alias("idx"), "text")
    return speakers.tfidf_keywords(c, "conv_id").select("conv_id", "keyword", F.round("weight", 6).alias("weight"))


@query
def intent_multilabel(spark: SparkSession, d: str) -> DataFrame:
    return R.table(spark, d, "documents").select("doc_id", F.array_join(speakers.intents(F.col("text")), ",").alias("intents"))


@query
def domain_infer(spark: SparkSession, d: str) -> DataFrame:
    x = speakers.domain(F.col("text"), F.length("text") > 20)
    return R.table(spark, d, "documents").select("doc_id", x.alias("x")).select("doc_id", F.col("x.value").alias("domain"), F.col("x.confidence").alias("confidence"))


@query
def monologue_spans(spark: SparkSession, d: str) -> DataFrame:
    s = monologue.spans(R.words(spark, d), R.turns(spark, d), monologue.Limits(2_000, 3_000, 6_000, 8_000, 100))
    return s.select("session_id", "turn_idx", "span", "speaker", "s_ms", "e_ms", "n_words", "in_range", "silence_ratio", "interruption_free", "score")


@query
def monologue_best(spark: SparkSession, d: str) -> DataFrame:
    limits = monologue.Limits(2_000, 3_000, 6_000, 8_000, 100)
    s = monologue.spans(R.words(spark, d), R.turns(spark, d), limits)
    return monologue.best(s, ["session_id"], limits).select("session_id", "turn_idx", "speaker", "s_ms", "e_ms", "n_words", "in_range", "score")


# ---- quality ----------------------------------------------------------------------------------------------------


@query
def asr_quality_score(spark: SparkSession, d: str) -> DataFrame:
    q = quality.asr_quality(F.col("avg_logprob"), F.col("compression_ratio"), F.col("no_speech_prob"), F.col("rms_db"))
    return R.segments(spark, d).select("session_id", "idx", F.round(q, 6).alias("quality"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    s = R.segments(spark, d)
    k = F.col("session_id") + F.col("turn")
    s = quality.annotate_snr(s, 400).withColumns({"has_words": F.col("n_words") > 0, "overlap": k % 7 == 0, "mid_switch": k % 10 == 3, "entropy": F.when(k % 19 == 0, 0.8).otherwise(0.0)})
    return quality.confidence(s, 6)


@query
def snr_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    return quality.annotate_snr(R.segments(spark, d), 2_000).select("session_id", "idx", "snr_db", "snr_band", "snr_reason", "snr_source", "clipping_ratio", "snr_quality")


@query
def composite_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("session_id", "idx", "confidence", "confidence_band", F.round("wpm_z", 6).alias("wpm_z"))


@query
def confidence_band_relative(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("session_id", "idx", "confidence_band_relative")


@query
def quality_tier(spark: SparkSession, d: str) -> DataFrame:
    s = quality.tier(_scored(spark, d).withColumn("confidence_reasons", F.filter("confidence_reasons", lambda x: ~x.startswith("wpm_outlier"))))
    return s.select("session_id", "idx", "quality_tier", joined("tier_reasons"), "flagged_for_review")


@query
def tier_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.tier_histogram(quality.tier(_scored(spark, d)))


@query
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    s = quality.tier(_scored(spark, d)).withColumn("segment_id", F.format_string("%d_%04d", "session_id", "idx")).withColumn("audio_filepath", F.concat("session_id", F.lit(".wav")))
    return quality.review_queue(s).select("session_id", "segment_id", "audio_filepath", "s_ms", "e_ms", "quality_tier", "confidence")


@query
def transcript_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.transcript_quality(R.segments(spark, d))


@query
def environment_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of made-up measurements of every order."""
    o = R.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 31 - 3).cast("double").alias("snr"), (F.col("o_orderkey") % 17 / 10.0).alias("rt60"), (F.col("o_orderkey") % 43 / 10.0).alias("khz"))
    e, n, v = quality.environment(F.col("snr"), F.col("rt60")), quality.noise_level(F.col("snr")), quality.device(F.col("khz"), F.lit(16000))
    return o.select("o_orderkey", e["value"].alias("environment"), e["confidence"].alias("environment_confidence"), n["value"].alias("noise"), v["value"].alias("device"), quality.audio_band(F.col("khz") * 1000).alias("band"))


# ---- candidates -------------------------------------------------------------------------------------------------


def _signals(spark: SparkSession, d: str) -> DataFrame:
    e = R.engines(spark, d)
    return e.select("session_id", "engine", *(F.expr(f"{c} / 1000.0D").alias(c) for c in ("conf", "word_conf", "ts_conf")), "switch_count", F.least(F.lit(1.0), F.col("switch_count") / 10.0).alias("switching_score"), "langs", "patterns")


@query
def routing_difficulty(spark: SparkSession, d: str) -> DataFrame:
    q = consensus.quality_signals(R.segments(spark, d))
    k = F.col("session_id")
    c = q.withColumns(
        {
            "recording_condition": consensus.recording_condition(F.element_at(F.array(F.lit("street"), F.lit("Studio"), F.lit("")), (k % 3 + 1).cast("int"))),
            "noise_level": consensus.noise_level(F.lit(None).cast("string"), (k % 25).cast("double")),
            "switch_density": consensus.switch_density(k % 7 / 10.0, k % 11 / 2.0, k % 5, k % 4 == 0),
            "overlap_s": k % 9 / 4.0,
            "review_priority": F.when(k % 6 == 0, "High").otherwise("normal"),
        }
    )
    r = consensus.route(c, "premium_accuracy", True)
    return r.select("session_id", "recording_condition", "noise_level", "switch_density", F.floor(F.col("difficulty_score") * 1000).alias("difficulty_milli"), joined("reasons"))


@query
def candidate_bag_overlap(spark: SparkSession, d: str) -> DataFrame:
    return consensus.bags(consensus.texts(R.candidates(spark, d)))


@query
def timing_agreement(spark: SparkSession, d: str) -> DataFrame:
    return consensus.timing(R.candidates(spark, d))


@query
def switch_structure(spark: SparkSession, d: str) -> DataFrame:
    return consensus.pairs(_signals(spark, d)).select("session_id", "engine", "peer", consensus.switch_agreement("a", "b").alias("agreement"))


@query
def token_sequence_similarity(spark: SparkSession, d: str) -> DataFrame:
    return consensus.sequences(consensus.texts(R.candidates(spark, d)))


@query
def consensus_choice(spark: SparkSession, d: str) -> DataFrame:
    return consensus.choose(R.candidates(spark, d), _signals(spark, d)).withColumn("disagreement_flags", joined("disagreement_flags"))


@query
def consensus_segments(spark: SparkSession, d: str) -> DataFrame:
    c = R.candidates(spark, d)
    return consensus.final_segments(c, consensus.choose(c, _signals(spark, d)))


@query
def even_word_times(spark: SparkSession, d: str) -> DataFrame:
    return consensus.even_words(R.turns(spark, d)).select("session_id", "seg_idx", "word_idx", F.floor(F.col("ws_ms") + 1e-6).alias("ws_ms"))


@query
def timestamp_refinement(spark: SparkSession, d: str) -> DataFrame:
    e = R.engines(spark, d).select("session_id", "engine", F.expr("ts_conf / 1000.0D").alias("ts_conf"), F.when(F.col("engine") == "deepgram", "vendor_word_timestamps").otherwise("segment").alias("timing_source"), (F.col("session_id") % 3 != 0).alias("has_words"), (F.col("session_id") % 5 != 0).alias("can_split"))
    return consensus.refine(e).select("session_id", "engine", "timestamp_method", "timestamp_confidence", "synthetic", "timing_quality")


@query
def merged_transcript(spark: SparkSession, d: str) -> DataFrame:
    return merged.merge_speakers(R.segments(spark, d)).select("session_id", "idx", "speaker", "s_ms")


@query
def transcript_header(spark: SparkSession, d: str) -> DataFrame:
    return merged.header(R.segments(spark, d)).select("session_id", "language", "language_probability", "duration_ms", F.length("text").alias("chars"))


@query
def speaker_texts(spark: SparkSession, d: str) -> DataFrame:
    return merged.speaker_texts(R.segments(spark, d))


@query
def forced_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Segments of some length by an aligner, 100 ms later; it leaves short ones alone."""
    s = R.segments(spark, d)
    a = s.where("length(text) > 80").select("session_id", F.col("idx").cast("int").alias("place"), (F.col("s_ms") + 100).alias("a_s_ms"), (F.col("e_ms") + 100).alias("a_e_ms"))
    return merged.forced_alignment(s, a).select("session_id", "idx", "s_ms", "e_ms", "aligned")


#: Labelled documents that the classifier is fitted on, at most; drawn by a hash of doc_id.
CLASSIFIER_SAMPLE = 300


@query
def text_classifier(spark: SparkSession, d: str) -> DataFrame:
    """A classifier of documents' languages: fitted on CLASSIFIER_SAMPLE labelled documents, applied to every document, labelled or not (a null text is empty)."""
    R.bound_batches(spark)
    docs = R.table(spark, d, "documents")
    sample = docs.where("lang is not null and text is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CLASSIFIER_SAMPLE).select(F.col("lang").alias("label"), "text")
    return classifier.predict(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), classifier.train(sample)).select("doc_id", "lang", F.round("score", 6).alias("score"))


# ---- gates ------------------------------------------------------------------------------------------------------


def _gate_input(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("session_id")
    s = R.turns(spark, d).select("session_id").distinct()
    return s.withColumns(
        {
            "consensus_score": F.when(k % 10 != 0, (800 + k * 7 % 200) / 1000.0),
            "timestamp_confidence": F.when(k % 8 != 0, (900 + k * 3 % 100) / 1000.0),
            "code_switch_detected": k % 3 == 0,
            "code_switch_confidence": F.when(k % 9 != 0, (k * 11 % 100) / 100.0),
            "speaker_confidence": (950 + k % 50) / 1000.0,
            "recording_condition": F.when(k % 4 == 0, "outdoor").otherwise("indoor"),
            "synthetic": k % 5 == 0,
            "timing_quality": F.when(k % 8 != 0, F.when(k % 5 == 0, "low").otherwise("high")),
            "n_engines": k % 3 + 1,
            "disagreement_flags": F.array_compact(F.array(F.when(k % 6 == 0, "strong_timestamp_disagreement"), F.when(k % 7 == 0, "strong_transcript_disagreement"))),
            "speaker_count": k % 2 + 1,
            "overlap_s": k % 4 / 2.0,
            "noise_level": F.when(k % 3 != 2, "low").otherwise("high"),
            "review_status": F.when(k % 5 < 3, "approved").otherwise("pending"),
        }
    )


@query
def accuracy_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.accuracy_gate(_gate_input(spark, d)).select("session_id", "estimated_word", "estimated_timestamp", "estimated_code_switch", joined("gate_reasons"), "gate_passed")


@query
def review_priority(spark: SparkSession, d: str) -> DataFrame:
    p = gates.review_priority(gates.accuracy_gate(_gate_input(spark, d)))
    return p.select("session_id", "priority_score", "priority_level", joined("priority_reasons"))


@query
def tts_suitability(spark: SparkSession, d: str) -> DataFrame:
    return gates.tts_suitability(_gate_input(spark, d)).select("session_id", joined("tts_reasons"), "tts_eligible", "tts_confidence")


@query
def dataset_purpose(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("session_id")
    r = R.turns(spark, d).groupBy("session_id").agg(F.countDistinct("speaker").alias("speaker_count"), F.count(F.lit(1)).alias("n")).withColumns(
        {"has_text": k % 6 != 0, "has_segments": k % 5 != 0, "has_turns": k % 7 != 0, "overlap_s": k % 3 / 5.0, "input_mode": F.when(k % 2 == 0, "stereo").otherwise("mono"), "tts_ready": k % 2 == 0, "validation_passed": k % 11 != 0, "snr_db": (k % 40).cast("double")}
    )
    return gates.purpose(r).select("session_id", joined("purpose_primary"), joined("purpose_secondary"), joined("not_recommended_for"))


@query
def validation_issues(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("session_id")
    t = R.turns(spark, d).groupBy("session_id").agg(F.count(F.lit(1)).alias("turn_count"), (F.max("e_ms") / 1000.0).alias("duration_s"))
    q = quality.transcript_quality(R.segments(spark, d)).select("session_id", "segment_count", "low_ratio")
    x = t.join(q, "session_id").withColumns(
        {
            "audio_errors": F.when(k % 23 == 0, 1).otherwise(0),
            "audio_warnings": F.when(k % 6 == 0, 2).otherwise(0),
            "speech_count": k % 4,
            "clipping_ratio": k % 30 / 1000.0,
            "requested_backend": F.lit("pyannote"),
            "effective_backend": F.when(k % 5 == 0, "kmeans_fallback").otherwise("pyannote"),
            "align_confidence": F.when(k % 3 != 0, k % 100 / 100.0),
            "align_applied": k % 2 == 0,
            "align_passed": k % 100 >= 35,
            "mismatch_s": (k % 90).cast("double"),
            "mismatch_limit_s": F.lit(60.0),
            "peak_before": (90 + k % 20) / 100.0,
            "expected_overlap_s": k % 5 / 5.0,
            "observed_overlap_s": k % 3 / 20.0,
        }
    )
    v = gates.validation(x, alignment_required=True)
    return v.select("session_id", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"), "issue_count", "passed")


# ---- review -----------------------------------------------------------------------------------------------------


def _reviewed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = R.reviews(spark, d)
    original = r.select("session_id", "idx", "segment_id", "speaker", "s_ms", "e_ms")
    reviewed = r.select("session_id", "idx", "segment_id", F.col("r_speaker").alias("speaker"), F.col("rs_ms").alias("s_ms"), F.col("re_ms").alias("e_ms"), "reviewed_text", "asr_text", "unresolved", F.lit("en").alias("language"), F.lit(None).cast("array<string>").alias("review_reasons"))
    return reviewed, original


@query
def wer_by_session(spark: SparkSession, d: str) -> DataFrame:
    return review.error_rates(_reviewed(spark, d)[0]).select("session_id", "ref_words", "word_errors", "wer")


@query
def cer_by_session(spark: SparkSession, d: str) -> DataFrame:
    return review.error_rates(_reviewed(spark, d)[0]).select("session_id", "ref_chars", "char_errors", "cer")


@query
def attribution_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return review.attribution_accuracy(*_reviewed(spark, d))


@query
def code_switch_stats(spark: SparkSession, d: str) -> DataFrame:
    return review.code_switch_stats(_reviewed(spark, d)[0])


def _broken(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("session_id") + F.col("idx")
    r = _reviewed(spark, d)[0]
    speaker = F.when(k % 17 == 0, "speaker_01").when(k % 11 == 0, "spk-2").when(k % 13 == 0, "narrator").otherwise(F.col("speaker"))
    return r.withColumns({"segment_id": F.when(k % 19 == 0, "").when(k % 23 == 0, "dup").otherwise(F.col("segment_id")), "speaker": speaker, "reviewed_text": F.when(k % 29 == 0, " ").otherwise(F.col("reviewed_text")), "e_ms": F.when(k % 31 == 0, F.col("s_ms")).otherwise(F.col("e_ms"))})


@query
def review_errors(spark: SparkSession, d: str) -> DataFrame:
    return review.row_errors(_broken(spark, d)).select("session_id", "idx", "speaker", joined("errors"))


def _finalised(spark: SparkSession, d: str) -> DataFrame:
    reviewed, original = _reviewed(spark, d)
    k = F.col("session_id")
    x = review.delivery(reviewed, k % 7 != 0).join(review.attribution_accuracy(reviewed, original), "session_id").join(review.code_switch_stats(reviewed), "session_id")
    x = x.withColumns({"completed": k % 7 != 0, "validation_passed": k % 9 != 0, "review_errors": F.when(k % 7 == 0, F.array(F.lit("review_status_not_completed"))).otherwise(F.array().cast("array<string>"))})
    v = review.verify(x, {"word": 0.9, "speaker": 0.8, "timestamp": 0.7, "code_switch": 0.5})
    return review.finalise(v, k % 4 != 0)


@query
def finalise_status(spark: SparkSession, d: str) -> DataFrame:
    return _finalised(spark, d).select("session_id", "delivery_confidence", joined("verify_reasons"), "passed", "stage", "review_status", "delivery_reason")


@query
def manifest_upsert(spark: SparkSession, d: str) -> DataFrame:
    """All sessions wait for review; rows of those that no longer do replace theirs."""
    old = R.turns(spark, d).select("session_id").distinct().select("session_id", F.lit("review_required").alias("stage"), F.lit("old").alias("row"))
    return review.upsert(old, _finalised(spark, d).where("stage <> 'review_required'").select("session_id", "stage", F.lit("new").alias("row")), ["session_id"])


@query
def status_sync(spark: SparkSession, d: str) -> DataFrame:
    old = R.turns(spark, d).select("session_id").distinct().select("session_id", F.lit("approved").alias("stage"), F.lit("approved").alias("manifest"))
    return review.sync_status(old, _finalised(spark, d).select("session_id", "stage"))


# ---- sources, records, exports ----------------------------------------------------------------------------------


def _listing(spark: SparkSession, d: str) -> DataFrame:
    """Pages as a made-up tree of recordings: language/conversation/speaker/file."""
    k = F.col("page_id")
    lang = F.element_at(F.array(*map(F.lit, ("English", "hindi", "punjabi", "other"))), (k % 4 + 1).cast("int"))
    who = F.element_at(F.array(*map(F.lit, ("Speaker 1", "speaker-2", "spk_1", "misc", "SPK 02"))), (k % 5 + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, ("audio.wav", "s1.wav", "take.mp3", "Speaker_2.wav"))), ((k / 5).cast("long") % 4 + 1).cast("int"))
    rel = F.concat_ws("/", lang, F.concat(F.lit("conv "), ((k / 7).cast("long") % 40).cast("string")), who, name)
    return R.table(spark, d, "pages").select(rel.alias("rel"), F.concat(F.lit("/in/"), rel, F.lit("#"), k.cast("string")).alias("path"), (k * 13 % 997).alias("size"), (k * 7 % 31 / 2.0).alias("duration_s"))


@query
def speaker_file_selection(spark: SparkSession, d: str) -> DataFrame:
    return listing.conversations(_listing(spark, d))


@query
def conversation_folders_report(spark: SparkSession, d: str) -> DataFrame:
    return listing.conversation_report(listing.conversations(_listing(spark, d))).drop("skips")


@query
def user_metadata_precedence(spark: SparkSession, d: str) -> DataFrame:
    s = R.turns(spark, d).select("session_id", "speaker").distinct().withColumn("label", F.concat(F.lit("voice "), (F.col("session_id") % 5).cast("string")))
    m = spark.createDataFrame([("*", {"domain": "sales", "gender": "x", "age": " "}), ("SPEAKER_01", {"gender": " f "}), ("voice 2", {"domain": "travel", "accent": "northern"})], "scope string, values map<string,string>")
    got = transcripts.user_metadata(s, m)
    return got.select("session_id", "speaker", *(F.col("provided")[k].alias(k) for k in ("domain", "gender", "age", "accent")))


@query
def wrapped_fields(spark: SparkSession, d: str) -> DataFrame:
    o = R.table(spark, d, "orders")
    x = record.inferred(F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(F.col("o_orderpriority")), (F.col("o_orderkey") % 100) / 100.0)
    y = record.known_or_inferred(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")), F.col("o_orderpriority"), F.lit(0.9))
    return o.select("o_orderkey", x["value"].alias("inferred"), x["confidence"].alias("confidence"), y["value"].alias("known"), y["source"].alias("source"))


@query
def flatten_record(spark: SparkSession, d: str) -> DataFrame:
    r = record.assemble(quality.tier(_scored(spark, d)).withColumn("punct_skipped", F.lit(None).cast("string")), interaction=interaction.report(R.turns(spark, d)), language=language.report(R.segments(spark, d)))
    flat = record.flatten(record.gate(r)[0])
    return flat.select("session_id", "schema_version", "transcript_raw", "interaction_total_turns", "interaction_overlap_ms", "language_dominant_language", "language_switch_count")


@query
def kaldi_lines(spark: SparkSession, d: str) -> DataFrame:
    return exports.kaldi(R.segments(spark, d)).union(exports.rttm(R.turns(spark, d)))


@query
def ctm_lines(spark: SparkSession, d: str) -> DataFrame:
    return exports.ctm(R.words(spark, d))


@query
def csv_manifest(spark: SparkSession, d: str) -> DataFrame:
    return exports.manifest(R.segments(spark, d)).select("utt_id", "recording_id", "start", "end", "duration", "speaker_id", "language", "text", "snr_db", "quality_tier")


@query
def dataset_card(spark: SparkSession, d: str) -> DataFrame:
    c = exports.card(quality.tier(_scored(spark, d)))
    return c.select("session_id", joined("languages"), "rows")


@query
def vendor_segments(spark: SparkSession, d: str) -> DataFrame:
    """Turns as a vendor's stored responses, read back as segments."""
    w = F.transform(F.split("text", " "), lambda x: F.struct(x.alias("word"), F.lit(0.5).alias("start"), F.lit(0.9).alias("confidence")))
    r = R.turns(spark, d).select((F.col("session_id") * 100 + F.col("idx")).alias("session_id"), F.lit("deepgram").alias("engine"), F.to_json(F.struct(w.alias("words"))).alias("response"))
    return transcripts.vendor_segments(r).select("session_id", "text", "start", "end", F.size("words").alias("n_words"))


@query
def silhouette_cluster(spark: SparkSession, d: str) -> DataFrame:
    e = R.table(spark, d, "embeddings").where("embedding is not null and label is not null")
    windows = e.select(((F.col("label") * 1000) + F.floor(F.col("vec_id") / 100)).cast("long").alias("session_id"), (F.col("vec_id") * 750).cast("double").alias("s_ms"), (F.col("vec_id") * 750 + 1500).cast("double").alias("e_ms"), F.col("embedding").cast("array<double>").alias("embedding"))
    return diarisation.cluster_windows(windows)


@query
def settled_turns(spark: SparkSession, d: str) -> DataFrame:
    w = R.turns(spark, d).select("session_id", "s_ms", "e_ms", "speaker", F.lit(1.0).alias("confidence"))
    return diarisation.fold_turns(w)


@query
def finalise_run(spark: SparkSession, d: str) -> DataFrame:
    """The whole review job: reviews against what the recogniser had."""
    reviewed, original = _reviewed(spark, d)
    k = F.col("session_id")
    second = F.struct((k % 4 == 0).alias("required"), (k % 8 == 0).alias("completed"), F.lit("r2").alias("reviewer_id"), F.lit(0.1).alias("sample_rate"), F.lit(0.9).alias("agreement_score"))
    s = reviewed.select("session_id").distinct().withColumns({"status": F.when(k % 7 != 0, "completed").otherwise("pending"), "reviewer_id": F.lit("r1"), "given_reviewer": F.when(k % 10 != 0, "r1").otherwise("r9"), "validation_passed": k % 9 != 0, "approve": k % 3 != 0, "second_pass": second})
    f = engine.finalise(reviewed, original, s)
    return f.select("session_id", "completed", "passed", "stage", "review_status", "delivery_confidence", joined("verify_reasons"))


@query
def session_records(spark: SparkSession, d: str) -> DataFrame:
    """The whole processing job, as one record a session: every column of the record (reports as JSON, texts by their digest).

    What is not returned is not computed: Spark leaves out the joins of reports that nobody reads.
    """
    turns = materialise(R.turns(spark, d))
    r = engine.run(turns, R.segments_of(turns), R.words_of(turns), shared=materialise)
    texts = ("transcript", "speaker_transcripts", "annotations", "words")
    nested = [f.name for f in r.schema if f.name not in texts and f.dataType.typeName() in ("struct", "array", "map")]
    plain = [c for c in r.columns if c not in (*texts, *nested, "session_id", "stage")]
    head = ("session_id", "stage", F.size("transcript.segments").alias("n_segments"), "interaction.total_turns", "validation.issue_count")
    return r.select(*head, *(F.sha2(F.to_json(c), 256).alias(f"{c}_sha256") for c in texts), *plain, *(F.to_json(c).alias(c) for c in nested))


# ---- relational operations on the star schema -------------------------------------------------------------------


@query
def rollup_revenue(spark: SparkSession, d: str) -> DataFrame:
    li, o, c, n, r = (R.table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    places = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name", "n_name")
    j = li.select("l_orderkey", "l_quantity").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(places, F.col("o_custkey") == F.col("c_custkey"))
    return j.rollup("r_name", "n_name").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))


@query
def asof_latest_order(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's last order at each of their orders' dates, without it: an as-of join by a window over the union."""
    o = R.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return o.select("o_custkey", "o_orderkey", F.lag("o_orderkey").over(w).alias("previous"))


@query
def session_window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events in sessions parted by half an hour."""
    e = R.table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"))
    return s.select("user_id", F.unix_micros("first").alias("first_us"), "n")
