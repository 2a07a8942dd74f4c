from pyspark.sql import functions as F

from parlance.operators import consensus, gates, review

CAND = "session_id long, engine string, idx long, s_ms long, e_ms long, text string"
SIG = "session_id long, engine string, conf double, word_conf double, ts_conf double, switch_count int, switching_score double, langs array<string>, patterns array<string>"


def chosen(spark, *engines):
    c = spark.createDataFrame([(1, e, 0, 0, 1000, t) for e, t, *_ in engines], CAND)
    s = spark.createDataFrame([(1, e, conf, conf, ts, sw, 0.0, langs, []) for e, _, conf, ts, sw, langs in engines], SIG)
    return consensus.choose(c, s).first()


def test_best_single_engine(spark):
    r = chosen(spark, ("whisper_local", "hello there", 0.52, 0.45, 0, ["en"]), ("deepgram", "hello there", 0.92, 0.96, 0, ["en"]), ("google", "yellow there", 0.61, 0.90, 0, ["en"]))
    assert r.selected_engine == "deepgram" and r.strategy == "best_single_engine"


def test_merged(spark):
    r = chosen(spark, ("deepgram", "hello namaste", 0.88, 0.72, 1, ["en", "hi"]), ("google", "hello namaste", 0.85, 0.96, 1, ["en", "hi"]))
    assert r.strategy == "merged_consensus" and r.text_engine == "deepgram" and r.timing_engine == "google"


def test_code_switch_disagreement_is_flagged(spark):
    r = chosen(spark, ("deepgram", "hello namaste", 0.86, 0.9, 3, ["en", "hi"]), ("google", "hello namaste", 0.84, 0.9, 0, ["en"]))
    assert "strong_code_switch_disagreement" in r.disagreement_flags and r.selected_engine == "deepgram"


def test_one_candidate(spark):
    r = chosen(spark, ("whisper_local", "hello", 0.5, 0.4, 0, ["en"]))
    assert r.selected_engine == "whisper_local" and r.review_recommended and r.consensus_score == 0.5


def test_routing(spark):
    c = spark.createDataFrame([(1, "outdoor", "high", 0.32, 0.5, 0.4, 0.5, 1.0, "normal")], "session_id long, recording_condition string, noise_level string, mean_quality double, low_ratio double, word_timestamp_ratio double, switch_density double, overlap_s double, review_priority string")
    r = consensus.route(c, "premium_accuracy", True).first()
    assert r.should_escalate and r.reasons[:2] == ["outdoor_audio", "high_noise"]
    assert not consensus.route(c, "premium_accuracy", False).first().should_escalate


def test_gate_without_consensus_fails(spark):
    d = spark.createDataFrame([(None, None, True, 0.7, 1.0)], "consensus_score double, timestamp_confidence double, code_switch_detected boolean, code_switch_confidence double, speaker_confidence double")
    r = gates.accuracy_gate(d).first()
    assert not r.gate_passed and set(r.gate_reasons) == {"estimated_word_accuracy_below_target", "estimated_timestamp_accuracy_below_target", "estimated_code_switch_accuracy_below_target"}


def test_validation_codes(spark):
    d = spark.range(1).selectExpr("0 audio_errors", "0 audio_warnings", "1 segment_count", "0.0D low_ratio", "1 speech_count", "1 turn_count", "0.0D clipping_ratio", "cast(null as string) requested_backend", "cast(null as string) effective_backend", "false align_applied", "false align_passed", "0.31D align_confidence", "0.0D mismatch_s", "60.0D mismatch_limit_s", "1.24D peak_before", "0.8D expected_overlap_s", "0.0D observed_overlap_s", "120.0D duration_s")
    r = gates.validation(d, alignment_required=True).first()
    assert {"alignment_not_applied", "low_alignment_confidence", "mono_mix_clipping", "missing_expected_overlap", "suspiciously_low_turn_count"} <= {i["code"] for i in r.issues}
    assert r.passed


ROW = "session_id long, idx long, segment_id string, speaker string, s_ms long, e_ms long, reviewed_text string, asr_text string, language string, review_reasons array<string>, unresolved array<string>"


def rows(spark, **change):
    base = [
        dict(session_id=1, idx=0, segment_id="c_1", speaker="SPEAKER_00", s_ms=0, e_ms=2000, reviewed_text="hello world", asr_text="hello word", language="en", review_reasons=[], unresolved=[]),
        dict(session_id=1, idx=1, segment_id="c_2", speaker="SPEAKER_01", s_ms=2100, e_ms=3000, reviewed_text="reply", asr_text="reply", language="en", review_reasons=[], unresolved=[]),
    ]
    base[0].update(change)
    return spark.createDataFrame([tuple(r.values()) for r in base], ROW)


def errors(df):
    return [e for r in review.row_errors(df).orderBy("idx").collect() for e in r.errors]


def test_speaker_names(spark):
    for given, name in (("spk1", "SPEAKER_00"), ("speaker_1", "SPEAKER_00"), ("speaker_2", "SPEAKER_01"), ("Spk-01", "SPEAKER_01")):
        assert review.row_errors(rows(spark, speaker=given)).where("idx = 0").first().speaker == name
    assert errors(rows(spark, speaker="speaker_01"))[0] == "ambiguous_speaker_alias:speaker_01"
    mapped = rows(spark, speaker="speaker_01").withColumn("speaker_map", F.create_map(F.lit("SPEAKER_01"), F.lit("speaker_01")))
    assert errors(mapped) == []


def test_row_errors(spark):
    assert errors(rows(spark)) == []
    assert errors(rows(spark, reviewed_text=" ")) == ["c_1_empty_reviewed_text"]
    assert errors(rows(spark, segment_id="c_2")) == ["segment_2_duplicate_segment_id"]
    assert errors(rows(spark, s_ms=9000, e_ms=9500)) == ["c_2_segments_not_sorted"]
    assert errors(rows(spark, e_ms=0)) == ["c_1_end_not_after_start"]


def test_metrics(spark):
    r = review.error_rates(rows(spark)).first()
    assert (r.ref_words, r.word_errors, r.char_errors) == (3, 1, 1)
    shifted = rows(spark, s_ms=1000, e_ms=3000)
    a = review.attribution_accuracy(shifted, rows(spark)).first()
    assert a.speaker_accuracy == 1.0 and a.timestamp_accuracy == 0.5
    assert review.code_switch_stats(rows(spark)).first().code_switch_accuracy == 0.99
    assert review.code_switch_stats(rows(spark, unresolved=["code_switch"])).first().code_switch_accuracy == 0.0


def finalised(spark, df=None, status="completed", reviewer="r1", valid=True, approve=True, second=None):
    from parlance.plans import engine

    s = spark.createDataFrame([(1, status, reviewer, "r1", valid, approve, second or (False, False, None, 0.0, None))], "session_id long, status string, reviewer_id string, given_reviewer string, validation_passed boolean, approve boolean, second_pass struct<required: boolean, completed: boolean, reviewer_id: string, sample_rate: double, agreement_score: double>")
    return engine.finalise(df if df is not None else rows(spark), rows(spark), s).first()


def test_delivery_states(spark):
    assert finalised(spark).stage == "approved"
    assert finalised(spark, approve=False).stage == "reviewed"
    bad = finalised(spark, rows(spark, reviewed_text=""), approve=False)
    assert bad.stage == "review_required" and not bad.passed
    r = finalised(spark, valid=False)
    assert r.stage == "rejected" and "validation_failed" in r.verify_reasons
    assert finalised(spark, reviewer="other").stage == "rejected"
    late = finalised(spark, rows(spark, s_ms=1000, e_ms=2050))
    assert late.stage == "rejected" and "verified_timestamp_accuracy_below_target" in late.verify_reasons
    assert finalised(spark, rows(spark, unresolved=["code_switch"])).stage == "rejected"


def test_second_pass(spark):
    assert finalised(spark, second=(True, False, None, 0.0, None)).stage == "rejected"
    assert "second_pass_sample_rate_missing" in finalised(spark, second=(True, True, "r2", 0.0, None)).verify_reasons
    assert "second_pass_agreement_score_invalid" in finalised(spark, second=(True, True, "r2", 0.1, 1.5)).verify_reasons
    assert finalised(spark, second=(True, True, "r2", 0.1, 0.9)).stage == "approved"


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "session_id long, stage string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "session_id long, stage string")
    once = review.upsert(old, new, ["session_id"])
    twice = review.upsert(once, new, ["session_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    state = spark.createDataFrame([(1, "rejected", "rejected")], "session_id long, stage string, manifest string")
    moved = review.sync_status(state, spark.createDataFrame([(1, "approved")], "session_id long, stage string"))
    assert [tuple(r) for r in moved.collect()] == [(1, "approved", "approved")]
    assert review.delete(old, new, ["session_id"]).count() == 1
