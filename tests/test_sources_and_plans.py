import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.functions import waveform as w
from parlance.operators import diarisation
from parlance.plans import engine, exports, record
from parlance.sources import listing, relations, transcripts


def tree(spark, *paths):
    return spark.createDataFrame([(p, "/in/" + p, 100, 1.0) for p in paths], "rel string, path string, size long, duration_s double")


def test_messy_folders(spark):
    f = tree(
        spark,
        "english/1/Speaker 1/a.wav", "english/1/Speaker 2/b.wav", "English/2/sPk_1/audio.wav", "English/2/SPEAKER-2/audio.wav",
        "hinglish/output/x.wav", "hindi/1/Speaker 1/a.wav", "hindi/3/a.mp3", "hindi/4/noise.wav", "french/1/s1.wav",
    )
    r = {(x.language, x.conversation): (x.conversation_id, x.reason, x.code) for x in listing.conversations(f).collect()}
    assert r[("english", "1")] == ("conversation_0001", None, "en") and r[("english", "2")] == ("conversation_0002", None, "en")
    assert r[("hindi", "1")][1] == "missing_speaker_2" and r[("hindi", "3")][1] == "unsupported_audio_format" and r[("hindi", "4")][1] == "missing_speaker_pair"
    assert not any(k[0] in ("hinglish", "french") for k in r)
    rep = {x.language: (x.valid, x.skipped) for x in listing.conversation_report(listing.conversations(f)).collect()}
    assert rep == {"english": (2, 0), "hindi": (0, 3)}


def test_the_best_file_of_a_speaker_stands(spark):
    f = spark.createDataFrame([("english/1/x/spk1.wav", "/p1", 10, 1.0), ("english/1/speaker1/long.wav", "/p2", 99, 9.0), ("english/1/s2.wav", "/p3", 10, 1.0)], "rel string, path string, size long, duration_s double")
    x = listing.conversations(f).first()
    assert (x.path_1, x.path_2) == ("/p1", "/p3")


def test_pairs(spark):
    f = tree(spark, "s1/a.wav", "s1/b.wav", "s2/A/x.wav", "s2/B/y.wav", "s3/one.wav", "__MACOSX/a.wav", "__MACOSX/b.wav")
    r = {x.session: (x.label_1, x.path_2) for x in listing.pairs(f).collect()}
    assert r == {"s1": ("a", "/in/s1/b.wav"), "s2": ("A", "/in/s2/B/y.wav")}
    root = listing.pairs(tree(spark, "a.wav", "b.wav", "s1/a.wav", "s1/b.wav")).collect()
    assert len(root) == 1 and root[0].label_2 == "b"
    assert listing.input_kind(0, 0, 0, 2) == "mono"
    with pytest.raises(ValueError):
        listing.input_kind(0, 0, 0, 0)


def test_studio_folders(spark):
    good = json.dumps({k: "x" for k in listing.STUDIO_KEYS} | {"conversation_id": "c1", "scripted": False})
    d = spark.createDataFrame([("c1", good, 1, 1, 48000, 44100, 16, 16, "wav", "flac"), ("c2", None, 1, 2, 48000, 48000, 8, 16, "wav", "wav")], "conversation_id string, metadata string, n_1 int, n_2 int, rate_1 int, rate_2 int, bits_1 int, bits_2 int, ext_1 string, ext_2 string")
    r = {x.conversation_id: x for x in listing.studio_check(d).collect()}
    assert r["c1"].errors == [] and r["c1"].warnings == ["speaker_2_flac", "speaker_2_sample_rate"]
    assert r["c2"].errors == ["metadata_required", "speaker_2_file", "speaker_1_bit_depth"]


def test_vendor_responses(spark):
    rows = [
        (1, json.dumps({"utterances": [{"transcript": "hi", "start": 0.0, "end": 1.0, "words": [{"word": "hi", "start": 0.1}]}]})),
        (2, json.dumps({"words": [{"word": "a", "punctuated_word": "A.", "start": 0.0, "end": 0.5}, {"word": " "}], "transcript": "a"})),
        (3, json.dumps({"transcript": "only text"})),
        (4, "{}"),
    ]
    s = transcripts.vendor_segments(spark.createDataFrame([(i, "deepgram", r) for i, r in rows], "session_id long, engine string, response string"))
    r = {x.session_id: x for x in s.collect()}
    assert r[1].words[0].end == 0.1 and r[2].text == "a" and r[2].words[0].text == "A." and (r[3].start, r[3].end) == (0.0, 0.0) and 4 not in r
    st = {x.session_id: x.timed_share for x in transcripts.candidate_stats(s).collect()}
    assert st == {1: 1.0, 2: 1.0, 3: 0.0}


def test_later_metadata_wins(spark):
    s = spark.createDataFrame([(1, "SPEAKER_00", "Asha")], "session_id long, speaker string, label string")
    m = spark.createDataFrame([("*", {"domain": "sales", "gender": "x"}), ("SPEAKER_00", {"gender": "f", "age": " "}), ("Asha", {"domain": "travel"})], "scope string, values map<string,string>")
    assert transcripts.user_metadata(s, m).first().provided == {"domain": "travel", "gender": "f"}


def test_wrapped_fields(spark):
    r = spark.range(1).select(record.inferred(F.lit("indoor"), F.lit(0.71)).alias("a"), record.inferred(F.lit("male"), F.lit(0.28)).alias("b"), record.provided(F.lit("female")).alias("c"), record.measured(F.lit(7300), F.lit(0.94), "spectral_rolloff_95").alias("d")).first()
    assert (r.a.value, r.b.value, r.c.source, r.d.value, r.d.source) == ("indoor", "uncertain", "user_provided", 7300, "measured")


def test_a_run_makes_records_that_pass_the_schema(spark, sf_dir):
    t, s, ws = (f(spark, sf_dir) for f in (relations.turns, relations.segments, relations.words))
    few = t.select("session_id").distinct().orderBy("session_id").limit(3)
    t, s, ws = (x.join(few, "session_id", "left_semi") for x in (t, s, ws))
    r = engine.run(t, s, ws, engine.Config.of({"output-mode": "both", "require_human_review": "true", "unknown": 1})).cache()
    assert r.count() == 3 and {x.stage for x in r.collect()} == {"review_required"}
    sound, bad = record.gate(r)
    assert sound.count() == 3 and bad.count() == 0
    broken = r.withColumn("schema_version", F.lit("99.0"))
    assert record.gate(broken)[1].first().errors[0].message == "version"
    with pytest.raises(Exception, match="version"):
        record.gate(broken, hard=True)[0].collect()
    flat = record.flatten(r)
    assert flat.count() == 3 and "transcript_segments_json" in flat.columns and "interaction_total_turns" in flat.columns
    assert exports.product(r, "stt").count() == 3 and exports.product(r, "nothing").count() == 0
    assert record.preview(r).count() == 3


def test_export_lines(spark):
    s = spark.createDataFrame([("phase 4", 0, "SPEAKER_00", 0, 2000, "hello\tworld", "en-IN", "gold")], "session_id string, idx long, speaker string, s_ms long, e_ms long, text string, language string, quality_tier string")
    lines = {x.file: x.line for x in exports.kaldi(s).collect()}
    assert lines["utt2lang"] == "SPEAKER_00-phase_4-0000 en-IN" and lines["segments"] == "SPEAKER_00-phase_4-0000 phase_4 0.000 2.000" and lines["text"].endswith("hello world")
    assert set(lines) == {"segments", "text", "utt2spk", "utt2dur", "utt2lang", "spk2utt", "wav.scp"}
    assert exports.rttm(s).first().line == "SPEAKER phase_4 1 0.000 2.000 <NA> <NA> SPEAKER_00 <NA> <NA>"
    ws = spark.createDataFrame([("phase 4", "hello", 0, 1000)], "session_id string, word string, ws_ms long, we_ms long")
    assert exports.ctm(ws).first().line == "phase_4 1 0.000 1.000 hello 1.000"
    assert exports.card(s).first().tiers == {"gold": 1} and tuple(exports.manifest(s).columns) == exports.MANIFEST


def test_waveforms(spark, tmp_path):
    rate = 16000
    a, b = np.zeros(rate, np.float32), np.zeros(rate, np.float32)
    a[2000:2200], b[2400:2600] = 1, 1
    got = w.estimate_offset(a, b, rate)
    assert got["passed"] and got["lag_samples"] == 400
    assert np.argmax(w.shift(b, got["lag_samples"])) == np.argmax(a)
    assert not w.estimate_offset(a, np.zeros(rate, np.float32), rate)["passed"]
    assert w.snr_table(np.ones(rate, np.float32), rate, [(0, 1), (0, 0.4)])["snr_reason"].tolist() == ["clipped", "short_segment"]
    assert w.silence_ratio(np.zeros(0), rate) == 1.0 and w.clipping_ratio(np.ones(4)) == 1.0
    speech = np.concatenate([np.zeros(rate), np.sin(np.arange(rate) / 10), np.zeros(rate)]).astype(np.float32)
    (s, e), = w.energy_vad(speech, rate)
    assert abs(s - 0.88) < 0.05 and abs(e - 2.12) < 0.05
    d = spark.createDataFrame([(bytearray(w.encode_pcm16(speech, rate)),), (bytearray(b"no sound"),)], "content binary").select(w.decode("content").alias("x")).select("x.*")
    rows = d.collect()
    assert rows[0].sample_rate == rate and np.allclose(w.unpack(rows[0].waveform), speech, atol=1e-3) and rows[1].waveform is None
    m = d.where("waveform is not null").select(w.measure("waveform", "sample_rate").alias("m"), w.speech("waveform", "sample_rate").alias("v"), F.length(w.clip_span(F.col("waveform"), F.col("sample_rate"), F.lit(0.5), F.lit(1.0))).alias("n")).first()
    assert abs(m.m.duration_s - 3) < 1e-6 and len(m.v) == 1 and m.n == 8000 * 4
    mixed, report = w.mix([np.ones(10, np.float32), np.ones(10, np.float32)])
    assert report["peak_after"] <= 0.98 and len(mixed) == 10


def test_turns_are_settled():
    out = diarisation.settle([(0, 1500, "A", 1.0), (750, 2250, "B", 0.5), (2300, 2400, "B", 0.7)])
    assert out == [(0, 1125, "A", 1.0), (1125, 2400, "B", 0.6)]
    assert [x[2] for x in diarisation.absorb([(0, 3000, "A", 1.0), (3000, 3500, "C", 1.0), (3500, 9000, "B", 1.0), (9000, 12000, "A", 1.0), (12000, 15000, "B", 1.0)])] == ["A", "B", "A", "B"]


def test_windows_are_clustered(spark):
    rng = np.random.default_rng(0)
    rows = [(1, i * 750.0, i * 750.0 + 1500, (np.array([1.0, 0]) if i < 6 else np.array([0, 1.0])) + rng.normal(0, 0.02, 2)) for i in range(12)]
    d = spark.createDataFrame([(a, b, c, v.tolist()) for a, b, c, v in rows], "session_id long, s_ms double, e_ms double, embedding array<double>")
    labelled = diarisation.cluster_windows(d)
    assert [x.speaker for x in labelled.orderBy("s_ms").collect()] == ["SPEAKER_00"] * 6 + ["SPEAKER_01"] * 6
    assert diarisation.fold_turns(labelled).count() == 2
