import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.functions import waveform as w
from parlance.operators import classifier, transcripts
from parlance.sources import audio, listing

RATE = 16000


def tone(start, end, total=2.0, hz=220):
    x = np.zeros(int(total * RATE), np.float32)
    k = np.arange(int(start * RATE), int(end * RATE))
    x[k] = 0.3 * np.sin(2 * np.pi * hz * k / RATE)
    return x


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    for name, x in (("s1/a.wav", tone(0.2, 1.0)), ("s1/b.wav", tone(1.1, 1.8)), ("one.wav", tone(0, 2))):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(w.encode_pcm16(x, RATE))
    return str(root)


def test_a_pair_from_files_to_turns(spark, tree):
    pairs = listing.pairs(listing.files(spark, tree))
    chans = audio.pair_channels(pairs, audio.content(spark, tree)).cache()
    assert sorted((r.session_id, r.speaker, r.label) for r in chans.collect()) == [("s1", "SPEAKER_00", "a"), ("s1", "SPEAKER_01", "b")]
    v = {r.speaker: (r.s_ms, r.e_ms) for r in audio.vad(chans).collect()}
    assert abs(v["SPEAKER_00"][0] - 80) < 60 and abs(v["SPEAKER_01"][1] - 1920) < 60
    m = audio.mixes(chans).first()
    assert len(w.unpack(m.waveform)) == 2 * RATE and not m.clipping_prevented
    q = {r.speaker: r for r in audio.quality(chans).collect()}
    assert q["SPEAKER_00"].errors == [] and "high silence ratio" in q["SPEAKER_01"].warnings[0]
    assert audio.aligned(chans).count() == 2


def test_a_late_channel_is_moved(spark):
    rows = [(1, "SPEAKER_00", tone(0.5, 0.7)), (1, "SPEAKER_01", tone(0.6, 0.8))]
    # The same click, 100 ms later.
    a = np.zeros(RATE, np.float32)
    b = np.zeros(RATE, np.float32)
    a[2000:2200], b[3600:3800] = 1, 1
    rows = [(1, "SPEAKER_00", a), (1, "SPEAKER_01", b)]
    d = spark.createDataFrame([(i, s, bytearray(x.tobytes()), RATE) for i, s, x in rows], "session_id long, speaker string, waveform binary, sample_rate int")
    r = audio.aligned(d).where("speaker = 'SPEAKER_01'").first()
    assert r.offset_ms == 100 and r.applied and np.argmax(w.unpack(r.waveform)) == 2000
    silent = d.withColumn("waveform", F.when(F.col("speaker") == "SPEAKER_01", F.lit(np.zeros(RATE, np.float32).tobytes())).otherwise(F.col("waveform")))
    with pytest.raises(Exception, match="unreliable"):
        audio.aligned(silent, fail_unreliable=True).collect()


def test_mono_stands_for_both_sides(spark, tree):
    f = audio.content(spark, tree).where(F.col("path").endswith("one.wav"))
    r = audio.stereo_channels(f).collect()
    assert [x.label for x in r] == ["left", "right"] and all(x.duplicated for x in r)


def test_written_wavs_read_again(spark, tmp_path):
    d = spark.createDataFrame([(1, "SPEAKER_00", bytearray(tone(0, 1).tobytes()), RATE)], "session_id long, speaker string, waveform binary, sample_rate int")
    audio.write_wavs(d, str(tmp_path / "wavs"))
    r = spark.read.parquet(str(tmp_path / "wavs")).first()
    assert r.name == "1/SPEAKER_00.wav" and w.decode_pcm(r.content)[1] == RATE


def test_classifier(spark, tmp_path):
    texts = [("en", t) for t in ("the cat sat", "where are you going", "this is the house", "what time is it now")] + [("hi-Latn", t) for t in ("aap kaise hain", "kya kar rahe ho", "mera naam hai", "bahut accha hai")]
    model = classifier.train(spark.createDataFrame(texts, "label string, text string"))
    classifier.save(model, str(tmp_path / "m"))
    r = classifier.predict(spark.createDataFrame([("where is the cat",), ("aap kya kar rahe hain",)], "text string"), classifier.load(str(tmp_path / "m"))).collect()
    assert [x.lang for x in r] == ["en", "hi-Latn"] and all(abs(sum(x.probabilities.values()) - 1) < 1e-9 for x in r)


def test_speakers_roll_up(spark):
    d = spark.createDataFrame([(1, 0.9, False, ["a"]), (1, 0.7, True, ["b", "a"])], "session_id long, consensus_score double, review_recommended boolean, disagreement_flags array<string>")
    assert tuple(transcripts.roll_up(d).first()) == (1, 0.7, True, ["a", "b"])
    r = spark.createDataFrame([(1, 2, ["en→hi"], ["en", "hi", "en"], 0.4)], "session_id long, switch_count int, patterns array<string>, languages array<string>, switching_score double")
    assert transcripts.code_switch_metadata(r).first().dominant_languages == ["en", "hi"]


def test_waveforms_are_never_broadcast(spark):
    chans = spark.range(3).select(F.col("id").alias("session_id"), F.explode(F.array(F.lit("SPEAKER_00"), F.lit("SPEAKER_01"))).alias("speaker"), w.stepped_noise("id", F.lit(0).cast("long"), F.lit(2000)).alias("waveform"), F.lit(1000).alias("sample_rate"))
    out = audio.aligned(chans)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.offset_ms, r.passed, r.applied) for r in out.collect()] == [(0, True, False)] * 6


def test_samples_are_made_by_all_tasks(spark, sf_dir):
    from parlance.queries_blocks import _samples

    made = _samples(spark, sf_dir)
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20


def test_noise_of_odd_keys():
    for k, p in ((0, 0), (7, 1), (-3, 1), (10**12, 0)):
        got = w.noise_steps(k, p, 450)
        for i in (0, 199, 200, 449):
            step = int(np.fmod(i // 200 + k + p, 4))
            noise = int(np.fmod(k * 131 + i * (i % 97) * 7 + p * 17, 2001)) - 1000
            assert got[i] == np.float32(max(-1.0, min(1.0, noise * (0, 4, 300, 1200)[step] / 1e6)) if step >= 0 else 1.0)


def test_classifier_reads_a_words_ngrams_once(spark):
    """As the stages of pyspark.ml one by one; null, empty and long texts; n-grams are no column of the plan, where each word's were cut anew."""
    texts = [("en", t) for t in ("the cat sat", "where are you going", "this is the house")] + [("hi-Latn", t) for t in ("aap kaise hain", "kya kar rahe ho", "mera naam hai")] + [("x", "zu zo")]
    for kinds in (texts, texts[:6], texts[:3]):
        model = classifier.train(spark.createDataFrame(kinds, "label string, text string"))
        asked = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", "É", "a", "The cat's HOUSE kya", "aap " * 5000 + "the", *["zo kya"] * 70])], "k int, text string")
        got = classifier.predict(asked, model)
        d = asked.withColumn("grams", classifier.char_ngrams(F.col("text")))
        for stage in model.stages[1:]:
            d = stage.transform(d)
        plain = {r.k: r for r in d.collect()}
        labels = model.stages[0].labels
        for r in got.collect():
            assert r.lang == labels[int(plain[r.k].prediction)] and r.score == max(r.probabilities.values())
            assert all(abs(r.probabilities[v] - plain[r.k].probability[j]) < 1e-9 for j, v in enumerate(labels))
        assert "CountVectorizer" not in got._jdf.queryExecution().toString() and "sequence(" not in got._jdf.queryExecution().toString()
