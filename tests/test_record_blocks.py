"""Aliases, manifests, tags and notes of records: what is absent, null or of another script."""

from pyspark.sql import functions as F

from parlance import lexicons as lex
from parlance.functions import text as T
from parlance.plans import blocks


def test_tags(spark):
    df = spark.createDataFrame([("hi",), ("HI",), ("hi-Latn",), ("xx",), ("",), (None,)], "code string")
    assert [r[0] for r in df.select(T.bcp47(F.col("code"), lex.BCP47)).collect()] == ["hi-Deva", "HI", "hi-Latn", "xx", "", ""]


def test_notes_of_combining_marks(spark):
    note = "punctuation_normalisation_applied_for_comparison"
    df = spark.createDataFrame([("हिन्दी",), ("घर",), ("a_b 1",), ("a.b",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(blocks.normalisation_notes(F.col("t"), F.split("t", " "))).collect()]
    assert [note in n for n in got] == [True, False, False, True, False, False]


def test_interaction_aliases(spark):
    whole = spark.createDataFrame([(1, 4, None, {"A": 1.0}), (2, None, 3, None)], "session_id long, total_turns long, interruption_count long, dominance map<string,double>")
    got = [r.asDict() for r in blocks.interaction_aliases(whole).collect()]
    assert [(r["turn_count"], r["interruptions"], r["overlap_duration"], r["avg_response_latency"], r["speaker_dominance"]) for r in got] == [(4, 0, 0.0, None, {"A": 1.0}), (0, 3, 0.0, None, {})]
    bare = blocks.interaction_aliases(whole.select("session_id", F.lit(9).alias("turn_count"))).first()
    assert (bare.turn_count, bare.interruptions, bare.speaker_dominance) == (9, 0, {})


def test_language_aliases(spark):
    schema = "k int, s array<struct<start:double,end:double,language:string,confidence:double>>"
    rows = [(1, [(0.0, 1.00049, "en", 0.91239), (1.0, 2.0, None, None), (2.0, None, "", 0.0), (3.0, 4.0, "en", 1.0), (4.0, 5.0, "unknown", 1.0)]), (2, []), (3, [(None, None, "hi", None)])]
    got = {r.k: r.v for r in spark.createDataFrame(rows, schema).select("k", blocks.language_aliases(F.col("s"), 0.8).alias("v")).collect()}
    assert [tuple(x) for x in got[1].segments] == [(0.0, 1.0, "en", 0.912), (1.0, 2.0, "unknown", 0.8), (2.0, 0.0, "unknown", 0.5), (3.0, 4.0, "en", 1.0), (4.0, 5.0, "unknown", 1.0)]
    assert (got[1].switch_count, got[1].patterns) == (3, ["en→unknown", "unknown→en"])
    assert (got[2].segments, got[2].switch_count, got[2].patterns) == ([], 0, [])
    assert [tuple(x) for x in got[3].segments] == [(0.0, 0.0, "hi", 0.8)]
    assert got[3].switch_count == 0


def test_a_manifests_types_do_not_depend_on_the_columns_there_are(spark):
    bare = blocks.conversation_manifest(spark.createDataFrame([("s1",)], "session_id string"), "/a/")
    full = blocks.conversation_manifest(spark.createDataFrame([(7, True, 3, "m.wav")], "session_id int, multilingual_flag boolean, turn_count int, mono_wav string"))
    assert bare.schema.simpleString() == full.schema.simpleString()
    assert len(bare.columns) == 21
    r, s = bare.first(), full.first()
    assert (r.session, r.multilingual, r.mono_audio_path, r.annotation_path, r.turn_count) == ("s1", False, "", "/a/s1.json", None)
    assert (s.session, s.multilingual, s.mono_audio_path, s.annotation_path, s.turn_count) == ("7", True, "m.wav", "7.json", 3)


def test_a_failed_back_end_is_replaced(spark):
    df = spark.createDataFrame([("pyannote", True), ("pyannote", None), ("kmeans", True)], "b string, f boolean")
    assert [r[0] for r in df.select(blocks.diarisation_status(F.col("b"), F.col("f"))).collect()] == ["kmeans_fallback", "pyannote", "kmeans"]
