import pytest
from pyspark.sql import functions as F

from parlance.functions import text as T
from parlance.operators import language, quality, speakers


def one(spark, value, *cols, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(*cols).first()


@pytest.mark.parametrize("raw,clean", [("Hello, World!", "hello world"), ("[Music] hello", "music hello"), ("नमस्ते दुनिया", "नमस्ते दुनिया")])
def test_normalised(spark, raw, clean):
    assert one(spark, raw, T.normalised(F.col("t")))[0] == clean


def test_marks_part_devanagari_tokens(spark):
    assert len(one(spark, "नमस्ते", T.tokens(F.col("t")))[0]) > 1


def test_nfc(spark):
    assert one(spark, "é", T.nfc("t"))[0] == "é"


@pytest.mark.parametrize("text,lang", [("नमस्ते जी", "hi"), ("म्हारो घर", "mwr"), ("ਸਤ ਸ੍ਰੀ", "pa"), ("aap kaise hain", "hi-Latn"), ("tusi kiven ho", "pa-Latn"), ("plain words only", "en"), ("", "en")])
def test_segment_language(spark, text, lang):
    assert one(spark, text, language.segment_language(F.col("t")).alias("x"))[0]["lang"] == lang


def test_english_articles_count_as_hindi_only_on_demand(spark):
    s = "the main log of the day"
    assert one(spark, s, language.segment_language(F.col("t"), legacy=True).alias("x"))[0]["lang"] == "hi-Latn"
    assert one(spark, s, language.segment_language(F.col("t")).alias("x"))[0]["lang"] == "en"


def words(spark, *ws):
    return spark.createDataFrame([(1, 0, i, w) for i, w in enumerate(ws)], "session_id long, seg_idx long, word_idx long, word string").withColumn("lang", language.word_language(F.col("word"), F.lit("en"))["lang"])


def test_switch_points(spark):
    w = words(spark, "hello", "namaste", "hai")
    p = language.switch_points(w).collect()
    assert [(x.word_idx, x.to_lang, x.switch_type) for x in p] == [(1, "hi-Latn", "intra_sentential")]
    m = language.matrix_language(w).first()
    assert m.matrix_language == "hi-Latn" and m.cs_density > 1
    assert [x.switch_type for x in language.switch_points(words(spark, "go", "hai", "now")).orderBy("word_idx").collect()][0] == "tag"
    assert language.switch_points(words(spark, "now.", "hai", "nahi")).first().switch_type == "inter_sentential"


def test_punctuation_is_parted(spark):
    w = spark.createDataFrame([(1, 0, 0, "hello"), (1, 0, 1, "world"), (1, 1, 0, "नमस्ते"), (1, 2, 0, "...")], "session_id long, seg_idx long, word_idx long, word string")
    s = spark.createDataFrame([(1, 0, "hello world", "en"), (1, 1, "नमस्ते", "hi"), (1, 2, "...", "fr")], "session_id long, idx long, text string, language string")
    out = {(x.seg_idx, x.word_idx): (x.text, x.trailing_punct, x.punct_skipped) for x in language.punctuate(w, s).collect()}
    assert out[(0, 1)] == ("world", ".", None) and out[(0, 0)] == ("hello", "", None)
    assert out[(1, 0)][2] == "hindi_model_unavailable" and out[(2, 0)] == ("...", "...", "unsupported_language")


def test_distances(spark):
    d = spark.createDataFrame([(["a", "b", "c"], ["a", "x", "c", "d"]), ([], ["a"]), (["a"], ["a"]), ([], [])], "a array<string>, b array<string>")
    assert [x[0] for x in d.select(T.word_edit_distance("a", "b")).collect()] == [2, 1, 0, 0]
    assert [x[0] for x in d.select(T.bag_overlap(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 1.0, 1.0]
    assert [x[0] for x in d.select(T.sequence_similarity("a", "b")).collect()][3] == 1.0


SEG = "session_id long, idx long, s_ms long, e_ms long, snr_db double, clipping_ratio double"


def test_short_segments_inherit_their_snr(spark):
    d = spark.createDataFrame([(1, 0, 0, 1000, 25.0, 0.0), (1, 1, 0, 300, None, 0.0), (1, 2, 0, 900, None, 0.0), (1, 3, 0, 100, None, 0.1), (2, 0, 0, 100, None, 0.0)], SEG)
    r = {(x.session_id, x.idx): (x.snr_db, x.snr_band, x.snr_reason) for x in quality.annotate_snr(d).collect()}
    assert r[(1, 1)] == (25.0, "high", "short_segment_inherited") == r[(1, 3)]
    assert r[(1, 2)] == (None, "low", "unreliable_estimate") and r[(2, 0)] == (None, "low", "short_segment")


def test_tiers_and_queue(spark):
    d = spark.createDataFrame(
        [(1, "s0", "gold", 0.9, [], "high", False), (1, "s1", "silver", 0.6, [], "low", False), (1, "s2", "gold", 0.9, [], "high", True)],
        "session_id long, segment_id string, confidence_band string, confidence double, confidence_reasons array<string>, snr_band string, overlap boolean",
    ).withColumns({"audio_filepath": F.lit("a.wav"), "s_ms": F.lit(0), "e_ms": F.lit(1)})
    t = quality.tier(d)
    assert [x.quality_tier for x in t.orderBy("segment_id").collect()] == ["gold", "bronze", "silver"]
    assert {x.segment_id for x in quality.review_queue(t).collect()} == {"s1", "s2"}
    assert quality.tier_histogram(t).first().asDict() == {"session_id": 1, "gold": 1, "silver": 1, "bronze": 1}


def test_intents_and_domain(spark):
    assert one(spark, "Hello, I need help with payment", speakers.intents(F.col("t")))[0] == ["greeting", "support_inquiry", "transaction"]
    assert one(spark, "The doctor is in", speakers.domain(F.col("t"), F.lit(True)).alias("x"))[0]["value"] == "healthcare"
    assert one(spark, "", speakers.intents(F.col("t")))[0] == ["informational"]


def test_keywords_break_ties_by_first_sight(spark):
    d = spark.createDataFrame([("k", 0, "beta alpha beta 123 the of"), ("k", 1, "alpha gamma")], "k string, idx long, text string")
    assert [(x.keyword, x.n) for x in speakers.keywords(d, "k").orderBy("rank").collect()] == [("beta", 2), ("alpha", 2), ("gamma", 1)]
