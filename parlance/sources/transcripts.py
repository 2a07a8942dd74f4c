"""Recognisers' results and people's metadata as tables.

Recognisers are sources: a function from sessions to a candidates table. None
calls a network; a vendor's responses are read where they were stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "word: string, punctuated_word: string, text: string, start: double, end: double, confidence: double, probability: double, language: string"
RESPONSE = f"struct<utterances: array<struct<transcript: string, text: string, start: double, end: double, confidence: double, language: string, words: array<struct<{WORD}>>>>, words: array<struct<{WORD}>>, transcript: string, text: string, confidence: double>"

CandidateSource = Callable[[SparkSession, DataFrame], DataFrame]
SOURCES: dict[str, CandidateSource] = {}


def register(engine: str, source: CandidateSource) -> None:
    """Offer a recogniser's results under a name."""
    SOURCES[engine] = source


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.option("multiLine", "true").json(path)


def vendor_words(words: Column) -> Column:
    """Words with text: punctuated, else plain; blanks go, a missing end is the start."""
    text = lambda w: F.trim(F.coalesce(w["punctuated_word"], w["word"], w["text"]))
    kept = F.filter(F.coalesce(words, F.array().cast(f"array<struct<{WORD}>>")), lambda w: F.coalesce(text(w), F.lit("")) != "")
    return F.transform(kept, lambda w: F.struct(text(w).alias("text"), F.coalesce(w["start"], F.lit(0.0)).alias("start"), F.coalesce(w["end"], w["start"], F.lit(0.0)).alias("end"), F.coalesce(w["confidence"], w["probability"], F.lit(1.0)).alias("probability")))


def vendor_segments(responses: DataFrame) -> DataFrame:
    """Segments of stored responses (session_id, engine, response: JSON): utterances; else all words as one; else the text alone at 0-0."""
    r = responses.withColumn("r", F.from_json("response", RESPONSE))
    seg = lambda text, start, end, conf, words: F.struct(text.alias("text"), start.cast("double").alias("start"), end.cast("double").alias("end"), conf.cast("double").alias("confidence"), words.alias("words"))
    words = vendor_words(F.col("r.words"))
    utterances = F.transform("r.utterances", lambda u: seg(F.coalesce(u["transcript"], u["text"], F.lit("")), F.coalesce(u["start"], F.lit(0.0)), F.coalesce(u["end"], u["start"], F.lit(0.0)), u["confidence"], vendor_words(u["words"])))
    whole = F.coalesce("r.transcript", "r.text", F.lit(""))
    one = F.array(seg(F.when(whole == "", F.array_join(F.transform(words, lambda w: w["text"]), " ")).otherwise(whole), F.element_at(words, 1)["start"], F.element_at(words, -1)["end"], F.col("r.confidence"), words))
    text = F.array(seg(whole, F.lit(0.0), F.lit(0.0), F.col("r.confidence"), words))
    parts = F.when(F.size("r.utterances") > 0, utterances).when(F.size(words) > 0, one).when(whole != "", text)
    return r.select("session_id", "engine", F.posexplode(parts).alias("idx", "s")).select("session_id", "engine", "idx", "s.*")


def offset_seconds(seconds: Column, nanos: Column) -> Column:
    return F.coalesce(seconds, F.lit(0)).cast("double") + F.coalesce(nanos, F.lit(0)) / 1e9


def candidate_stats(segments: DataFrame) -> DataFrame:
    """Per session and engine: mean word probability (else mean confidence), mean confidence, share of segments with words."""
    p = F.flatten(F.collect_list(F.transform("words", lambda w: w["probability"])))
    out = segments.groupBy("session_id", "engine").agg(p.alias("p"), F.avg("confidence").alias("confidence"), F.avg(F.when(F.size("words") > 0, 1.0).otherwise(0.0)).alias("timed_share"))
    mean = F.aggregate("p", F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size("p"), F.lit(0))
    return out.select("session_id", "engine", F.coalesce(mean, "confidence").alias("word_confidence"), "confidence", "timed_share")


def clean_metadata(block: Column) -> Column:
    """A map of strings without blank values, trimmed."""
    return F.map_filter(F.transform_values(F.coalesce(block, F.create_map().cast("map<string,string>")), lambda _, v: F.trim(v)), lambda _, v: F.coalesce(v, F.lit("")) != "")


def user_metadata(speakers: DataFrame, metadata: DataFrame) -> DataFrame:
    """speakers (session_id, speaker, label) with what people said of them: for all (`*`), for the speaker, for the label; later ones win.

    metadata: scope and values (a map); few rows, but joined by key, not broadcast by force.
    """
    m = metadata.select("scope", clean_metadata(F.col("values")).alias("v"))
    none = F.create_map().cast("map<string,string>")
    out = speakers
    for k, key in enumerate((F.lit("*"), F.col("speaker"), F.col("label"))):
        part = m.select(F.col("scope").alias(f"_s{k}"), F.col("v").alias(f"_v{k}"))
        out = out.join(part, key == F.col(f"_s{k}"), "left")
    pairs = lambda c: F.map_entries(F.coalesce(c, none))
    all_ = F.concat(pairs("_v0"), pairs("_v1"), pairs("_v2"))
    keys = F.array_distinct(F.transform(all_, lambda e: e["key"]))
    last = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(all_, lambda e: e["key"] == k), -1)["value"].alias("value")))
    return out.select(*speakers.columns, F.map_from_entries(last).alias("provided"))
