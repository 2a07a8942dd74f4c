"""Canonical relations (turns, segments, words, ...) out of the generic tables.

The tables hold no audio, so times and recogniser signals are derived from
identifiers and word counts with integer arithmetic, the same on every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_']+"
WORD = r"[^ \t\n\r\f]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bytes of a batch that goes to a Python worker.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit of an Arrow batch's bytes to ours where it is higher, so that long rows don't come 10,000 at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, idx, speaker, s_ms, e_ms, text, turn: the user's and the assistant's turns."""
    c = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant")).withColumnRenamed("conv_id", "session_id")
    n = F.size(F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), 0))
    # Dealt by the name that later steps group by: they find the rows of a session together and don't shuffle texts again.
    by = W.partitionBy("session_id").orderBy("turn")
    timed = c.select(
        "session_id",
        (F.row_number().over(by) - 1).cast("long").alias("idx"),
        F.when(F.col("role") == "user", "SPEAKER_00").otherwise("SPEAKER_01").alias("speaker"),
        (300 + 40 * F.least(n, F.lit(200))).cast("long").alias("dur"),
        (((F.col("session_id") * 31 + F.col("turn") * 17) % 11 - 4) * 100).alias("gap"),
        "text",
        "turn",
    )
    start = F.coalesce(F.sum(F.col("dur") + F.col("gap")).over(W.partitionBy("session_id").orderBy("idx").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return timed.withColumn("s_ms", start.cast("long")).select("session_id", "idx", "speaker", "s_ms", (F.col("s_ms") + F.col("dur")).alias("e_ms"), "text", "turn")


LANGS = ("en", "hi-Latn", "pa-Latn", "mwr-Latn", "hi")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """turns with recogniser and signal columns, and a language for each segment."""
    return segments_of(turns(spark, sf_dir))


def segments_of(turns: DataFrame) -> DataFrame:
    a, t = F.col("session_id"), F.col("turn")
    return turns.select(
        "session_id",
        "idx",
        "speaker",
        "s_ms",
        "e_ms",
        "text",
        "turn",
        F.element_at(F.array(*map(F.lit, LANGS)), ((a + t * 3) % 5 + 1).cast("int")).alias("language"),
        (-((a * 7 + t * 13) % 100) / 50.0).alias("avg_logprob"),
        (1 + ((a * 3 + t * 5) % 30) / 10.0).alias("compression_ratio"),
        (((a + t * 11) % 50) / 100.0).alias("no_speech_prob"),
        (-50 + (a * 5 + t) % 40).cast("double").alias("rms_db"),
        F.when((a + t) % 5 != 0, ((a * 11 + t * 7) % 35).cast("double")).alias("snr_db"),
        (((a + t) % 200) / 10000.0).alias("clipping_ratio"),
        (((a * 17 + t * 29) % 101) / 100.0).alias("quality_score"),
        F.size(F.regexp_extract_all("text", F.lit(WORD), 0)).cast("long").alias("n_words"),
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, seg_idx, word_idx, speaker, word, ws_ms, we_ms, language: each segment's words with an even share of its time."""
    return words_of(turns(spark, sf_dir))


def words_of(turns: DataFrame) -> DataFrame:
    s = turns.select("session_id", F.col("idx").alias("seg_idx"), "speaker", "s_ms", "e_ms", F.regexp_extract_all("text", F.lit(WORD), 0).alias("w"))
    each = s.select("*", F.size("w").alias("n"), F.posexplode("w").alias("word_idx", "word")).drop("w")
    share = lambda k: (F.col("s_ms") + F.expr(f"(({k}) * (e_ms - s_ms)) div n")).cast("long")
    return each.select("session_id", "seg_idx", F.col("word_idx").cast("long").alias("word_idx"), "speaker", "word", share("word_idx").alias("ws_ms"), share("word_idx + 1").alias("we_ms"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id (the user), speaker (the event type), s_ms, e_ms: events as intervals of `value` minutes, for interval operators at scale."""
    e = table(spark, sf_dir, "events").where("value is not null")
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.select(F.col("user_id").alias("session_id"), F.col("event_type").alias("speaker"), start.alias("s_ms"), (start + F.floor(F.col("value") * 60000).cast("long")).alias("e_ms"), F.col("event_id").alias("idx"))


ENGINES = ("whisper_local", "deepgram", "google")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, engine, idx, s_ms, e_ms, text: each segment as three recognisers might have it."""
    s = turns(spark, sf_dir).select("session_id", "idx", "turn", "s_ms", "e_ms", F.regexp_extract_all("text", F.lit(WORD), 0).alias("w"), "text")
    dropped = F.array_join(F.filter("w", lambda x, i: i % 7 != 6), " ")
    doubled = F.array_join(F.flatten(F.transform("w", lambda x, i: F.when(i % 5 == 4, F.array(x, x)).otherwise(F.array(x)))), " ")
    engine = F.explode(F.array(*(F.struct(F.lit(e).alias("engine"), t.alias("text"), F.lit(k * 40).cast("long").alias("shift")) for k, (e, t) in enumerate(zip(ENGINES, (F.col("text"), F.lower(dropped), doubled), strict=True)))))
    return s.select("session_id", "idx", "turn", "s_ms", "e_ms", engine.alias("c")).select("session_id", "c.engine", "idx", "turn", (F.col("s_ms") + F.col("c.shift")).alias("s_ms"), (F.col("e_ms") + F.col("c.shift")).alias("e_ms"), "c.text")


def engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, engine and its signals in thousandths: conf, word_conf, ts_conf, and switch_count, langs, patterns."""
    per = turns(spark, sf_dir).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    k = F.posexplode(F.array(*map(F.lit, ENGINES))).alias("k", "engine")
    a, j = F.col("session_id"), F.col("k")
    each = per.select("session_id", "n", k)
    return each.select(
        "session_id",
        "engine",
        (500 + (a * 37 + j * 211) % 500).alias("conf"),
        (450 + (a * 53 + j * 97) % 500).alias("word_conf"),
        (300 + (a * 29 + j * 331) % 700).alias("ts_conf"),
        ((a + j * 2) % 4).alias("switch_count"),
        F.slice(F.array(F.lit("en"), F.lit("hi"), F.lit("pa")), 1, ((a + j) % 3 + 1).cast("int")).alias("langs"),
        F.slice(F.array(F.lit("en→hi"), F.lit("hi→en")), 1, ((a + j * 2) % 3).cast("int")).alias("patterns"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, idx, segment_id, what the recogniser had (asr_text, speaker, s_ms, e_ms) and what the reviewer has (reviewed_text, r_speaker, rs_ms, re_ms, unresolved)."""
    t = turns(spark, sf_dir)
    asr = candidates(spark, sf_dir).where("engine = 'deepgram'").select(F.col("session_id").alias("a"), F.col("idx").alias("b"), F.col("text").alias("asr_text"))
    a, k = F.col("session_id"), F.col("turn")
    other = F.when(F.col("speaker") == "SPEAKER_00", "SPEAKER_01").otherwise("SPEAKER_00")
    shift = ((a * 7 + k * 3) % 5) * 100
    return t.join(asr, (F.col("session_id") == F.col("a")) & (F.col("idx") == F.col("b"))).select(
        "session_id",
        "idx",
        F.format_string("%d_%04d", "session_id", "idx").alias("segment_id"),
        "speaker",
        "s_ms",
        "e_ms",
        "asr_text",
        F.col("text").alias("reviewed_text"),
        F.when((a + k) % 13 == 0, other).otherwise(F.col("speaker")).alias("r_speaker"),
        (F.col("s_ms") + shift).alias("rs_ms"),
        (F.col("e_ms") + shift).alias("re_ms"),
        F.when((a * 3 + k) % 17 == 0, F.array(F.lit("code_switch"))).otherwise(F.array().cast("array<string>")).alias("unresolved"),
    )
