"""Recordings as DataFrames: channels of pairs, stereo and mono files, aligned, mixed and measured.

A session's channels meet by one join or aggregate on session_id; waveforms
travel as packed float32, and only where a kernel needs them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..functions import waveform as w
from . import listing

MIXED = t.StructType([t.StructField("waveform", t.BinaryType()), t.StructField("peak_before", t.DoubleType()), t.StructField("peak_after", t.DoubleType()), t.StructField("clipping_prevented", t.BooleanType())])


def content(spark: SparkSession, root: str) -> DataFrame:
    """path and content of the audio files below root; join a listing first, so that only chosen files are read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content").where(listing.suffix(F.col("path")).isin(*listing.AUDIO))


def channels(chosen: DataFrame, files: DataFrame) -> DataFrame:
    """chosen (session_id, speaker, label, path) with waveform, sample_rate and what the header says of the source."""
    d = chosen.join(files, "path").withColumn("d", w.decode("content"))
    return d.select("session_id", "speaker", "label", "path", "d.waveform", F.lit(w.TARGET_RATE).alias("sample_rate"), F.col("d.sample_rate").alias("source_rate"), F.col("d.channels").alias("source_channels"), F.col("d.bits").alias("source_bits")).where("waveform is not null")


def pair_channels(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """Channels of listing.pairs(): SPEAKER_00 and SPEAKER_01 with the files' labels."""
    each = F.explode(F.array(*(F.struct(F.lit(f"SPEAKER_0{k}").alias("speaker"), F.col(f"label_{k + 1}").alias("label"), F.col(f"path_{k + 1}").alias("path")) for k in (0, 1))))
    return channels(pairs.select(F.col("session").alias("session_id"), each.alias("c")).select("session_id", "c.*"), files)


def stereo_channels(files: DataFrame) -> DataFrame:
    """A stereo file as a pair, left and right; a mono file's one channel stands twice, marked duplicated."""
    parts = files.withColumn("c", w.channels("content")).where("c is not null").select(listing.stem(F.col("path")).alias("session_id"), "path", F.posexplode(F.slice("c", 1, 2)).alias("k", "waveform"), "c")
    same = F.sha2(F.col("c")[0], 256) == F.sha2(F.col("c")[1], 256)
    return parts.select("session_id", F.format_string("SPEAKER_%02d", "k").alias("speaker"), F.when(F.col("k") == 0, "left").otherwise("right").alias("label"), "path", "waveform", F.lit(w.TARGET_RATE).alias("sample_rate"), same.alias("duplicated"))


@F.pandas_udf(MIXED)
def mix(parts: pd.Series) -> pd.DataFrame:
    rows = []
    for one in parts:
        out, report = w.mix([w.unpack(x) for x in one])
        rows.append((out.tobytes(), report["peak_before"], report["peak_after"], report["clipping_prevented"]))
    return pd.DataFrame(rows, columns=MIXED.names)


def mixes(chans: DataFrame) -> DataFrame:
    """Per session: its channels as one waveform (two to a few channels a session, so their list is short)."""
    m = chans.groupBy("session_id", "sample_rate").agg(F.transform(F.array_sort(F.collect_list(F.struct("speaker", "waveform"))), lambda x: x["waveform"]).alias("p"))
    return m.withColumn("m", mix("p")).select("session_id", "sample_rate", "m.*")


def aligned(chans: DataFrame, fail_unreliable: bool = False) -> DataFrame:
    """chans with the second speaker moved onto the first one's time line where the offset is reliable: and offset_ms, confidence, passed, applied."""
    # Waveforms are never broadcast: Spark takes BINARY for a few bytes a row, however long recordings are.
    a = chans.where("speaker = 'SPEAKER_00'").select("session_id", F.col("waveform").alias("_a")).hint("merge")
    b = chans.where("speaker = 'SPEAKER_01'").join(a, "session_id").withColumn("o", w.offset("_a", "waveform", "sample_rate"))
    if fail_unreliable:
        b = b.withColumn("o", F.when(F.col("o.passed"), F.col("o")).otherwise(F.raise_error(F.concat(F.lit("speaker alignment unreliable: "), F.col("session_id").cast("string")))))
    moved = F.when(F.col("o.passed"), w.shifted("waveform", "o.lag_samples")).otherwise(F.col("waveform"))
    report = lambda df, *c: df.select(*chans.columns, *c)
    second = report(b.withColumn("waveform", moved), F.col("o.offset_ms").alias("offset_ms"), F.col("o.confidence").alias("confidence"), F.col("o.passed").alias("passed"), (F.col("o.passed") & (F.col("o.lag_samples") != 0)).alias("applied"))
    first = report(chans.where("speaker <> 'SPEAKER_01'"), F.lit(0).alias("offset_ms"), F.lit(1.0).alias("confidence"), F.lit(True).alias("passed"), F.lit(False).alias("applied"))
    return first.unionByName(second)


def alignment_report(kind: Column, offset_ms: Column, confidence: Column, passed: Column, applied: Column) -> Column:
    """Struct method, offset_ms, confidence, passed, applied: files of one device need no alignment."""
    fixed = F.struct(F.lit("shared_clock").alias("method"), F.lit(0).alias("offset_ms"), F.lit(1.0).alias("confidence"), F.lit(True).alias("passed"), F.lit(False).alias("applied"))
    found = F.struct(F.lit("cross_correlation").alias("method"), offset_ms.cast("int").alias("offset_ms"), confidence.cast("double").alias("confidence"), passed.alias("passed"), applied.alias("applied"))
    return F.when(kind.isin("stereo", "mono"), fixed).otherwise(found)


def vad(chans: DataFrame) -> DataFrame:
    """Speech of each channel: session_id, speaker, s_ms, e_ms, in order of idx."""
    each = chans.select("session_id", "speaker", F.posexplode(w.speech("waveform", "sample_rate")).alias("idx", "v"))
    return each.select("session_id", "speaker", F.col("idx").cast("long").alias("idx"), F.round(F.col("v.s") * 1000).cast("long").alias("s_ms"), F.round(F.col("v.e") * 1000).cast("long").alias("e_ms"))


def quality(chans: DataFrame, shortest_s: float = 1.0) -> DataFrame:
    """Each channel's measures, with errors and warnings."""
    d = chans.withColumn("m", w.measure("waveform", "sample_rate")).select("session_id", "speaker", "m.*")
    say = lambda c, kind: F.when(c, F.concat_ws(": ", "speaker", F.lit(kind)))
    c, s = F.col("clipping_ratio"), F.col("silence_ratio")
    errors = F.array_compact(F.array(say(F.col("duration_s") < shortest_s, "too short"), say(c >= w.CLIP_FAIL, "heavy clipping"), say(s >= w.SILENCE_FAIL, "mostly silent")))
    warnings = F.array_compact(F.array(say((c >= w.CLIP_WARN) & (c < w.CLIP_FAIL), "mild clipping"), say((s >= w.SILENCE_WARN) & (s < w.SILENCE_FAIL), "high silence ratio")))
    return d.withColumns({"errors": errors, "warnings": warnings})


def write_wavs(chans: DataFrame, path: str) -> None:
    """PCM16 WAV bytes beside their names, a row a file; a store of objects takes them from there."""
    name = F.concat_ws("/", F.col("session_id").cast("string"), F.concat("speaker", F.lit(".wav")))
    chans.select(name.alias("name"), w.wav_bytes("waveform", "sample_rate").alias("content")).write.mode("overwrite").parquet(path)
