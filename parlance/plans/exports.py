"""Exports: Kaldi, RTTM and CTM lines, CSV, data-set rows and card, products, manifests, review packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ascii_id, collapse

# The columns of a flat segment manifest, in order.
MANIFEST = ("utt_id", "recording_id", "segment_id", "audio_filepath", "start", "end", "duration", "speaker_id", "language", "text", "text_normalized", "sample_rate", "snr_db", "snr_band", "confidence", "confidence_band", "quality_tier", "matrix_language", "cs_density", "flagged_for_review")
PRODUCTS = ("stt", "tts_export", "diarisation", "evaluation_gold")


def seconds(ms: Column) -> Column:
    """Milliseconds as seconds with three places, without floating point."""
    return F.concat(F.floor(ms / 1000).cast("string"), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))


def rows(segments: DataFrame) -> DataFrame:
    """segments with utt_id, recording_id and speaker_ascii."""
    sid, spk = ascii_id(F.col("session_id").cast("string")), ascii_id(F.coalesce("speaker", F.lit("SPEAKER_00")))
    return segments.withColumns({"recording_id": sid, "speaker_ascii": spk, "utt_id": F.concat_ws("-", spk, sid, F.lpad(F.col("idx").cast("string"), 4, "0"))})


def kaldi(segments: DataFrame) -> DataFrame:
    """(recording_id, file, line) of segments, text, utt2spk, utt2dur, utt2lang, spk2utt and wav.scp; sort a file's lines by bytes, Spark's own order of strings."""
    r = rows(segments)
    text = collapse(F.coalesce("text", F.lit("")))
    line = lambda file, *parts: F.struct(F.lit(file).alias("file"), F.concat_ws(" ", *parts).alias("line"))
    each = F.array_compact(
        F.array(
            line("segments", "utt_id", "recording_id", seconds(F.col("s_ms")), seconds(F.col("e_ms"))),
            F.when(text != "", line("text", "utt_id", text)),
            line("utt2spk", "utt_id", "speaker_ascii"),
            line("utt2dur", "utt_id", seconds(F.greatest(F.lit(0), F.col("e_ms") - F.col("s_ms")))),
            line("utt2lang", "utt_id", F.coalesce("language", F.lit("und"))),
        )
    )
    per = r.select("recording_id", F.explode(each).alias("x")).select("recording_id", "x.file", "x.line")
    spk = r.groupBy("recording_id", "speaker_ascii").agg(F.array_join(F.array_sort(F.collect_list("utt_id")), " ").alias("u")).select("recording_id", F.lit("spk2utt").alias("file"), F.concat_ws(" ", "speaker_ascii", "u").alias("line"))
    audio = F.coalesce("audio_filepath", F.lit("")) if "audio_filepath" in segments.columns else F.lit("")
    wav = r.groupBy("recording_id").agg(F.min(audio).alias("a")).select("recording_id", F.lit("wav.scp").alias("file"), F.concat_ws(" ", "recording_id", "a").alias("line"))
    return per.union(spk).union(wav)


def rttm(turns: DataFrame) -> DataFrame:
    sid = ascii_id(F.col("session_id").cast("string"))
    return turns.select(sid.alias("recording_id"), F.lit("rttm").alias("file"), F.concat_ws(" ", F.lit("SPEAKER"), sid, F.lit("1"), seconds(F.col("s_ms")), seconds(F.col("e_ms") - F.col("s_ms")), F.lit("<NA> <NA>"), "speaker", F.lit("<NA> <NA>")).alias("line"))


def ctm(words: DataFrame) -> DataFrame:
    sid = ascii_id(F.col("session_id").cast("string"))
    token = collapse(F.coalesce("word", F.lit("")))
    conf = F.format_string("%.3f", F.col("probability")) if "probability" in words.columns else F.lit("1.000")
    return words.where(token != "").select(sid.alias("recording_id"), F.lit("ctm").alias("file"), F.concat_ws(" ", sid, F.lit("1"), seconds(F.col("ws_ms")), seconds(F.greatest(F.lit(0), F.col("we_ms") - F.col("ws_ms"))), token, conf).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines as text, a folder for each file and recording, sorted within it."""
    lines.repartition("file", "recording_id").sortWithinPartitions("file", "recording_id", "line").write.mode("overwrite").partitionBy("file", "recording_id").text(path)


def manifest(segments: DataFrame) -> DataFrame:
    """The flat manifest; columns that segments lack are null."""
    r = rows(segments).withColumns({"start": F.col("s_ms") / 1000.0, "end": F.col("e_ms") / 1000.0, "duration": (F.col("e_ms") - F.col("s_ms")) / 1000.0, "speaker_id": F.col("speaker")})
    return r.select(*(F.col(c) if c in r.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST))


def write_manifest(segments: DataFrame, path: str) -> None:
    m = manifest(segments)
    for name, sep in (("csv", ","), ("tsv", "\t")):
        m.write.mode("overwrite").option("header", "true").option("sep", sep).option("escape", '"').csv(f"{path}/{name}")


def dataset_rows(segments: DataFrame) -> DataFrame:
    r = manifest(segments)
    return r.select(F.struct(F.col("audio_filepath").alias("path")).alias("audio"), F.col("recording_id").alias("session_id"), F.col("utt_id").alias("utterance_id"), F.col("speaker_id").alias("speaker"), "language", F.col("text").alias("transcription"), F.col("text_normalized").alias("transcription_normalized"), "start", "end", "duration", "snr_db", "snr_band", "quality_tier", F.col("confidence").alias("confidence_score"), "confidence_band", F.col("cs_density").alias("code_switch_density"))


def card(segments: DataFrame) -> DataFrame:
    """Per session: sorted languages, rows, rows of each tier."""
    tiers = segments.groupBy("session_id", F.coalesce("quality_tier", F.lit("unknown")).alias("t")).agg(F.count(F.lit(1)).alias("c")).groupBy("session_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "c")))).alias("tiers"))
    return segments.groupBy("session_id").agg(F.array_sort(F.collect_set(F.coalesce("language", F.lit("und")))).alias("languages"), F.count(F.lit(1)).alias("rows")).join(tiers, "session_id")


def product(records: DataFrame, name: str) -> DataFrame:
    """One product's document for each record that lists it in dataset_products; unknown names give none."""
    fields = {
        "stt": ("input_mode", "transcript", "conversation_transcript", "turns", "language", "code_switch", "human_review", "refinement"),
        "diarisation": ("turns", "overlap_markers", "refinement", "input_alignment", "premium_processing"),
        "evaluation_gold": ("transcript", "candidates", "consensus", "routing", "refinement", "human_review", "quality_targets", "validation", "premium_processing"),
        "tts_export": ("tts", "human_review"),
    }
    if name not in fields:
        return records.select("session_id").where("false")
    out = records.where(F.array_contains("dataset_products", name)) if "dataset_products" in records.columns else records
    cols = [F.col(c) for c in fields[name] if c in records.columns]
    if name == "tts_export" and {"tts", "human_review", "conversation_transcript"} <= set(records.columns):
        ok = F.col("tts.eligible") & F.col("human_review.status").isin("approved", "corrected")
        cols.append(F.when(ok, F.col("conversation_transcript")).alias("eligible_segments"))
    return out.select("session_id", *cols)


def write_records(records: DataFrame, path: str, kind: str = "parquet") -> None:
    """json, jsonl or parquet (snappy)."""
    writer = records.write.mode("overwrite")
    writer.option("compression", "snappy").parquet(path) if kind == "parquet" else writer.json(path)


def manifests(records: DataFrame) -> dict[str, DataFrame]:
    """Delivery manifests: review_required, approved and final_transcripts, as filters of one table. Needs stage."""
    return {"review_required": records.where("stage in ('review_required', 'reviewed')"), "approved": records.where("stage = 'approved'"), "rejected": records.where("stage = 'rejected'"), "final_transcripts": records}


def review_package(segments: DataFrame, candidates: DataFrame, consensus: DataFrame) -> dict[str, DataFrame]:
    """candidates, consensus and an empty review for each session: rows to fill in, with reasons."""
    template = segments.select("session_id", "idx", F.format_string("%s_%04d", F.col("session_id").cast("string"), "idx").alias("segment_id"), "speaker", "s_ms", "e_ms", F.col("text").alias("asr_text"), F.col("text").alias("reviewed_text"), "language", F.col("review_reasons"), F.array().cast("array<string>").alias("resolved"), F.array().cast("array<string>").alias("unresolved"))
    return {"candidates": candidates, "consensus": consensus, "review_template": template}


def swap_in(df: DataFrame, path: str, tag: str) -> str:
    """Write a table beside its earlier version: a plan may read the one while it writes the other."""
    to = f"{path.rstrip('/')}/v={tag}"
    df.write.mode("overwrite").parquet(to)
    return to
