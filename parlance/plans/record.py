"""Dataset records: one nested row per session, wrapped fields, flat rows, schema rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA_VERSION = "3.0.0"
STAGES = ("approved", "reviewed", "review_required", "rejected", "generated", "not_evaluated")


def inferred(value: Column, confidence: Column, threshold: float = 0.5) -> Column:
    """Struct value, confidence, source: blank or doubtful values are `uncertain`."""
    clean = F.nullif(F.trim(F.coalesce(value.cast("string"), F.lit(""))), F.lit(""))
    score = F.round(confidence.cast("double"), 3)
    sure = clean.isNotNull() & (clean != "unknown") & (score >= threshold)
    return F.struct(F.when(sure, clean).otherwise("uncertain").alias("value"), score.alias("confidence"), F.lit("inferred").alias("source"))


def provided(value: Column, source: str = "user_provided") -> Column:
    clean = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    return F.struct(F.when(clean == "", "unknown").otherwise(clean).alias("value"), F.lit(1.0).alias("confidence"), F.lit(source).alias("source"))


def measured(value: Column, confidence: Column, method: str, source: str = "measured") -> Column:
    return F.struct(value.alias("value"), F.round(confidence.cast("double"), 3).alias("confidence"), F.lit(source).alias("source"), F.lit(method).alias("method"))


def known_or_inferred(given: Column, value: Column, confidence: Column) -> Column:
    """What people said where they did, else the inference."""
    return F.when(F.trim(F.coalesce(given, F.lit(""))) != "", provided(given)).otherwise(inferred(value, confidence))


def products(requested: Column, output_mode: Column) -> Column:
    """Requested products and those that the output mode implies, each once, in order."""
    extra = F.when(output_mode == "both", F.array(F.lit("mono_mixed"), F.lit("speaker_separated"))).when(output_mode.isin("mono_mixed", "speaker_separated"), F.array(output_mode)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(requested, extra))


def source_info(channels: DataFrame) -> DataFrame:
    """Per session, of its files (rate, codec, container): the one value, else the largest rate and `mixed`."""
    one = lambda c: F.when(F.countDistinct(c) == 1, F.min(c)).when(F.countDistinct(c) > 1, "mixed").alias(c)
    return channels.groupBy("session_id").agg(F.max("rate").alias("rate"), one("codec"), one("container"), F.count(F.lit(1)).alias("channels"))


def segment_struct() -> Column:
    """A segment as it stands in a record; times to 3 places, scores to 4."""
    missing = F.array_compact(F.array(F.when(F.col("punct_skipped").isNotNull(), "punctuation"), F.when(F.col("snr_db").isNull(), "snr_db"), F.when(F.col("confidence").isNull(), "confidence")))
    return F.struct(
        F.col("idx"),
        F.format_string("%s_%04d", F.col("session_id").cast("string"), "idx").alias("segment_id"),
        F.col("speaker").alias("speaker_id"),
        F.round(F.col("s_ms") / 1000.0, 3).alias("start"),
        F.round(F.col("e_ms") / 1000.0, 3).alias("end"),
        "text",
        "language",
        F.round("quality_score", 4).alias("quality_score"),
        F.round("snr_db", 2).alias("snr_db"),
        "snr_band",
        F.round("confidence", 4).alias("confidence"),
        "confidence_band",
        "quality_tier",
        "review_reasons",
        "flagged_for_review",
        missing.alias("missing_fields"),
    )


def assemble(segments: DataFrame, **reports: DataFrame) -> DataFrame:
    """One record per session: its segments in order, transcripts, and each report (one row per session_id) as a struct of its name.

    All inputs are keyed by session_id, so one hash partitioning serves every join.
    """
    said = F.length(F.trim("text")) > 0
    base = segments.groupBy("session_id").agg(
        F.array_sort(F.collect_list(segment_struct())).alias("segments"),
        F.array_sort(F.collect_list(F.when(said, F.struct("idx", "speaker", F.trim("text").alias("text"))))).alias("_said"),
    )
    raw = F.array_join(F.transform("_said", lambda x: x["text"]), " ")
    who = F.array_distinct(F.transform("_said", lambda x: x["speaker"]))
    own = F.map_from_entries(F.transform(who, lambda s: F.struct(s.alias("key"), F.array_join(F.transform(F.filter("_said", lambda x: x["speaker"] == s), lambda x: x["text"]), " ").alias("value"))))
    out = base.select("session_id", F.lit(SCHEMA_VERSION).alias("schema_version"), F.struct(raw.alias("raw"), "segments").alias("transcript"), own.alias("speaker_transcripts"))
    for name, df in reports.items():
        out = out.join(df.select("session_id", F.struct(*[c for c in df.columns if c != "session_id"]).alias(name)), "session_id", "left")
    return out


def flatten(records: DataFrame) -> DataFrame:
    """A flat row for each record: fields of structs as struct_field, arrays, maps and nested structs as JSON strings."""
    cols: list[Column] = []
    for f in records.schema.fields:
        kind = f.dataType.typeName()
        if kind == "struct":
            for g in f.dataType.fields:
                c = F.col(f"{f.name}.{g.name}")
                cols.append((F.to_json(c) if g.dataType.typeName() in ("array", "map", "struct") else c).alias(f"{f.name}_{g.name}" + ("_json" if g.dataType.typeName() in ("array", "map", "struct") else "")))
        else:
            cols.append(F.to_json(f.name).alias(f"{f.name}_json") if kind in ("array", "map") else F.col(f.name))
    return records.select(*cols)


def preview(records: DataFrame, chars: int = 2000, parts: int = 12) -> DataFrame:
    return records.select("session_id", F.substring("transcript.raw", 1, chars).alias("transcript"), F.slice("transcript.segments", 1, parts).alias("segments"))


def schema_errors(records: DataFrame) -> DataFrame:
    """records with errors: broken rules as structs path, message, the deepest path first. Needs schema_version, session_id, transcript; others are checked where they are."""
    rule = lambda c, path, message: F.when(F.coalesce(c, F.lit(True)), F.struct(F.lit(path).alias("path"), F.lit(message).alias("message")))
    rules = [
        rule(F.col("schema_version") != SCHEMA_VERSION, "schema_version", "version"),
        rule(F.trim(F.col("session_id").cast("string")) == "", "session_id", "empty"),
        rule(F.col("transcript.segments").isNull(), "transcript.segments", "required"),
        rule(F.exists("transcript.segments", lambda s: F.coalesce(s["segment_id"], F.lit("")) == ""), "transcript.segments.segment_id", "empty"),
        rule(F.exists("transcript.segments", lambda s: s["end"] < s["start"]), "transcript.segments.end", "before start"),
    ]
    if "delivery" in records.columns:
        rules.append(rule(~F.col("delivery.stage").isin(*STAGES), "delivery.stage", "unknown"))
    deep = lambda a, b: F.when(F.size(F.split(a["path"], r"\.")) > F.size(F.split(b["path"], r"\.")), -1).when(F.size(F.split(a["path"], r"\.")) < F.size(F.split(b["path"], r"\.")), 1).when(a["path"] < b["path"], -1).otherwise(1)
    return records.withColumn("errors", F.array_sort(F.array_compact(F.array(*rules)), deep))


def gate(records: DataFrame, hard: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sound, quarantined) records; with hard, reading a quarantined one raises its first error."""
    checked = schema_errors(records)
    sound = checked.where(F.size("errors") == 0).drop("errors")
    bad = checked.where(F.size("errors") > 0)
    if hard:
        first = F.concat(F.col("errors")[0]["path"], F.lit(": "), F.col("errors")[0]["message"], F.lit(" ("), F.size("errors").cast("string"), F.lit(" errors)"))
        sound = checked.withColumn("_ok", F.when(F.size("errors") > 0, F.raise_error(first)).otherwise(F.lit(True))).where("_ok").drop("errors", "_ok")
    return sound, bad


def delivery(records: DataFrame) -> DataFrame:
    """Delivery stage at processing time: what needs review waits for it, the rest is generated. Needs review_required."""
    return records.withColumn("stage", F.when(F.col("review_required"), "review_required").otherwise("generated"))


def config_hash(settings: dict) -> str:
    import hashlib
    import json

    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()
