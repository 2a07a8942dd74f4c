"""Transcripts of a session: merged speakers, rolled-up consensus, forced alignment, plain projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge_speakers(segments: DataFrame) -> DataFrame:
    """Segments of separately recognised speakers as one transcript, in order of (s_ms, e_ms), numbered anew."""
    order = W.partitionBy("session_id").orderBy("s_ms", "e_ms", "speaker", "idx")
    return segments.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))


def header(segments: DataFrame) -> DataFrame:
    """Per session: language of the surest segment (of equals the first), its confidence, the last end, the text."""
    said = F.length(F.trim("text")) > 0
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said, F.struct("idx", F.trim("text").alias("t"))))), lambda x: x["t"]), " ")
    return segments.groupBy("session_id").agg(F.max_by("language", F.struct("quality_score", -F.col("idx"))).alias("language"), F.max("quality_score").alias("language_probability"), F.max("e_ms").alias("duration_ms"), text.alias("text"))


def roll_up(consensus: DataFrame) -> DataFrame:
    """Per session, of its speakers' consensus: the lowest score, whether any needs review, all flags once."""
    flags = F.array_sort(F.array_distinct(F.flatten(F.collect_list("disagreement_flags"))))
    return consensus.groupBy("session_id").agg(F.min("consensus_score").alias("consensus_score"), F.bool_or("review_recommended").alias("review_recommended"), flags.alias("disagreement_flags"))


def forced_alignment(segments: DataFrame, alignment: DataFrame) -> DataFrame:
    """segments with an aligner's times where it has some, by place; the rest stay. alignment: session_id, place, a_s_ms, a_e_ms."""
    w = W.partitionBy("session_id").orderBy("idx")
    placed = segments.withColumn("place", F.row_number().over(w) - 1)
    j = placed.join(alignment, ["session_id", "place"], "left")
    return j.withColumns({"aligned": F.col("a_s_ms").isNotNull(), "s_ms": F.coalesce("a_s_ms", "s_ms"), "e_ms": F.coalesce("a_e_ms", "e_ms")}).drop("a_s_ms", "a_e_ms", "place")


def code_switch_metadata(report: DataFrame) -> DataFrame:
    """detected, confidence, dominant languages once each, count and patterns. Needs switch_count, patterns, languages, switching_score."""
    return report.select(
        "session_id",
        (F.col("switch_count") > 0).alias("detected"),
        F.round(F.coalesce("switching_score", F.lit(0.0)), 4).alias("confidence"),
        F.array_distinct(F.filter("languages", lambda x: x.isNotNull() & (x != ""))).alias("dominant_languages"),
        "switch_count",
        "patterns",
        (F.col("switch_count") > 0).alias("review_required"),
    )


def timeline(turns: DataFrame) -> DataFrame:
    """Turns as a time line in seconds, 3 places."""
    return turns.select("session_id", "idx", "speaker", F.round(F.col("s_ms") / 1000.0, 3).alias("start"), F.round(F.col("e_ms") / 1000.0, 3).alias("end"), F.round((F.col("e_ms") - F.col("s_ms")) / 1000.0, 3).alias("duration"))


def speaker_texts(segments: DataFrame) -> DataFrame:
    """Each speaker's text, in order."""
    said = segments.where(F.length(F.trim("text")) > 0)
    return said.groupBy("session_id", "speaker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.trim("text").alias("t")))), lambda x: x["t"]), " ").alias("text"))
