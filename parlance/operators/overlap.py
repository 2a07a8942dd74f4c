"""Overlap regions with their kind, segments beside them, utterances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import lexicons as lex
from .intervals import CELL_MS, overlap_pairs, speaker_overlaps

#: Shortest region, and the length from which one is always crosstalk.
MIN_MS, HARD_MS = 200, 600


def is_backchannel(text: Column, language: Column) -> Column:
    """Whether at least seven in ten words are short answers of the language's profile; no words count as one."""
    words = F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    bare = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[.,!?;:'\"-]+|[.,!?;:'\"-]+$", "")))
    base = F.split(F.lower(F.coalesce(language, F.lit(""))), "-")[0]
    hits = lambda table: F.size(F.filter(bare, lambda w: w.isin(*table)))
    default = lex.BACKCHANNELS["default"]
    count = reduce(lambda rest, kv: F.when(base == kv[0], hits((*default, *lex.BACKCHANNELS[kv[1]]))).otherwise(rest), lex.PROFILES.items(), hits(default))
    return (F.size(words) == 0) | (count >= 0.7 * F.size(words))


def _texts(turns: DataFrame, segments: DataFrame) -> DataFrame:
    """Each turn's text and language: of the first segment that holds its midpoint, else of the last that overlaps it, else none."""
    # a millisecond more at either end brings together what only touches
    s = segments.select("session_id", "s_ms", (F.col("e_ms") + 1).alias("e_ms"), F.col("e_ms").alias("to"), "idx", F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("language", F.lit("")).alias("language")).alias("x"))
    t = turns.select("session_id", "idx", "s_ms", (F.col("e_ms") + 1).alias("e_ms"), F.col("e_ms").alias("to"))
    mid = F.col("l.s_ms") + F.col("l.to")
    holds = (F.col("r.s_ms") * 2 <= mid) & (mid <= F.col("r.to") * 2)
    meets = F.least("l.to", "r.to") > F.greatest("l.s_ms", "r.s_ms")
    pick = F.coalesce(F.min_by(F.when(holds, F.col("r.x")), F.when(holds, F.col("r.idx"))), F.max_by(F.when(meets, F.col("r.x")), F.when(meets, F.col("r.idx"))))
    found = overlap_pairs(t, s, bucket_ms=CELL_MS).where(holds | meets).groupBy(F.col("l.session_id").alias("session_id"), F.col("l.idx").alias("idx")).agg(pick.alias("x"))
    return turns.select("session_id", "idx").join(found, ["session_id", "idx"], "left")


def regions(turns: DataFrame, segments: DataFrame, min_ms: int = MIN_MS) -> DataFrame:
    """session_id, speaker_a, speaker_b, o_start, o_end, dur_ms, overlap_type: short ones in which either side only answers are backchannels."""
    # texts stay behind: a turn travels once for each width of cells
    pairs = speaker_overlaps(turns.select("session_id", "idx", "speaker", "s_ms", "e_ms"), min_ms).select("session_id", F.col("a.idx").alias("ia"), F.col("b.idx").alias("ib"), F.col("a.speaker").alias("speaker_a"), F.col("b.speaker").alias("speaker_b"), "o_start", "o_end", "dur_ms")
    t = _texts(turns.select("session_id", "idx", "s_ms", "e_ms"), segments)
    t = t.select(F.col("session_id").alias("_s"), "idx", is_backchannel(F.col("x.text"), F.col("x.language")).alias("soft"))
    a, b = t.alias("ta"), t.alias("tb")
    j = pairs.join(a, (F.col("session_id") == F.col("ta._s")) & (F.col("ia") == F.col("ta.idx"))).join(b, (F.col("session_id") == F.col("tb._s")) & (F.col("ib") == F.col("tb.idx")))
    soft = (F.col("dur_ms") < HARD_MS) & (F.col("ta.soft") | F.col("tb.soft"))
    return j.select("session_id", "speaker_a", "speaker_b", "o_start", "o_end", "dur_ms", F.when(soft, "backchannel").otherwise("crosstalk").alias("overlap_type"))


def annotate(segments: DataFrame, overlaps: DataFrame) -> DataFrame:
    """segments with overlap, overlap_type, overlap_speakers, overlap_start, overlap_end: of the longest region that meets them, of equals the earliest."""
    o = overlaps.select("session_id", F.col("o_start").alias("s_ms"), F.col("o_end").alias("e_ms"), F.struct("o_start", "o_end", "overlap_type", "speaker_a", "speaker_b").alias("o"))
    j = overlap_pairs(segments.select("session_id", "idx", "s_ms", "e_ms"), o).select("l.session_id", "l.idx", "r.o")
    best = j.groupBy("session_id", "idx").agg(F.max_by("o", F.struct(F.col("o.o_end") - F.col("o.o_start"), -F.col("o.o_start"), -F.col("o.o_end"))).alias("o"))
    out = segments.join(best, ["session_id", "idx"], "left")
    speakers = F.when(F.col("o").isNull(), F.array().cast("array<string>")).otherwise(F.array("o.speaker_a", "o.speaker_b"))
    return out.select(*segments.columns, F.col("o").isNotNull().alias("overlap"), F.col("o.overlap_type").alias("overlap_type"), speakers.alias("overlap_speakers"), F.col("o.o_start").alias("overlap_start"), F.col("o.o_end").alias("overlap_end"))


def adjacent_markers(turns: DataFrame) -> DataFrame:
    """Overlaps between a turn and the one before it: session_id, idx, speaker_a, speaker_b, s_ms, e_ms."""
    w = W.partitionBy("session_id").orderBy("s_ms", "idx")
    t = turns.select("session_id", "idx", "speaker", "s_ms", "e_ms", F.lag("e_ms").over(w).alias("_e"), F.lag("speaker").over(w).alias("_spk"))
    return t.where((F.col("s_ms") < F.col("_e")) & (F.col("speaker") != F.col("_spk"))).select("session_id", "idx", F.col("_spk").alias("speaker_a"), F.col("speaker").alias("speaker_b"), "s_ms", F.least("e_ms", "_e").alias("e_ms"))


def utterances(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """Each turn with the text, first language and mean quality of the rows that overlap it: utterance_id, session_id, speaker, s_ms, e_ms, text, language, quality."""
    pairs = overlap_pairs(turns, rows, bucket_ms=CELL_MS)
    key = [F.col("l.session_id").alias("session_id"), F.col("l.idx").alias("idx"), F.col("l.speaker").alias("speaker"), F.col("l.s_ms").alias("s_ms"), F.col("l.e_ms").alias("e_ms")]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r.idx", F.trim("r.text").alias("t")))), lambda x: x["t"]), " ")
    out = pairs.groupBy(*key).agg(text.alias("text"), F.min_by("r.language", "r.idx").alias("language"), F.avg("r.quality_score").alias("quality"))
    uid = F.concat_ws("_", F.col("session_id").cast("string"), "speaker", F.lpad(F.col("s_ms").cast("string"), 8, "0"), F.lpad(F.col("e_ms").cast("string"), 8, "0"))
    return out.select(uid.alias("utterance_id"), "session_id", "speaker", "s_ms", "e_ms", "text", "language", "quality")
