"""Intervals in integer milliseconds: unions, islands, overlap joins and point lookups.

Interval tables have the columns session_id, s_ms and e_ms, and mostly speaker
and idx (their place in the original order, which breaks ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def islands(df: DataFrame, key: list[str], gap_ms: int, strict: bool = False) -> DataFrame:
    """df with column island: runs, in order of start, whose next start lies within gap_ms of the largest end so far (strict: less than it)."""
    w = W.partitionBy(*key).orderBy("s_ms", "e_ms")
    before = F.max("e_ms").over(w.rowsBetween(W.unboundedPreceding, -1))
    apart = (F.col("s_ms") - before >= gap_ms) if strict else (F.col("s_ms") - before > gap_ms)
    opened = df.withColumn("_new", F.when(before.isNull() | apart, 1).otherwise(0))
    return opened.withColumn("island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def union(df: DataFrame, key: list[str] = ["session_id"], gap_ms: int = 0) -> DataFrame:
    """Disjoint intervals that cover the same time; those within gap_ms (0: touching) are one."""
    return islands(df, key, gap_ms).groupBy(*key, "island").agg(F.min("s_ms").alias("s_ms"), F.max("e_ms").alias("e_ms")).drop("island")


def merge_and_pad(df: DataFrame, total: Column, key: list[str] = ["session_id", "speaker"], gap_ms: int = 300, pad_ms: int = 120) -> DataFrame:
    """Speech intervals merged over short gaps, then padded within 0..total; padded neighbours may overlap."""
    merged = union(df, key, gap_ms)
    return merged.select(*key, F.greatest(F.lit(0).cast("long"), F.col("s_ms") - pad_ms).alias("s_ms"), F.least(total, F.col("e_ms") + pad_ms).alias("e_ms"))


#: Widths of the cells of time in which intervals are compared; an interval longer than the last lies in several of those.
CELLS_MS = tuple(60_000 * 64**k for k in range(4))

#: One width for words, segments and turns, which are short and carry texts: each then travels once or twice.
CELL_MS = 300_000


def _touched(side: str, width: Column | int) -> Column:
    """Numbers of the cells of that width that an interval touches."""
    s, e = F.col(f"{side}.s_ms"), F.col(f"{side}.e_ms")
    return F.sequence(F.floor(s / width), F.floor(F.greatest(s, e) / width))


def _cells(df: DataFrame, side: str) -> DataFrame:
    """df once for each cell in which it may meet the other side: as the longer of a pair (_who is its side) in cells as
    wide as it is long, and as the shorter in all wider ones. Among equals the left side counts as the longer."""
    long = F.col(f"{side}.e_ms") - F.col(f"{side}.s_ms")
    own = F.array(F.lit(0), *(F.when(long > w, k + 1) for k, w in enumerate(CELLS_MS[:-1])))
    above = F.filter(F.sequence(F.lit(0), F.lit(len(CELLS_MS) - 1)), lambda k: (k > F.col("_own")) if side == "l" else (k >= F.col("_own")))
    spots = F.concat(F.array(F.struct(F.lit(side).alias("who"), F.col("_own").alias("level"))), F.transform(above, lambda k: F.struct(F.lit("r" if side == "l" else "l").alias("who"), k.alias("level"))))
    out = df.withColumn("_own", F.array_max(own)).withColumn("_at", F.explode(spots)).select(*df.columns, "_at.who", "_at.level")
    out = out.withColumn("_w", F.element_at(F.array(*(F.lit(w) for w in CELLS_MS)), F.col("level") + 1))
    return out.withColumn("_c", F.explode(_touched(side, F.col("_w"))))


def overlap_pairs(left: DataFrame, right: DataFrame, on: Column | None = None, key: str = "session_id", bucket_ms: int | None = None) -> DataFrame:
    """Rows (l, r) of one session whose intervals share time, with o_start, o_end. Rows without a key or a time meet nothing.

    Only intervals of the same cell of time are compared, so that a session of any length parts over all tasks. Cells are
    as wide as the longer interval of a pair or up to 64 times wider: an interval lies in one or two cells of each width.
    bucket_ms asks for cells of that one width instead. A pair counts in the cell where its overlap begins.
    """
    timed = F.col("s_ms").isNotNull() & F.col("e_ms").isNotNull()
    a = left.where(timed).select(F.col(key).alias("_k"), F.struct("*").alias("l"))
    b = right.where(timed).select(F.col(key).alias("_k2"), F.struct("*").alias("r"))
    start = F.greatest("l.s_ms", "r.s_ms")
    cond = (F.col("_k") == F.col("_k2")) & (F.col("l.s_ms") < F.col("r.e_ms")) & (F.col("r.s_ms") < F.col("l.e_ms"))
    if bucket_ms:
        a, b = a.withColumn("_c", F.explode(_touched("l", bucket_ms))), b.withColumn("_c2", F.explode(_touched("r", bucket_ms)))
        cond = cond & (F.col("_c") == F.col("_c2")) & (F.floor(start / bucket_ms) == F.col("_c"))
    else:
        a = _cells(a, "l")
        b = _cells(b, "r").select("_k2", "r", F.col("who").alias("_who2"), F.col("level").alias("_level2"), F.col("_c").alias("_c2"))
        cond = cond & (F.col("who") == F.col("_who2")) & (F.col("level") == F.col("_level2")) & (F.col("_c") == F.col("_c2")) & (F.floor(start / F.col("_w")) == F.col("_c"))
    pairs = a.join(b, cond if on is None else cond & on)
    return pairs.select("l", "r", start.alias("o_start"), F.least("l.e_ms", "r.e_ms").alias("o_end"))


def in_order(turns: DataFrame) -> DataFrame:
    """turns with ord: their place by start, ties as they came."""
    return turns.withColumn("ord", F.row_number().over(W.partitionBy("session_id").orderBy("s_ms", "idx")))


def speaker_overlaps(turns: DataFrame, min_ms: int, bucket_ms: int | None = None) -> DataFrame:
    """Overlaps of at least min_ms between turns of different speakers: session_id, a, b (turns), o_start, o_end, dur_ms."""
    t = in_order(turns)
    pairs = overlap_pairs(t, t, (F.col("l.ord") < F.col("r.ord")) & (F.col("l.speaker") != F.col("r.speaker")), bucket_ms=bucket_ms)
    return pairs.select(F.col("l.session_id").alias("session_id"), F.col("l").alias("a"), F.col("r").alias("b"), "o_start", "o_end", (F.col("o_end") - F.col("o_start")).alias("dur_ms")).where(F.col("dur_ms") >= min_ms)


def pairwise_overlap(df: DataFrame, left: str, right: str) -> DataFrame:
    """Milliseconds that two speakers' intervals share, per session (pairs are summed, not united)."""
    pairs = overlap_pairs(df.where(F.col("speaker") == left), df.where(F.col("speaker") == right))
    return pairs.groupBy(F.col("l.session_id").alias("session_id")).agg(F.sum(F.col("o_end") - F.col("o_start")).alias("overlap_ms"))


def turns_from_vad(vad: DataFrame, gap_ms: int = 150, min_ms: int = 80) -> DataFrame:
    """Speaker turns out of per-speaker speech: intervals of at least 1 ms, merged per speaker over gaps up to gap_ms, kept from min_ms on."""
    merged = union(vad.where(F.col("e_ms") - F.col("s_ms") >= 1), ["session_id", "speaker"], gap_ms).where(F.col("e_ms") - F.col("s_ms") >= min_ms)
    order = W.partitionBy("session_id").orderBy("s_ms", "e_ms", "speaker")
    return merged.withColumn("idx", (F.row_number().over(order) - 1).cast("long")).withColumn("confidence", F.lit(1.0))


def sliding_windows(df: DataFrame, width_ms: int = 1500, step_ms: int = 750, tail_ms: int = 50) -> DataFrame:
    """Windows over each interval; short ones stay whole, and a last window covers an end left open by more than tail_ms."""
    length = F.col("e_ms") - F.col("s_ms")
    last = F.floor((length - width_ms) / step_ms).cast("long")
    base = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.struct((F.col("s_ms") + k * step_ms).alias("s"), (F.col("s_ms") + k * step_ms + width_ms).alias("e")))
    tail = F.array(F.struct((F.col("e_ms") - width_ms).alias("s"), F.col("e_ms").alias("e")))
    open_end = length - (last * step_ms + width_ms) > tail_ms
    spans = F.when(length <= width_ms, F.array(F.struct(F.col("s_ms").alias("s"), F.col("e_ms").alias("e")))).when(open_end, F.concat(base, tail)).otherwise(base)
    rest = [c for c in df.columns if c not in ("s_ms", "e_ms")]
    return df.select(*rest, F.explode(spans).alias("w")).select(*rest, F.col("w.s").alias("s_ms"), F.col("w.e").alias("e_ms"))


def as_of(points: DataFrame, steps: DataFrame, at: str, bucket: int) -> DataFrame:
    """points with v: of the session's last step at or before the time `at`; steps have session_id, t and v, one for each t.

    One sorted union in buckets of time, so that a session of any length parts over tasks; what was last before a
    bucket is carried over a summary of one row for each bucket in use. A point without a session, a time or a step gets null.
    """
    number = F.floor(F.col("_t") / bucket)
    here = points.select(F.col("session_id").alias("_s"), F.col(at).cast("long").alias("_t"), F.struct("*").alias("_p"), F.lit(None).cast(steps.schema["v"].dataType).alias("_v"))
    step = steps.select(F.col("session_id").alias("_s"), F.col("t").alias("_t"), F.lit(None).cast(here.schema["_p"].dataType).alias("_p"), F.col("v").alias("_v"))
    rows = here.unionByName(step).withColumn("_b", number)
    per = rows.groupBy("_s", "_b").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_last"))
    before = W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    carried = per.select(F.col("_s").alias("_s2"), F.col("_b").alias("_b2"), F.last("_last", ignorenulls=True).over(before).alias("_carried")).where(F.col("_carried").isNotNull())
    inside = W.partitionBy("_s", "_b").orderBy("_t", F.col("_p").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    found = rows.withColumn("_here", F.last("_v", ignorenulls=True).over(inside)).where(F.col("_p").isNotNull())
    out = found.join(carried, (F.col("_s") == F.col("_s2")) & (F.col("_b") == F.col("_b2")), "left")
    return out.select("_p.*", F.when(F.col("_t").isNotNull(), F.coalesce("_here", "_carried")).alias("v"))


def tiles(turns: DataFrame, closed: bool = False) -> DataFrame:
    """All time of a session, in half milliseconds, as steps session_id, t, v (idx, speaker): from t on, the first turn that
    holds a time, else the nearest, of equally near ones the first. First is by start, then by idx. A turn that ends before it
    starts is a moment at its start; one without a time or a session is left out.
    """
    w = W.partitionBy("session_id").orderBy("s_ms", "idx")
    end = F.greatest("s_ms", "e_ms")
    timed = turns.where(F.col("session_id").isNotNull() & F.col("s_ms").isNotNull() & F.col("e_ms").isNotNull())
    before = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    # a turn that ends no later than an earlier one is never first nor nearest
    seen = timed.select("session_id", "s_ms", end.alias("_e"), before.alias("_m"), F.struct("idx", "speaker").alias("v")).where(F.col("_m").isNull() | (F.col("_e") > F.col("_m")))
    start = F.when(F.col("_m").isNull(), -(2**62)).when(F.col("s_ms") > F.col("_m"), F.col("s_ms") + F.col("_m") + 1).otherwise(F.col("_m") * 2 + int(closed))
    return seen.select("session_id", start.cast("long").alias("t"), "v")


def locate(points: DataFrame, turns: DataFrame, at: str, key: list[str], closed: bool = False, default: str = "SPEAKER_00", bucket_ms: int = 600_000) -> DataFrame:
    """points (key, `at`) with speaker: of the first turn that holds the time `at` (half-open, or closed), else of the nearest turn, else the default.

    `at` is in half milliseconds, so that midpoints are whole numbers. Without a time, or turns, it is the default.
    """
    found = as_of(points.select(*key, at), tiles(turns, closed), at, bucket_ms * 2)
    return found.select(*key, at, F.coalesce("v.speaker", F.lit(default)).alias("speaker"))


def best_overlap(rows: DataFrame, turns: DataFrame, key: list[str]) -> DataFrame:
    """Each row's speaker with the longest overlap; of equals the first turn; without any, the session's first turn."""
    t = turns.select("session_id", "idx", "speaker", "s_ms", "e_ms")
    rank = lambda shared, idx: F.struct(shared.cast("long").alias("o"), (-idx).alias("i")).alias("_rank")
    pairs = overlap_pairs(rows, t).where(F.col("o_end") > F.col("o_start"))
    met = pairs.select(*(F.col(f"l.{k}").alias(k) for k in key), F.col("r.speaker").alias("speaker"), rank(F.col("o_end") - F.col("o_start"), F.col("r.idx")))
    first = t.groupBy(F.col("session_id").alias("_s")).agg(F.min(F.struct("idx", "speaker")).alias("_v"))
    other = rows.join(first, F.col("session_id") == F.col("_s"), "left").select(*key, F.col("_v.speaker").alias("speaker"), rank(F.lit(0), F.col("_v.idx")))
    return met.unionByName(other).groupBy(*key).agg(F.max_by("speaker", "_rank").alias("speaker"))


def undisturbed(spans: DataFrame, turns: DataFrame, speaker: str = "speaker") -> DataFrame:
    """Spans that no other speaker's turn intersects."""
    t = turns.select("session_id", "speaker", "s_ms", "e_ms")
    hit = overlap_pairs(spans, t, F.col(f"l.{speaker}") != F.col("r.speaker")).select("l").distinct()
    return spans.join(hit, F.struct(*(F.col(c) for c in spans.columns)).eqNullSafe(F.col("l")), "left_anti")
