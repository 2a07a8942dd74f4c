"""Repeated windows of a fixed length, found through content-defined segments.

Every window of `width` symbols belongs to the smallest hash of the `gram`-symbol
strings in it (its key), and a run of windows with one key is a segment. Equal
windows have equal keys wherever they stand, so only segments with one key need
be compared. A segment's content is told by a 128-bit hash of its
bytes; segments of equal content are counted, not compared. What is left to
compare are the distinct contents of a key, one occurrence of each. A key with many
contents is parted further by the smallest strings in other orders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bitmap, grams_hash, grouped, in_bitmap, materialise, mix, task

#: n: windows of the segment from start on; inner: windows may repeat within it; text_key tells rows apart that repeat a doc_id.
SEGMENT = "key long, c0 long, c1 long, doc_id long, text_key long, start int, n int, inner boolean"


def _place() -> Column:
    return F.struct("doc_id", "text_key", "start")


@dataclass(frozen=True)
class Slice:
    """Some rows a..b-1 of a column as symbols (those of row t at at[t - a]:at[t - a + 1]), and the bytes raw[lo[k]:hi[k]] of symbol k; without lo the symbols are the bytes."""

    a: int
    b: int
    symbols: np.ndarray
    at: np.ndarray
    raw: np.ndarray
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None

    def spans(self, first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
        """Where the bytes of the symbols first..last begin and end."""
        return (first.tolist(), (last + 1).tolist()) if self.lo is None else (self.lo[first].tolist(), self.hi[last].tolist())


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


@dataclass(frozen=True)
class Plan:
    width: int
    gram: int


def cut(symbols: np.ndarray, at: np.ndarray, plan: Plan, anchor: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of several texts (symbols of text t at at[t]:at[t+1]): text, start within the text, number of windows, key, and whether windows may repeat within it.

    Two equal windows of a segment hold their key's first occurrence at one
    offset, hence at two places; so a segment that ends while its first window's
    first occurrence is still in sight repeats nothing. Each anchor is another order of the strings.
    """
    grams = grams_hash(symbols, plan.gram)
    if anchor:
        grams = mix(grams ^ np.uint64(anchor * 0xA24BAED4963EE407 % 2**64))
    span = plan.width - plan.gram + 1
    if len(grams) < span:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64), np.empty(0, bool)
    keys = sliding_min(grams, span)
    windows = len(keys)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = text[:windows] == text[plan.width - 1 :]
    first = inside.copy()
    first[1:] &= (keys[1:] != keys[:-1]) | ~inside[:-1] | (text[1:windows] != text[: windows - 1])
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= first[1:] | ~inside[1:]
    end = np.flatnonzero(last)
    n = end - start + 1
    seen = np.empty(len(start), np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    for k in range(0, len(start), 4096):
        part = start[k : k + 4096]
        seen[k : k + 4096] = (views[part] == keys[part][:, None]).argmax(axis=1)
    return text[start], start - at[text[start]], n, keys[start], n > seen + 1


#: Bits of the filter of repeated keys (8 MB) that is sent to all tasks; what it can't tell apart travels and is counted exactly.
FILTER_BITS = 26
#: Contents of a key above which its windows are parted further, by the smallest string in another order.
HOT = 4096
#: Orders by which keys are parted; windows that share their smallest strings in all of them are counted one by one.
ANCHORS = 3
#: Symbols that a comparing task holds at once.
JOB_SYMBOLS = 1_000_000

Symbols = Callable[[pa.Array], Iterator[Slice]]
ROWS = "doc_id long, text_key long, a int, n int"
BODY = "key long, kinds long, copies long, doc_id long, text_key long, start int, n int, body binary"


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text) of documents. A null doc_id counts as the largest number; text_key, a hash of the text, has no sign in such rows alone, so they come after those that have this number."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    text_key = F.when(F.col("doc_id").isNull(), hashed).otherwise(hashed.bitwiseOR(F.lit(-(2**63))))
    return docs.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), text_key.alias("text_key"), "text")


def repeats(docs: DataFrame, plan: Plan, symbols: Symbols, compare: Callable[[pa.Table], pa.RecordBatch | None], firsts_stay: bool) -> DataFrame:
    """(doc_id, text_key, a, n): runs of n repeated windows from symbol a on, for identified() rows.

    symbols: slices of a text column, or of a column of bodies.
    compare: from contents of some keys (key, doc_id, text_key, start, n, copies, body) to runs.
    firsts_stay: a window's first occurrence is no repeat.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in symbols(batch.column("text")):
                _, _, _, key, inner = cut(part.symbols, part.at, plan)
                found, count = np.unique(key.view(np.int64), return_counts=True)
                again = np.unique(key.view(np.int64)[inner])
                count[np.searchsorted(found, again)] += 1
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count)], ["key", "count"])

    busy = docs.mapInArrow(task(keys), "key long, count long").groupBy("key").agg(F.sum("count").alias("count")).where("count > 1")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(busy, FILTER_BITS))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_key"))
            for part in symbols(batch.column("text")):
                found = cut(part.symbols, part.at, plan)
                use = in_bitmap(wanted.value, found[3])
                text, start, n, key, inner = (x[use] for x in found)
                digest, _ = _contents(part, text, start, n, plan, False)
                columns = (key.view(np.int64), digest[:, 0], digest[:, 1], ids[part.a + text], text_keys[part.a + text], start.astype(np.int32), n.astype(np.int32), inner)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "c0", "c1", "doc_id", "text_key", "start", "n", "inner"])

    found = materialise(docs.mapInArrow(task(segments), SEGMENT)).withColumn("copies", F.lit(1).cast("long"))
    wanted.destroy()
    copies, contested = _settled(found, firsts_stay)

    # One occurrence of each contested content, cut from its text.
    lists = contested.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_list(F.struct("key", "kinds", "copies", "start", "n")).alias("wants"))
    joined = docs.join(lists, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("t"))).select("doc_id", "text_key", "text", "wants")

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_keys, wants = (batch.column(c).to_pylist() for c in ("doc_id", "text_key", "wants"))
            for part in symbols(batch.column("text")):
                rows = [(w["key"], w["kinds"], w["copies"], ids[k], text_keys[k], w["start"], w["n"], k - part.a) for k in range(part.a, part.b) for w in wants[k]]
                if rows:
                    *columns, text = zip(*rows, strict=True)
                    x, y = _spans(part, np.array(text), np.array(columns[5]), np.array(columns[6]), plan)
                    yield _bodies(*columns, [part.raw[i:j].tobytes() for i, j in zip(x, y, strict=True)])

    out, ready = [copies], materialise(joined.mapInArrow(task(bodies), BODY))
    for anchor in range(1, ANCHORS + 1):
        out.append(_compared(ready.where(F.col("kinds") <= HOT), compare, plan))
        hot = ready.where(F.col("kinds") > HOT)
        if hot.isEmpty():
            return reduce(DataFrame.unionAll, out)
        if anchor < ANCHORS:
            copies, ready = _parted(hot, plan, symbols, anchor, firsts_stay)
            out.append(copies)
    return reduce(DataFrame.unionAll, [*out, _counted(hot, plan, symbols, firsts_stay)])


def _settled(found: DataFrame, firsts_stay: bool) -> tuple[DataFrame, DataFrame]:
    """Of segments: runs of those whose content repeats, and one occurrence of each content of a key that has others or may repeat within itself."""
    each = found.groupBy("key", "c0", "c1").agg(F.min(_place()).alias("first"), F.sum("copies").alias("copies"), F.first("n").alias("n"), F.max("inner").alias("inner"))
    each = materialise(each)
    contested = each.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.max("inner").alias("any")).where("kinds > 1 or any").select(F.col("key").alias("k"), "kinds")
    contested = each.join(contested, F.col("key") == F.col("k")).select("key", "kinds", "copies", "n", "first.*")
    again = each.where("copies > 1").select(F.col("c0").alias("d0"), F.col("c1").alias("d1"), F.col("key").alias("k"), "first")
    copies = found.join(again, (F.col("c0") == F.col("d0")) & (F.col("c1") == F.col("d1")) & (F.col("key") == F.col("k")))
    if firsts_stay:
        copies = copies.where(_place() != F.col("first"))
    return copies.select("doc_id", "text_key", F.col("start").alias("a"), "n"), contested


def _compared(bodies: DataFrame, compare: Callable[[pa.Table], pa.RecordBatch | None], plan: Plan) -> DataFrame:
    total = bodies.agg(F.sum(F.col("n") + plan.width - 1)).first()[0] or 0
    jobs = bodies.withColumn("job", F.pmod(F.xxhash64("key"), F.lit(1 + total // JOB_SYMBOLS)))
    return grouped(jobs, "job", ["key", "doc_id", "text_key", "start"], compare, ROWS)


def _parted(bodies: DataFrame, plan: Plan, symbols: Symbols, anchor: int, firsts_stay: bool) -> tuple[DataFrame, DataFrame]:
    """Contents of keys that have too many, cut again by another order: equal windows have equal keys in that order too. Runs of contents that repeat, and bodies to compare."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("key").to_numpy().view(np.uint64)
            ids, text_keys, begin, copies = (batch.column(c).to_numpy() for c in ("doc_id", "text_key", "start", "copies"))
            for part in symbols(batch.column("body")):
                text, start, n, key, inner = cut(part.symbols, part.at, plan, anchor)
                digest, cut_out = _contents(part, text, start, n, plan, True)
                of = part.a + text
                columns = (mix(key ^ mix(own[of])).view(np.int64), digest[:, 0], digest[:, 1], ids[of], text_keys[of], (begin[of] + start).astype(np.int32), n.astype(np.int32), inner, copies[of])
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), pa.array(cut_out, pa.binary())], ["key", "c0", "c1", "doc_id", "text_key", "start", "n", "inner", "copies", "body"])

    found = materialise(bodies.mapInArrow(task(again), f"{SEGMENT}, copies long, body binary"))
    copies, contested = _settled(found, firsts_stay)
    first = contested.select(F.col("key").alias("k"), "kinds", F.col("copies").alias("all"), F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("start").alias("s"))
    same = (F.col("key") == F.col("k")) & (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("start") == F.col("s"))
    return copies, materialise(found.join(first, same).select("key", "kinds", F.col("all").alias("copies"), "doc_id", "text_key", "start", "n", "body"))


def _spans(part: Slice, text: np.ndarray, start: np.ndarray, n: np.ndarray, plan: Plan) -> tuple[list[int], list[int]]:
    first = part.at[text] + start
    return part.spans(first, first + n + plan.width - 2)


def _contents(part: Slice, text: np.ndarray, start: np.ndarray, n: np.ndarray, plan: Plan, bodies: bool) -> tuple[np.ndarray, list[bytes]]:
    """128-bit hashes of the segments' bytes, and the bytes themselves if wanted."""
    raw = memoryview(np.ascontiguousarray(part.raw))
    spans = list(zip(*_spans(part, text, start, n, plan), strict=True))
    digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[x:y]) for x, y in spans]), np.int64).reshape(-1, 2)
    return digest, [raw[x:y].tobytes() for x, y in spans] if bodies else []


def _bodies(*columns: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["key", "kinds", "copies", "doc_id", "text_key", "start", "n", "body"])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of true begins, and its length."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    a = np.flatnonzero(edge == 1)
    return a, np.flatnonzero(edge == -1) - a


def _counted(bodies: DataFrame, plan: Plan, symbols: Symbols, firsts_stay: bool) -> DataFrame:
    """Runs of repeated windows for keys with any number of contents: windows by a 128-bit hash of their bytes, counted over all tasks with partial sums."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_keys, start, copies = (batch.column(c).to_numpy() for c in ("doc_id", "text_key", "start", "copies"))
            for part in symbols(batch.column("body")):
                count = np.diff(part.at) - plan.width + 1
                text = np.repeat(np.arange(len(count)), count)
                at = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                digest, _ = _contents(part, text, at, np.ones(len(at), np.int64), plan, False)
                of = part.a + text
                columns = (digest[:, 0], digest[:, 1], ids[of], text_keys[of], (start[of] + at).astype(np.int32), copies[of])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["w0", "w1", "doc_id", "text_key", "start", "copies"])

    each = bodies.mapInArrow(task(windows), "w0 long, w1 long, doc_id long, text_key long, start int, copies long")
    known = each.groupBy("w0", "w1").agg(F.min(_place()).alias("first"), F.sum("copies").alias("times")).where("times > 1")
    out = each.join(known, ["w0", "w1"])
    if firsts_stay:
        out = out.where(_place() != F.col("first"))
    # Neighbours become one run, so that no text gets a list of all its places.
    place = F.row_number().over(W.partitionBy("doc_id", "text_key").orderBy("start"))
    out = out.select("doc_id", "text_key", "start").distinct().withColumn("run", F.col("start") - place)
    return out.groupBy("doc_id", "text_key", "run").agg(F.min("start").alias("a"), F.count(F.lit(1)).cast("int").alias("n")).drop("run")


def with_runs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """identified() rows beside the lists a and n of their runs, null where there is none."""
    lists = found.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_list("a").alias("a"), F.collect_list("n").alias("n"))
    joined = docs.join(lists, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    return joined.select(F.when(F.col("text_key") < 0, F.col("doc_id")).alias("doc_id"), "text", "a", "n")


def covered(size: int, a: list[int] | None, n: list[int] | None, width: int) -> np.ndarray:
    """Which of a text's symbols the windows of its runs cover."""
    edge = np.zeros(size + 1, np.int32)
    if a:
        start = np.array(a, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + np.array(n, np.int64) + width - 1, -1)
    return np.cumsum(edge[:-1]) > 0
