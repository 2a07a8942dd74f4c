"""Mixing sources to target weights, block by block.

Each source's words, document after document in order of doc_id, are packed
into blocks of a fixed number of words. Output shards of a fixed number of slots
get multinomial counts of each source, drawn by conditional binomials from what is left of
the sources' quotas of the whole mix, so the counts of all shards add up to the
targets. A source's slots, numbered through all shards, go through pseudorandom
permutations of its block numbers, one for each pass over the source, and blocks
are joined by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Words, buffer, materialise, partitions, slices, task, with_columns

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix against words of the input.
SHARE = 1.5
#: Times that a source's words may be taken.
REPEATS = 2
#: Words in a block, and slots in an output shard.
BLOCK, SLOTS = 32, 8192
#: Rounds of the permutation's network.
ROUNDS = 4


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of `[^\\x20\\x09-\\x0D]+` in each whole text; 0 for null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffer(batch.column(2))
            found = [np.diff(Words(raw[at[a] : at[b]], at[a : b + 1] - at[a], hashed=0).range) for a, b in slices(at, SLICE_BYTES)]
            n = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "size"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task(count), "doc_id long, source string, size long")


def targets(totals: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size), a row for each source.

    Water filling: with sources in order of size / weight, those below some place
    are full (repeats x size) and the rest share what is left by weight, so a
    cumulative sum over the small table finds the place.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double"))
    full = W.orderBy(repeats * F.col("source_size") / F.col("w"), "rank")
    before = full.rowsBetween(W.unboundedPreceding, -1)
    rest = full.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = ranked.select(
        "*",
        F.least(share * F.sum("source_size").over(everything), repeats * F.sum("source_size").over(everything)).alias("want"),
        F.coalesce(repeats * F.sum("source_size").over(before), F.lit(0.0)).alias("spent"),
        F.sum("w").over(rest).alias("left"),
        F.row_number().over(full).alias("place"),
    )
    level = filled.withColumn("level", (F.col("want") - F.col("spent")) / F.col("left"))
    level = level.withColumn("fits", F.col("level") * F.col("w") <= repeats * F.col("source_size"))
    # The first place that fits sets the level; NULL if all are full.
    water = level.select("*", F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(everything)["level"].alias("water"))
    target = F.least(repeats * F.col("source_size"), F.coalesce(F.col("water") * F.col("w"), repeats * F.col("source_size")))
    return water.select("source", "rank", "source_size", target.cast("double").alias("target"))


def _permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..n-1, elementwise: a Feistel network over the next power of four, walked until it lands inside."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(2, n)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    at = index.astype(np.uint64)
    todo = np.arange(len(at))
    while len(todo):
        x, b, m, k = at[todo], bits[todo], mask[todo], key[todo]
        left, right = x >> b, x & m
        for r in range(ROUNDS):
            f = (right ^ (k + np.uint64((r + 1) * 0x9E3779B97F4A7C15 % 2**64))) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(29)) & m)
        at[todo] = (left << b) | right
        todo = todo[at[todo] >= n[todo].astype(np.uint64)]
    return at.astype(np.int64)


def _split(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """n slots out of left: a multinomial draw, source after source by conditional binomials, bounded by what each source has left and the others can't give."""
    total = int(left.sum())
    if n >= total:
        return left.copy()
    out = np.zeros(len(left), np.int64)
    for k, own in enumerate(map(int, left)):
        rest = total - own
        drawn = int(rng.binomial(n, own / total)) if own else 0
        out[k] = min(max(drawn, n - rest, 0), own, n)
        n, total = n - int(out[k]), rest
    return out


def shard_counts(quota: np.ndarray, shards: int, slots: int, seed: int, a: int, b: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, counts by source, counts in earlier shards) for shards a..b-1.

    Counts are drawn down a binary tree of shard ranges, each node with a random
    generator of its own, so any task finds its shards in O(log shards) draws and
    all tasks agree.
    """

    def down(lo: int, hi: int, counts: np.ndarray, done: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if hi <= a or lo >= b:
            return
        if hi - lo == 1:
            yield lo, counts, done
            return
        mid = (lo + hi) // 2
        first = _split(np.random.default_rng([seed, lo, hi]), counts, (mid - lo) * slots)
        yield from down(lo, mid, first, done)
        yield from down(mid, hi, counts - first, done + first)

    if shards:
        yield from down(0, shards, quota, np.zeros_like(quota))


def mix(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, share: float = SHARE, block: int = BLOCK, slots: int = SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of docs (doc_id, source, text), as (sizes, targets, taken).

    sizes: doc_id, source, size, at (its first word's place in its source).
    taken: shard, slot, source, turn (the pass over the source), block and, for each document in the block, row,
    doc_id, first and n: the words first..first+n-1 of that document are taken
    there. Null texts have no words and are never taken; null is a source, the
    last. Rows that repeat a doc_id are documents of their own (told apart by row). Columns
    of other names are ignored; an empty table gives an empty mix.
    """
    spark = docs.sparkSession
    # Ranges of (source, doc_id): a source is as many ranges as its rows need, so no task holds a whole source.
    ranged = sizes(docs).repartitionByRange(partitions(spark), F.col("source").asc_nulls_last(), F.col("doc_id"), F.col("size"))
    held = materialise(ranged.sortWithinPartitions(F.col("source").asc_nulls_last(), "doc_id", "size").select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("row")))
    # Two-level prefix sums: ranges within sources (as many rows as ranges plus sources), then rows within a range.
    parts = held.groupBy("source", "pid").agg(F.sum("size").alias("n"))
    parts = parts.select(F.col("source").alias("s"), F.col("pid").alias("p"), (F.sum("n").over(W.partitionBy("source").orderBy("pid")) - F.col("n")).alias("base"))
    within = F.sum("size").over(W.partitionBy("pid", "source").orderBy("row")) - F.col("size")
    placed = held.withColumn("inner", within).join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("pid") == F.col("p")))
    placed = materialise(placed.select("doc_id", "source", "size", "row", (F.col("base") + F.col("inner")).alias("at")))

    totals = held.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(totals, weights, share)
    quotas = aims.select("source", "rank", "source_size", "target", F.ceil(F.col("source_size") / block).cast("long").alias("blocks"))
    quotas = quotas.withColumn("quota", F.coalesce(F.round(F.col("target") / F.nullif("source_size", F.lit(0)) * F.col("blocks")), F.lit(0)).cast("long"))
    plan = [r.asDict() for r in quotas.orderBy("rank").collect()]  # a row for each source

    quota = np.array([s["quota"] for s in plan], np.int64)
    shards = -(-int(quota.sum()) // slots)
    tasks = max(1, min(partitions(spark), shards))

    def slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, of = np.array([s["rank"] for s in plan], np.int64), np.array([s["blocks"] for s in plan], np.int64)
        for task in (t for batch in batches for t in batch.column(0).to_pylist()):
            for shard, n, done in shard_counts(quota, shards, slots, seed, shards * task // tasks, shards * (task + 1) // tasks):
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                number, blocks, rank = np.repeat(done, n) + step, np.repeat(of, n), np.repeat(ranks, n)
                with np.errstate(over="ignore"):
                    key = (rank.astype(np.uint64) * np.uint64(1_000_003) + (number // blocks).astype(np.uint64) + np.uint64(seed) * np.uint64(7919) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
                columns = (np.full(len(step), shard), np.arange(len(step), dtype=np.int32), rank.astype(np.int32), (number // blocks).astype(np.int32), _permute(number % blocks, blocks, key))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["shard", "slot", "rank", "turn", "block"])

    slots_df = spark.range(0, tasks, 1, tasks).mapInArrow(task(slots_of), "shard long, slot int, rank int, turn int, block long")

    ranks = F.broadcast(quotas.select(F.col("source").alias("s"), "rank")) if len(plan) <= 10_000 else quotas.select(F.col("source").alias("s"), "rank")
    pieces = placed.where("size > 0").join(ranks, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    spans = pieces.select("*", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))).alias("block"))
    first = F.greatest(F.lit(0), F.col("block") * block - F.col("at"))
    last = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("at"))
    packed = spans.select("source", "rank", "block", "row", "doc_id", first.alias("first"), (last - first).alias("n"))
    # Spark takes the slots for as small as the range that they come from; the hint keeps it from broadcasting them.
    return placed, aims, slots_df.hint("merge").join(packed, ["rank", "block"]).drop("rank")


def mixed(docs: DataFrame, seed: int = 0, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target and taken, the words that the mix takes of it.

    Null and empty texts have size 0 and are never taken; rows that repeat a doc_id, and rows without one, count each; a null
    source is the last source; other columns are ignored; an empty table gives no rows.
    """
    placed, aims, taken = mix(docs, seed, weights, share)
    words = taken.groupBy("row").agg(F.sum("n").alias("taken"))
    out = placed.join(words, "row", "left").join((aims.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_texts(docs: DataFrame, columns: list[str], seed: int = 0) -> DataFrame:
    """The named columns of docs with text made of the words that the mix takes of each document, in its own order, a line for each pass; documents of which it takes none go.

    So null and empty texts go; rows that repeat a doc_id, and rows without one, are mixed each; columns may have any
    names but those that begin with __mix; an empty table gives no rows.
    """
    placed, _, taken = mix(docs, seed)
    pieces = taken.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("turn", "first", "n"))).alias("__mix_pieces"))
    # Rows are told apart by doc_id, source, size and, where all are alike, their number.
    number = F.row_number().over(W.partitionBy("doc_id", "source", "size").orderBy("row"))
    lists = placed.withColumn("no", number).join(pieces, "row").select(*(F.col(c).alias(f"__mix_{c}") for c in ("doc_id", "source", "size", "no")), "__mix_pieces")

    def size(batch: pa.RecordBatch) -> list[pa.Array]:
        raw, at = buffer(batch.column("text"))
        return [pa.array(np.diff(Words(raw, at, hashed=0).range), pa.int64())]

    sized = with_columns(docs, columns, size, "__mix_words long")
    sized = sized.withColumn("__mix_nth", F.row_number().over(W.partitionBy("doc_id", "source", "__mix_words").orderBy("text")))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("__mix_doc_id")) & F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_words") == F.col("__mix_size")) & (F.col("__mix_nth") == F.col("__mix_no"))
    joined = sized.join(lists, on).select(*columns, "__mix_pieces")

    def texts(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("__mix_pieces").to_pylist(), strict=True):
            words = text.encode().split()
            lines: dict[int, list[bytes]] = {}
            for p in wanted:
                lines.setdefault(p["turn"], []).extend(words[p["first"] : p["first"] + p["n"]])
            out.append(b"\n".join(b" ".join(lines[t]) for t in sorted(lines)).decode())
        return [pa.array(out, pa.string())]

    found = with_columns(joined, [*columns, "__mix_pieces"], texts, "__mix_text string")
    return found.withColumn("text", F.col("__mix_text")).select(*columns)
