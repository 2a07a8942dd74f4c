"""One-permutation MinHash, banding into star edges, and pair tests inside a candidate cluster."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped, mix, partitions

EMPTY = np.uint32(0xFFFFFFFF)
#: Members of a block, and elements of their sets; a larger cluster is compared block by block.
BLOCK_ROWS, BLOCK_ELEMENTS = 512, 400_000


def sketch(item: np.ndarray, hashes: np.ndarray, items: int, bins_log2: int) -> np.ndarray:
    """The smallest hash in each of 2**bins_log2 bins of each item's set, EMPTY where it has none there. item and hashes are parallel; repeats don't matter."""
    cell = item.astype(np.int64) << bins_log2
    cell |= (hashes >> np.uint64(64 - bins_log2)).view(np.int64)
    value = (hashes >> np.uint64(32 - bins_log2)).astype(np.uint32)
    out = np.full(items << bins_log2, EMPTY, np.uint32)
    np.minimum.at(out, cell, np.minimum(value, EMPTY - np.uint32(1)))
    return out.reshape(items, 1 << bins_log2)


def densified(signature: np.ndarray) -> np.ndarray:
    """Empty bins take the value of a bin that a fixed pseudorandom walk meets first, so equal sets fill alike and short sets still vote in all bands."""
    out = signature.copy()
    bins = signature.shape[1]
    every = np.arange(bins, dtype=np.uint64)
    row, col = np.nonzero(signature == EMPTY)
    for step in range(1, 8 * bins):
        if not len(row):
            break
        to = (mix(every * np.uint64(977) + np.uint64(step * 131_071)) % np.uint64(bins)).astype(np.int64) if step < 6 * bins else (np.arange(bins) + step) % bins
        found = signature[row, to[col]]
        full = found != EMPTY
        out[row[full], col[full]] = found[full]
        row, col = row[~full], col[~full]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each densified signature."""
    acc = np.zeros((len(signature), bands), np.uint64)
    part = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    for r in range(rows):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r].astype(np.uint64) + np.uint64(1))
    return mix(acc + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, id) rows: the smallest id of each key (keys, hubs), and an edge to it from each other id (a, b)."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.empty(len(keys), bool)
    first[:1] = True
    first[1:] = keys[1:] != keys[:-1]
    hub = ids[first][np.cumsum(first) - 1]
    link = hub != ids
    return keys[first], ids[first], hub[link], ids[link]


#: Bytes of a table that a bucket of band keys stands for, about; a bucket is one task's at a time.
BUCKET_BYTES = 8 << 20
STAR = "bucket long, rows binary"


def buckets_of(df: DataFrame) -> int:
    """In how many buckets to deal the band keys of a table, by Spark's estimate of its size; the number changes no result."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(1 << 40, max(partitions(df.sparkSession), size // BUCKET_BYTES))


def star_rows(keys: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """What a batch of (key, id) sends on, packed by ranges of keys: a pair for each key with its hub, and for each edge found two pairs under a key of their own."""
    k, hub, a, b = stars(keys, ids)
    own = mix(mix(a.view(np.uint64)) + b.view(np.uint64))
    key = np.concatenate([k.view(np.uint64), own, own])
    order = np.argsort(key)
    return _packed(key[order], np.concatenate([hub, a, b])[order], buckets)


def _packed(key: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    pairs = np.column_stack([key.view(np.int64), ids])
    bucket = (key >> np.uint64(24)).astype(np.int64) * buckets >> 40 if buckets < 1 << 23 else (key >> np.uint64(24)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(key) else np.empty(0, np.int64)
    offsets = np.concatenate([first, [len(key)]]).astype(np.int32) * 16
    packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), packed], ["bucket", "rows"])


def member_rows(keys: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """What a batch of (key, id) sends on, packed by ranges of keys: every pair, since any two members of a key may be alike where neither is like its smallest."""
    order = np.argsort(keys.view(np.uint64))
    return _packed(keys.view(np.uint64)[order], ids[order], buckets)


def star_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) that join the members of every key, from star_rows().

    Each batch has sent one pair for a key, so a key with a third of all rows
    is a pair for each batch here; every hub is linked to the one before it.
    """

    def chain(bucket: pa.Table) -> pa.RecordBatch:
        pairs = np.frombuffer(b"".join(bucket.column("rows").to_pylist()), np.int64).reshape(-1, 2)
        order = np.argsort(pairs[:, 0])
        key, own = pairs[order, 0], pairs[order, 1]
        again = np.flatnonzero((key[1:] == key[:-1]) & (own[1:] != own[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(own[again + 1]), pa.array(own[again])], ["a", "b"])

    return grouped(rows, "bucket", [], chain, "a long, b long")


def bucket_members(rows: DataFrame) -> DataFrame:
    """(key, id, hub): the members of every key that has two or more, and the smallest of them, from member_rows()."""

    def members(bucket: pa.Table) -> pa.RecordBatch:
        pairs = np.frombuffer(b"".join(bucket.column("rows").to_pylist()), np.int64).reshape(-1, 2)
        order = np.argsort(pairs[:, 0])
        key = pairs[order, 0]
        twice = np.flatnonzero(key[1:] == key[:-1])
        many = np.zeros(len(key), bool)
        many[twice], many[twice + 1] = True, True
        key, own = key[many], pairs[order[many], 1]
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        use = new_key | np.concatenate([[True], own[1:] != own[:-1]])[: len(key)]
        key, own, new_key = key[use], own[use], new_key[use]
        first = np.flatnonzero(new_key)
        count = np.diff(np.concatenate([first, [len(key)]]))
        several = np.repeat(count > 1, count)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key[several], own[several], np.repeat(own[first], count)[several])], ["key", "id", "hub"])

    return grouped(rows, "bucket", [], members, "key long, id long, hub long")


def blocks_of(rows: Column, elements: Column | None = None) -> Column:
    """The number of blocks for a cluster of so many rows and elements."""
    n = F.ceil(rows / F.lit(BLOCK_ROWS))
    return (n if elements is None else F.greatest(n, F.ceil(elements / F.lit(BLOCK_ELEMENTS)))).cast("int")


def spread(members: DataFrame, cluster: Column, blocks: Column, member: Column) -> DataFrame:
    """members with a row for each pair of blocks that holds it: columns job (a hash of cluster and pair of blocks), and side, 0 or 1 (2: the pair is one block)."""
    mine = F.pmod(F.xxhash64(member, F.lit(3)), blocks.cast("long")).cast("int")
    return (
        members.withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("side", F.when(F.col("other") == F.col("block"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1))
        .withColumn("job", F.xxhash64(cluster, F.least("block", "other"), F.greatest("block", "other")))
        .drop("block", "other")
    )


@lru_cache(maxsize=None)
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest matches of n for which P(similarity >= threshold), from a uniform prior, is at least the tolerance."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)  # P(Binomial(n + 1, threshold) <= m)
        if tail >= tolerance:
            return m
    return n


@lru_cache(maxsize=None)
def _least_table(bins: int, threshold: float, tolerance: float) -> np.ndarray:
    return np.array([least_matches(n, threshold, tolerance) for n in range(bins + 1)])


def bayes_pairs(signatures: np.ndarray, side: np.ndarray, threshold: float, tolerance: float, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that survive: values are compared step by step, and a pair goes once its posterior falls below the tolerance. Bins empty in both are no evidence."""
    bins = signatures.shape[1]
    least = _least_table(bins, threshold, tolerance)
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    out_i, out_j = [], []
    for a in range(0, len(left), 64):
        rows = left[a : a + 64]
        i, j = np.repeat(rows, len(right)), np.tile(right, len(rows))
        keep = (i != j) & ((side[i] != 2) | (i < j))
        i, j = i[keep], j[keep]
        seen, match = np.zeros(len(i), np.int32), np.zeros(len(i), np.int32)
        for b in range(0, bins, step):
            x, y = signatures[i, b : b + step], signatures[j, b : b + step]
            seen += ((x != EMPTY) | (y != EMPTY)).sum(axis=1, dtype=np.int32)
            match += ((x == y) & (x != EMPTY)).sum(axis=1, dtype=np.int32)
            alive = match >= least[seen]
            i, j, seen, match = i[alive], j[alive], seen[alive], match[alive]
            if not len(i):
                break
        out_i.append(i)
        out_j.append(j)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.empty(0, np.int64), np.empty(0, np.int64))


@dataclass(frozen=True)
class Sets:
    """Sets of numbers 0..kinds-1: those of set k at code[at[k]:at[k + 1]], distinct and in order."""

    code: np.ndarray
    at: np.ndarray
    kinds: int

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Sets:
        values, code = np.unique(np.concatenate(sets), return_inverse=True)
        return cls(code.ravel(), np.concatenate([[0], np.cumsum([len(s) for s in sets])]), len(values))

    def part(self, a: int, b: int) -> Sets:
        return Sets(self.code[self.at[a] : self.at[b]], self.at[a : b + 1] - self.at[a], self.kinds)


def exact_pairs(sets: Sets, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs have exact Jaccard >= threshold."""
    size = np.diff(sets.at)
    least, most = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    out = (most > 0) & (least >= threshold * most - 1e-9)
    x, y = i[out], j[out]
    if len(x):
        needed = threshold / (1 + threshold) * (size[x] + size[y]) - 1e-9
        can = _most_common(sets, x, y) >= needed
        out[out], x, y = can, x[can], y[can]
    if len(x):
        common = _common(sets, x, y) if len(x) < SMALL * len(size) else _all_common(sets)[x, y]
        out[out] = common >= threshold * (size[x] + size[y] - common) - 1e-9
    return out


def _most_common(sets: Sets, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Upper bounds of the intersections' sizes: elements are counted in cells, of which two sets share no more than the lesser count."""
    owner = np.repeat(np.arange(len(sets.at) - 1), np.diff(sets.at))
    cells = np.bincount(owner * CELLS + sets.code % CELLS, minlength=(len(sets.at) - 1) * CELLS).reshape(-1, CELLS)
    cells = cells.astype(np.uint8 if cells.max(initial=0) < 256 else np.int32)
    return np.concatenate([np.minimum(cells[i[a : a + 4096]], cells[j[a : a + 4096]]).sum(axis=1, dtype=np.int64) for a in range(0, len(i), 4096)])


#: Cells of the bound; elements that are looked up at once.
CELLS, LOOKUP = 1024, 2_000_000


def _common(sets: Sets, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of some pairs: the elements of i are looked up among (set, element), as one sorted array of numbers."""
    size = np.diff(sets.at)
    cells = np.repeat(np.arange(len(size)), size) * sets.kinds + sets.code
    out = np.empty(len(i), np.int64)
    ends = np.cumsum(size[i])
    a = 0
    while a < len(i):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LOOKUP, "right")))
        n = size[i[a:b]]
        begin = np.cumsum(n) - n
        take = np.repeat(sets.at[i[a:b]] - begin, n) + np.arange(n.sum())
        wanted = np.repeat(j[a:b], n) * sets.kinds + sets.code[take]
        at = np.searchsorted(cells, wanted)
        hit = np.concatenate([[0], np.cumsum(cells[np.minimum(at, len(cells) - 1)] == wanted)])
        out[a:b] = hit[begin + n] - hit[begin]
        a = b
    return out


def _all_common(sets: Sets) -> np.ndarray:
    """Sizes of all intersections of up to two blocks of sets: values of many sets by products of 0/1 matrices, those of few by counting their pairs."""
    n = len(sets.at) - 1
    owner = np.repeat(np.arange(n), np.diff(sets.at))
    df = np.bincount(sets.code, minlength=sets.kinds)
    out = np.zeros((n, n), np.float32)
    order = np.argsort(sets.code, kind="stable")
    owner, column = owner[order], sets.code[order]
    few = (df[column] > 1) & (df[column] <= 8)
    first = np.concatenate([[0], np.cumsum(df)])
    place = np.arange(len(column)) - first[column]
    for gap in range(1, 8):
        use = np.flatnonzero(few & (place + gap < df[column]))
        pairs = owner[use] * n + owner[use + gap]
        hit = np.bincount(pairs, minlength=n * n).reshape(n, n)
        out += hit + hit.T
    many = np.flatnonzero(df > 8)
    code = np.full(sets.kinds, -1)
    code[many] = np.arange(len(many))
    code = code[column]
    width = max(64, 8_000_000 // n)
    for a in range(0, len(many), width):
        use = (code >= a) & (code < a + width)
        dense = np.zeros((n, min(width, len(many) - a)), np.float32)
        dense[owner[use], code[use] - a] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


#: Sets of a job above which all its intersections are counted at once.
SMALL = 32


def alike(sets: Sets, jobs: np.ndarray, side: np.ndarray, known: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of each job with exact Jaccard >= threshold, across its two blocks or within its one, but those known to be in one component; rows of one job are neighbours."""
    cuts = np.concatenate([[0], np.flatnonzero(jobs[1:] != jobs[:-1]) + 1, [len(jobs)]])
    sizes = np.diff(cuts)
    out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    small = [_job_pairs(side, known, cuts[:-1][sizes == n], n) for n in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist()]
    if small:
        i, j = map(np.concatenate, zip(*small, strict=True))
        real = exact_pairs(sets, i, j, threshold)
        out.append((i[real], j[real]))
    for a, n in zip(cuts[:-1][sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        i, j = _job_pairs(side, known, np.array([a]), n)
        real = exact_pairs(_dense(sets.part(a, a + n)), i - a, j - a, threshold)
        out.append((i[real], j[real]))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _dense(sets: Sets) -> Sets:
    """The same sets with as many kinds as they have."""
    values, code = np.unique(sets.code, return_inverse=True)
    return Sets(code.ravel(), sets.at, len(values))


def _job_pairs(side: np.ndarray, known: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all jobs of n rows at once."""
    i, j = ((starts[:, None] + x).ravel() for x in np.triu_indices(n, 1))
    keep = ((side[i] == 2) | (side[i] != side[j])) & (known[i] != known[j])
    return i[keep], j[keep]
