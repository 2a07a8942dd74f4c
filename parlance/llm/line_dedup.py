"""Fuzzy line deduplication: MinHash of character shingles, banding, exact verification, union-find.

Equal lines are one class, told by a 128-bit hash of the line. Bands of MinHash
values put classes into buckets; the lines of buckets, and no others, are sent to tasks
that verify Jaccard exactly: first every line against the smallest of its buckets' hubs, which
joins clusters of copies at a cost in proportion to their size, then, in buckets that
hold several components still, all pairs of members of different ones. Classes that links join are one
component, and of all lines of a component the first (smallest doc_id, then line
number) stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bitmap, documents, drop, grams_hash, grouped, in_bitmap, materialise, mix, task
from .components import components, local_forest
from .minhash import STAR, Sets, alike, band_keys, blocks_of, bucket_members, buckets_of, densified, member_rows, sketch, spread

#: Characters in a shingle; a shorter line is one shingle.
SHINGLE, THRESHOLD = 8, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8**3)**16 < 1.1e-5, at 0.9 with 3e-10.
BINS_LOG2, BANDS, ROWS = 6, 16, 3
#: Characters that are handled at once, and hashed at once; lines that are compared at once, of one or several clusters.
SLICE_CHARS, HASH_CHARS, COMPARE = 400_000, 100_000, 1_000
#: Bits of the candidate filter that is sent to all tasks: 8 MB, however many lines are candidates. Beyond what it can tell apart, more texts travel; results stay.
FILTER_BITS = 26


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[list[str]]]]:
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    held, size, keys = [], 0, []
    for key, text in zip(ids, texts, strict=True):
        held.append((text or "").split("\n"))
        keys.append(key)
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield keys, held
            held, size, keys = [], 0, []
    if held:
        yield keys, held


def _keys(lines: list[str]) -> np.ndarray:
    """128-bit hashes of lines, as two 64-bit columns."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]), np.int64).reshape(-1, 2)


def _shingles(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line number, hash) of every k characters of each line; of the whole line where it is shorter."""
    codes, at = _characters(lines)
    owner = np.repeat(np.arange(len(lines), dtype=np.int32), np.diff(at))
    grams = mix(_grams(codes, k)[0])
    inside = owner[: len(grams)] == owner[k - 1 : k - 1 + len(grams)] if len(grams) else np.empty(0, bool)
    short = np.flatnonzero((np.diff(at) < k) & (np.diff(at) > 0))
    whole = mix(_keys([lines[i] for i in short])[:, 0].astype(np.uint64)) if len(short) else np.empty(0, np.uint64)
    return np.concatenate([owner[: len(grams)][inside], short]), np.concatenate([grams[inside], whole])


def _grams(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray | None]:
    """A number for every k characters, and which of them are hashes (None: none is). Up to eight characters of one byte are the number itself, so different ones differ."""
    if k > 8 or len(codes) < k:
        found = grams_hash(codes, k)
        return found, np.ones(len(found), bool) if len(found) else None
    bytes_ = np.concatenate([codes.astype(np.uint8), np.zeros(8, np.uint8)])
    packed = np.ndarray(len(codes) - k + 1, "<u8", bytes_, strides=(1,)) & np.uint64((1 << (8 * k)) - 1)
    if codes.dtype == np.uint8:
        return packed, None
    wide = np.concatenate([[0], np.cumsum(codes > 255)])
    wide = wide[k:] > wide[:-k]
    packed[wide] = grams_hash(codes, k)[wide] | np.uint64(1)
    return packed, wide


def _characters(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all lines (as bytes where none needs more), and where each line begins."""
    text = "".join(lines)
    try:
        codes = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)


def _sets(lines: list[str], k: int) -> Sets:
    """Each line's distinct shingles as numbers that are equal only for equal shingles: those that hash alike are compared character by character.

    A line shorter than a shingle is alike to no other line: its set is empty.
    """
    codes, at = _characters(lines)
    n = np.maximum(np.diff(at) - k + 1, 0)
    if not n.any():
        return Sets(np.empty(0, np.int64), np.zeros(len(lines) + 1, np.int64), 0)
    owner = np.repeat(np.arange(len(lines)), n)
    place = np.repeat(at[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    grams, hashed = _grams(codes, k)
    grams = grams[place]
    order = _equal_together(grams)
    ranked = grams[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    kinds = int(new.sum())
    if hashed is not None:
        again = np.flatnonzero(~new & (hashed[place[order]] | np.concatenate([[False], hashed[place[order[:-1]]]])))
        x, y = place[order[again]], place[order[again - 1]]
        if any((codes[x + j] != codes[y + j]).any() for j in range(k)):
            found, number = np.unique(codes[place[:, None] + np.arange(k)], axis=0, return_inverse=True)
            number, kinds = number.ravel(), len(found)
    bits = kinds.bit_length()
    cells = np.sort(owner << bits | number)
    cells = cells[np.concatenate([[True], cells[1:] != cells[:-1]])]
    return Sets(cells & ((1 << bits) - 1), np.searchsorted(cells, np.arange(len(lines) + 1) << bits), kinds)


def _equal_together(values: np.ndarray) -> np.ndarray:
    """An order in which equal values are neighbours: by the first bits of their hashes, with the places in the last bits, which sorts faster than places by values."""
    bits = np.uint64(len(values).bit_length())
    packed = np.sort(mix(values) >> bits << bits | np.arange(len(values), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ranked = values[order]
    mixed = ((packed[1:] >> bits) == (packed[:-1] >> bits)) & (ranked[1:] != ranked[:-1])
    return np.argsort(values) if mixed.any() else order


def _slices(lines: list[str]) -> Iterator[list[str]]:
    a = size = 0
    for b, line in enumerate(lines):
        size += len(line)
        if size >= HASH_CHARS:
            yield lines[a : b + 1]
            a, size = b + 1, 0
    if a < len(lines):
        yield lines[a:]


def _bands(lines: list[str], shingle: int) -> np.ndarray:
    item, hashes = _shingles(lines, shingle)
    return band_keys(densified(sketch(item, hashes, len(lines), BINS_LOG2)), BANDS, ROWS)


def _blank(line: str) -> bool:
    return not line or line.isspace()


def line_dedup(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, removed): the numbers, from 0, of the lines to remove of each row of docs (doc_id, text) that has some.

    Lines are what "\\n" parts. Blank lines stay and match nothing; null texts have none. Of lines at one
    place in the order (rows that repeat a doc_id) the rows are taken as one
    document. Rows without a doc_id keep all their lines and match nothing; other columns are ignored; an empty table gives no rows.
    Lines and buckets that are written on the way go once they are used.
    """
    docs = documents(docs).where("doc_id is not null")
    spark = docs.sparkSession
    buckets = buckets_of(docs)

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, parts in _lines(batch):
                lines = list({x for part in parts for x in part if not _blank(x)})
                if lines:
                    keys = np.concatenate([_bands(part, shingle) for part in _slices(lines)])
                    yield member_rows(keys.ravel(), np.repeat(_keys(lines)[:, 0], BANDS), buckets)

    members = materialise(bucket_members(docs.mapInArrow(task(bands), STAR)))
    wanted = spark.sparkContext.broadcast(bitmap(members.select(F.col("id").alias("key")), FILTER_BITS))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each slice: the first place of each line (with its text, if it is a candidate), and the places of the others, which go at once."""
        for batch in batches:
            for ids, parts in _lines(batch):
                lines = [x for part in parts for x in part]
                doc = np.repeat(np.array(ids, np.int64), [len(p) for p in parts])
                no = np.concatenate([np.arange(len(p)) for p in parts]).astype(np.int32)
                use = np.array([not _blank(x) for x in lines], bool)
                if not use.any():
                    continue
                keys = _keys([x for x, u in zip(lines, use, strict=True) if u])
                doc, no, at = doc[use], no[use], np.flatnonzero(use)
                order = np.lexsort((no, doc, keys[:, 1], keys[:, 0]))
                keys, doc, no, at = keys[order], doc[order], no[order], at[order]
                first = np.ones(len(keys), bool)
                first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
                # A repeated row's line is at its own place: the place stays as one.
                same = np.zeros(len(keys), bool)
                same[1:] = ~first[1:] & (doc[1:] == doc[:-1]) & (no[1:] == no[:-1])
                again = ~first & ~same
                rows = first | again
                sent = first & in_bitmap(wanted.value, np.ascontiguousarray(keys[:, 0]))
                texts = [lines[at[k]] if sent[k] else None for k in np.flatnonzero(rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[rows, 0], mask=again[rows]), pa.array(keys[rows, 1], mask=again[rows]), pa.array(doc[rows]), pa.array(no[rows]), pa.array(texts, pa.string())],
                    ["k0", "k1", "doc_id", "no", "line"],
                )

    found = materialise(docs.mapInArrow(task(candidates), "k0 long, k1 long, doc_id long, no int, line string"))
    wanted.destroy()
    texts = materialise(found.where("line is not null").groupBy("k0", "k1").agg(F.first("line").alias("line")).select("k0", "line"))

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        """Edges of forests of the pairs at or above the threshold, in one job or several."""
        key = group.column("k0").to_numpy()
        sets = _sets(group.column("line").to_pylist(), shingle)
        i, j = alike(sets, *(group.column(c).to_numpy() for c in ("job", "side", "known")), threshold)
        if not len(i):
            return None
        child, root = local_forest(key[i], key[j])
        return pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], ["a", "b"])

    def verified(jobs: DataFrame) -> DataFrame:
        return grouped(jobs.join(texts, F.col("id") == F.col("k0")).select("job", "k0", "side", "known", "line"), "job", ["k0"], compare, "a long, b long", many=COMPARE)

    # Hubs with their lines, in blocks: a hub goes to each of its blocks, a line to one.
    pairs = members.where("id <> hub").groupBy("id").agg(F.min("hub").alias("hub"))
    blocks = pairs.groupBy("hub").agg(blocks_of(F.count(F.lit(1))).alias("blocks"))
    job = lambda block: F.xxhash64(F.col("hub"), block.cast("long")).alias("job")
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select(job(F.col("block")), F.col("hub").alias("id"), F.lit(0).alias("side"))
    others = pairs.join(blocks, "hub").select(job(F.pmod(F.xxhash64("id"), F.col("blocks").cast("long"))), "id", F.lit(1).alias("side"))
    first = components(verified(hubs.unionByName(others).withColumn("known", F.col("id"))))

    # Buckets that still hold several components; of buckets with the same members one.
    placed = members.select("key", "id").join(first, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("known"))
    parted = placed.groupBy("key").agg(F.min("known").alias("low"), F.max("known").alias("high"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("h")).where("low <> high")
    parted = parted.groupBy("n", "h").agg(F.min("key").alias("bucket"))
    rest = placed.join(parted, F.col("key") == F.col("bucket")).withColumn("blocks", blocks_of(F.col("n")))
    rest = verified(spread(rest.select("bucket", "blocks", "id", "known"), F.col("bucket"), F.col("blocks"), F.col("id")))
    joined = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest))
    drop(members, texts)
    firsts = found.where("k0 is not null").join(joined, F.col("k0") == F.col("node"), "left")
    firsts = firsts.select("doc_id", "no", F.coalesce("component", "k0").alias("c"), F.when(F.col("component").isNull(), F.col("k1")).otherwise(F.lit(0)).alias("c1"))
    # Rows at the first place of a component all stay: they are one line of a repeated row.
    order = F.rank().over(W.partitionBy("c", "c1").orderBy("doc_id", "no"))
    gone = firsts.withColumn("order", order).where("order > 1").select("doc_id", "no")
    gone = gone.union(found.where("k0 is null").select("doc_id", "no"))
    removed = materialise(gone.groupBy("doc_id").agg(F.collect_set("no").alias("removed")))
    drop(found)
    return removed


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs with text less its removed lines; all columns and rows stay. A text without removed lines stays as it is, null included."""

    gone = removed.select(F.col("doc_id").alias("__doc"), F.col("removed").alias("__gone")).hint("merge")
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col("__doc"), "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains("__gone", i), x)), lambda x: x.isNotNull())
    text = F.when(F.col("__gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)


def line_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 (of the remaining lines, in UTF-8)."""
    # A merge at any size, so that runs over little tell what larger ones need.
    removed = line_dedup(docs).withColumnRenamed("doc_id", "d").hint("merge")
    rows = documents(docs).join(removed, F.col("doc_id") == F.col("d"), "left").select("doc_id", "text", "removed")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha, gone = [], [], []
            for text, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or ""
                lines = text.split("\n")
                if lost:
                    drop = set(lost)
                    text = "\n".join([x for k, x in enumerate(lines) if k not in drop])
                n.append(len(lines))
                gone.append(len(lost or ()))
                sha.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_lines", "n_removed", "kept_sha256"])

    return rows.mapInArrow(task(digest), "doc_id long, n_lines long, n_removed long, kept_sha256 string")
