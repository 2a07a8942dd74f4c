"""Shared building blocks: table access, materialisation, byte and word kernels."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in slices of about this many bytes, cut between texts.
SLICE_BYTES = 1_000_000

#: Odd multipliers of the two independent halves of a 128-bit hash.
LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

#: ASCII white space: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes of a batch between the JVM and Python: whole texts are long, and both sides hold several batches at once.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit of an Arrow batch's bytes to ours where it is higher."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).lower().rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def task(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """fn for mapInArrow; at a task's end its worker, which is kept for later tasks, gives free memory back to the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where it is unset (tests) one in the warehouse, which they share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/parlance-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Spark's setting by which a query's shuffle files go when it ends; without it they stay until the driver's JVM happens to collect their handles.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: lineage ends there, a lost executor costs a reread, and the shuffle files go at once."""
    conf = df.sparkSession.conf
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def written() -> int:
    """How many tables materialise() has written so far."""
    return len(_WRITTEN)


def discard(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Delete the tables written since then that nothing needs any more: all but those that `keep` reads."""
    needed = [f.rsplit("/", 1)[0].split(":", 1)[-1].rstrip("/") for f in keep.inputFiles()]
    for path in _WRITTEN[since:]:
        if not any(n.endswith(path.split(":", 1)[-1].rstrip("/")) for n in needed):
            _delete(spark, path)


def drop(*tables: DataFrame) -> None:
    """Delete tables as materialise() returned them, which nothing needs any more."""
    names = {f.rsplit("/", 2)[-2] for t in tables for f in t.inputFiles()}
    for path in [p for p in _WRITTEN if p.rsplit("/", 1)[-1] in names]:
        _delete(tables[0].sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _WRITTEN.remove(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined_hash(a: np.ndarray, b: np.ndarray, lane: int = 0) -> np.ndarray:
    """A hash of two neighbours; the shift between products keeps it from being a polynomial, whose collisions don't depend on the multiplier."""
    out = a ^ (a >> np.uint64(29))
    out *= LANES[lane]
    out += b
    return out


def grams_hash(symbols: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """64-bit hashes of every k consecutive symbols, by doubling. Equal strings hash alike; what must not be taken for equal is compared besides."""
    if len(symbols) < k:
        return np.empty(0, np.uint64)
    power = symbols.astype(np.uint64)
    power += np.uint64(0x51ED27)
    power *= LANES[1 - lane]
    have, out, done = 1, None, 0
    while True:
        if k & have:
            out, done = (power, have) if out is None else (joined_hash(power[: len(power) - done], out[have:], lane), done + have)
            if done == k:
                return mix(out)
        power = joined_hash(power[:-have], power[have:], lane)
        have *= 2


def words_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of byte strings: eight bytes a round, multiplied and shifted, their length last. Both lanes together are a 128-bit hash of the bytes."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    size = end - start
    out = np.full(len(start), LANES[1 - lane], np.uint64)
    todo = np.arange(len(start))
    at, left = start, size
    while len(todo):
        block = eight[at] & _MASK[np.minimum(left, 8)]
        now = (out[todo] if len(todo) < len(out) else out) ^ block
        now *= LANES[lane]
        now ^= now >> np.uint64(31)
        out[todo] = now
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return mix(out + size.astype(np.uint64) * LANES[1 - lane])


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as bytes and offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0] if len(at) else np.zeros(1, np.int64)


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes, a row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = b


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of several texts: byte spans, each text's range, and both halves of 128-bit hashes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, hashed: int = 2):
        inside = ~SPACE[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(raw))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.range = np.searchsorted(self.start, offsets)
        self.hash = [words_hash(raw, self.start, self.end, lane) for lane in range(hashed)]


def shingles(words: Words, n: int = 5) -> tuple[list[np.ndarray], np.ndarray]:
    """128-bit hashes (two halves) of n consecutive words, and the range of each text; a text of 1 to n-1 words has one shingle, all its words."""
    at = words.range
    count = np.diff(at)
    many = np.maximum(0, count - n + 1)
    out = np.concatenate([[0], np.cumsum(np.where((count > 0) & (count < n), 1, many))]).astype(np.int64)
    long, few = np.flatnonzero(many), np.flatnonzero((count > 0) & (count < n))
    before = np.cumsum(many[long]) - many[long]
    step = np.arange(many[long].sum())
    take = np.repeat(at[:-1][long] - before, many[long]) + step
    put = np.repeat(out[:-1][long] - before, many[long]) + step
    found = []
    for lane, h in enumerate(words.hash):
        flat = np.empty(out[-1], np.uint64)
        flat[put] = grams_hash(h, n, lane)[take] if len(take) else 0
        # Fewer words than n: folded from the first on, with their number, one round for all texts.
        value = count[few].astype(np.uint64)
        for k in range(n - 1):
            on = np.flatnonzero(count[few] > k)
            value[on] = joined_hash(value[on], h[at[few[on]] + k], lane)
        flat[out[few]] = mix(value)
        found.append(flat)
    return found, out


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys in batches that are sorted by it; only one group is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def grouped(df: DataFrame, key: str, order: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str, many: int = 0) -> DataFrame:
    """fn over each group of a bounded size, streamed from sorted partitions; its results are gathered into larger batches. With `many`, fn gets several whole groups at once, of that many rows or some more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []
        rows = 0
        for group in runs_of_groups(batches, key, many) if many else groups(batches, key):
            out = fn(group)
            if out is not None and out.num_rows:
                ready.append(out)
                rows += out.num_rows
            if rows >= 10_000 or len(ready) >= 2_000:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready, rows = [], 0
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    n = partitions(df.sparkSession)
    return df.repartition(n, key).sortWithinPartitions(key, *order).mapInArrow(task(run), schema)


def runs_of_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups out of batches that are sorted by key, each of so many rows at least (but the last); only one is held at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in (b.slice(k, rows) for b in batches for k in range(0, b.num_rows, rows)):
        if held and size >= rows:
            differs = np.flatnonzero(batch.column(key).to_numpy(zero_copy_only=False) != held[-1].column(key)[-1].as_py())
            cut = int(differs[0]) if len(differs) else batch.num_rows
            held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            batch = batch.slice(cut)
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns, of whatever name, are left behind."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2**bits over the leading bits of the 64-bit column `key`, built in parts on the executors; of one size for any input."""
    low = 16  # bits of a key within a part

    def part(group: pa.Table) -> pa.RecordBatch:
        flags = np.zeros(1 << low, np.uint8)
        flags[group.column("bit").to_numpy() & ((1 << low) - 1)] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([group.column("part")[0].as_py()], pa.int64()), pa.array([packed], pa.binary())], ["part", "bits"])

    bit = F.shiftrightunsigned("key", 64 - bits)
    rows = keys.select(bit.alias("bit"), F.shiftright(bit, low).alias("part")).distinct()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in grouped(rows, "part", [], part, "part long, bits binary").toLocalIterator():
        out[row["part"] << (low - 3) : (row["part"] + 1) << (low - 3)] = np.frombuffer(row["bits"], np.uint8)
    return out


def in_bitmap(flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap: all that are, and others alike in the leading bits."""
    bits = len(flags).bit_length() + 2
    at = (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return ((flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def with_columns(df: DataFrame, columns: list[str], fn: Callable[[pa.RecordBatch], list[pa.Array]], extra: str) -> DataFrame:
    """The named columns of df and those that fn makes of each batch (extra: their schema, of other names)."""
    kept = df.select(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), extra])
    names = [*columns, *(x.split()[0] for x in extra.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(part)], names)

    return kept.mapInArrow(task(run), schema)
