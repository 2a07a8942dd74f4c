"""Near-duplicate vectors by sorted projection passes.

Each pass orders the distinct vectors of each label lexicographically by
concatenated random sign hashes (each bit a new hyperplane) and compares every
vector with a window of neighbours; pairs at or above the threshold are united
across passes. Vectors that share a pass's leading bits are all compared: where
more share them than a window holds, as in a dense label, block by block. Within the components this finds, each vector's direct links are
then counted block by block, so a group larger than any window is counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import grouped, materialise, partitions, task
from .components import components, local_forest
from .minhash import blocks_of, spread

THRESHOLD = 0.93
#: Neighbours on either side that a pass compares a vector with.
WINDOW = 256
#: Probability with which a pair at the threshold meets in some pass.
RECALL = 0.9999
SIGN_BITS = 62
SEED = 11
#: Places of the order in a task's chunk.
CHUNK = 4096


def leading_bits(rows: int, window: int = WINDOW) -> int:
    """The bits that would cut rows down to half a window if each halved them."""
    return min(SIGN_BITS, max(0, math.ceil(math.log2(max(1, rows) / (window / 2)))))


def passes(rows: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes in one of which a pair at the threshold shares the leading bits, with the probability recall. All that shares them is compared, however many rows do."""
    meet = (1 - math.acos(threshold) / math.pi) ** leading_bits(rows, window)
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - min(meet, 0.9))))


def _unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the rows that can link, and which these are: not null, not zero, all components finite."""
    rows = column.to_pylist()
    ok = np.array([bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v) for v in rows], bool)
    if not ok.any():
        return np.empty((0, 0)), ok
    v = np.array([r for r, k in zip(rows, ok, strict=True) if k], np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True)), ok


def _floats(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of one label, not null, and of one dimension are compared, by cosine in double
    precision. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. n_links counts the other vectors linked directly, component_id is
    the smallest vec_id that links reach, kept marks it. Rows that repeat a vec_id count each. A row without a vec_id
    links with nothing and is kept, with a null component_id; other columns are ignored; an empty table gives no rows.
    """
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    rows = every.where("vec_id is not null")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label = batch.column(0), batch.column(2)
            sizes = np.array([len(v) if v is not None else 0 for v in batch.column(1).to_pylist()])
            for size in np.unique(sizes):
                pick = pa.array(np.flatnonzero(sizes == size))
                units, ok = _unit(batch.column(1).take(pick))
                packed = iter(units)
                unit = [next(packed).tobytes() if k else None for k in ok]
                group = [f"{size}:{v}" if v is not None and k else None for v, k in zip(label.take(pick).to_pylist(), ok, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pick), pa.array(group, pa.string()), pa.array(unit, pa.binary())], ["vec_id", "grp", "unit"])

    found = materialise(rows.mapInArrow(task(prepare), "vec_id long, grp string, unit binary"))
    usable = found.where("grp is not null and unit is not null")
    # Equal vectors are one class, so a window is not filled with copies.
    classes = materialise(usable.groupBy("grp", "unit").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    # A pass needs as many leading bits as the largest label has rows.
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.agg(F.max("size")).first()[0] or 0
    rounds = passes(largest, threshold, window, recall)
    n_tasks = partitions(vectors.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weigh = np.uint64(1) << np.arange(SIGN_BITS - 1, -1, -1, dtype=np.uint64)
        for batch in batches:
            sizes = np.array([int(g.split(":")[0]) for g in batch.column("grp").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                v = _floats(part.column("unit"), size)
                if size not in planes:
                    planes[size] = np.random.default_rng([SEED, int(size)]).standard_normal((size, rounds * SIGN_BITS))
                signs = v @ planes[size] >= 0
                for r in range(rounds):
                    code = signs[:, r * SIGN_BITS : (r + 1) * SIGN_BITS] @ weigh
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, r, np.int32)), part.column("grp"), pa.array(code.astype(np.int64)), part.column("rep"), part.column("unit")], ["pass", "grp", "code", "rep", "unit"])

    coded = classes.select("grp", "rep", "unit").mapInArrow(task(hashed), "pass int, grp string, code long, rep long, unit binary")
    ordered = materialise(_ordered(coded, n_tasks))
    edges = materialise(_windows(ordered, threshold, window).unionByName(_long_runs(ordered, classes, sizes, threshold, window)))
    joined = components(edges)

    blocks = joined.groupBy("component").agg(blocks_of(F.count(F.lit(1))).alias("blocks"))
    members = joined.join(blocks, "component").join(classes, F.col("node") == F.col("rep"))
    jobs = spread(members.select("component", "blocks", "rep", "n", "unit"), F.col("component"), F.col("blocks"), F.col("rep"))

    def count(group: pa.Table) -> pa.RecordBatch:
        rep, n, side = (group.column(c).to_numpy() for c in ("rep", "n", "side"))
        v = _floats(group.column("unit"), len(group.column("unit")[0].as_py()) // 8)
        near = v @ v.T >= threshold
        near &= (side[:, None] == 2) | (side[:, None] != side[None, :])
        np.fill_diagonal(near, False)
        return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(near.astype(np.int64) @ n)], ["r", "links"])

    links = grouped(jobs.select("job", "rep", "n", "unit", "side"), "job", ["rep"], count, "r long, links long").groupBy("r").agg(F.sum("links").alias("links"))
    per = classes.join(links, F.col("rep") == F.col("r"), "left").join(joined, F.col("rep") == F.col("node"), "left")
    per = per.select(F.col("grp").alias("g"), F.col("unit").alias("u"), F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = found.join(per, (F.col("grp") == F.col("g")) & (F.col("unit") == F.col("u")), "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
    return out.unionByName(every.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def _ordered(coded: DataFrame, n_tasks: int) -> DataFrame:
    """coded in the order of all passes: with the part of the order that a row is in, and its place there."""
    order = ["pass", "grp", "code", "rep"]
    ordered = coded.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("range", F.spark_partition_id()).withColumn("within", within)


def _long_runs(ordered: DataFrame, classes: DataFrame, sizes: DataFrame, threshold: float, window: int) -> DataFrame:
    """Edges of forests of the pairs at or above the threshold among rows that share a pass's leading bits, where more do than a window holds.

    Sign hashes cut a dense label badly: where its runs have as many pairs as the
    whole label, the label is compared once instead, and no pair is left to chance.
    """
    n = F.col("size") / F.lit(window / 2)
    bits = F.least(F.lit(SIGN_BITS), F.greatest(F.lit(0), F.ceil(F.log2(n)).cast("int")))
    by_bits = sizes.select(F.col("grp").alias("g"), "size", bits.alias("bits"))
    prefixed = ordered.join(by_bits, F.col("grp") == F.col("g")).withColumn("prefix", F.expr(f"shiftrightunsigned(code, {SIGN_BITS} - bits)"))
    runs = prefixed.groupBy("grp", "pass", "prefix").agg(F.count(F.lit(1)).alias("run")).where(F.col("run") > window + 1)
    runs = materialise(runs.join(by_bits, F.col("grp") == F.col("g")).select("grp", "pass", "prefix", "run", "size", "bits"))
    cost = runs.groupBy("grp", "size").agg(F.sum(F.col("run").cast("double") ** 2).alias("cost"))
    cost = cost.select(F.col("grp").alias("g"), F.col("size").alias("run"), (F.col("cost") >= F.col("size").cast("double") ** 2).alias("whole"))
    whole = classes.join(cost.where("whole"), F.col("grp") == F.col("g")).select("rep", "unit", "run", F.xxhash64("grp").alias("cluster"))
    parts = runs.join(cost.where("not whole").select("g"), F.col("grp") == F.col("g"), "left_semi")
    parts = parts.select(F.col("grp").alias("g"), F.col("pass").alias("p"), F.col("prefix").alias("x"), "run", F.col("bits").alias("cut"))
    at = F.expr(f"shiftrightunsigned(code, {SIGN_BITS} - cut)")
    parts = ordered.join(parts, (F.col("grp") == F.col("g")) & (F.col("pass") == F.col("p")) & (at == F.col("x")))
    members = whole.unionByName(parts.select("rep", "unit", "run", F.xxhash64("g", "p", "x").alias("cluster")))
    jobs = spread(members.withColumn("blocks", blocks_of(F.col("run"))), F.col("cluster"), F.col("blocks"), F.col("rep"))

    def compare(group: pa.Table) -> pa.RecordBatch:
        rep, side = (group.column(c).to_numpy() for c in ("rep", "side"))
        v = _floats(group.column("unit"), len(group.column("unit")[0].as_py()) // 8)
        near = np.tril(v @ v.T >= threshold, -1)
        near &= (side[:, None] == 2) | (side[:, None] != side[None, :])
        i, j = np.nonzero(near)
        child, root = local_forest(rep[i], rep[j])
        return pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], ["a", "b"])

    return grouped(jobs.select("job", "rep", "unit", "side"), "job", ["rep"], compare, "a long, b long")


def _windows(ordered: DataFrame, threshold: float, window: int) -> DataFrame:
    """Edges of a forest of the pairs at or above the threshold within `window` places of each other, in every pass and label.

    Every row gets its place in the order of all passes; rows go to chunks of
    places, the last window of a chunk also to the next, so a chunk is one task's
    however many rows share a label or a code.
    """
    counts = ordered.groupBy("range").count()  # a row for each range
    base = counts.select(F.col("range").alias("r"), (F.sum("count").over(W.orderBy("range")) - F.col("count")).alias("base"))
    placed = ordered.join(base, F.col("range") == F.col("r")).withColumn("place", F.col("base") + F.col("within"))
    mine, to = F.floor(F.col("place") / CHUNK), F.col("place") % CHUNK
    chunks = placed.withColumn("chunk", F.explode(F.when(to >= CHUNK - window, F.array(mine, mine + 1)).otherwise(F.array(mine))))

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        group = group.combine_chunks()
        keys = np.array([f"{p}|{g}" for p, g in zip(group.column("pass").to_pylist(), group.column("grp").to_pylist(), strict=True)])
        reps = group.column("rep").to_numpy()
        units = group.column("unit").to_pylist()
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        found: list[np.ndarray] = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            v, rep = np.frombuffer(b"".join(units[a:b]), np.float64).reshape(b - a, -1), reps[a:b]
            for x in range(0, b - a, window):
                lo = max(0, x - window)
                i, j = np.nonzero(v[x : x + window] @ v[lo : x + window].T >= threshold)
                i, j = i + x, j + lo
                near = (j < i) & (i - j <= window)
                found.append(np.stack([rep[i[near]], rep[j[near]]]))
        child, root = local_forest(*np.concatenate(found, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], ["a", "b"])

    return grouped(chunks.select("chunk", "place", "pass", "grp", "rep", "unit"), "chunk", ["place"], compare, "a long, b long")
