"""Hard negatives by a block matrix product over a grid of row and dimension shards.

Rows are cut into blocks and their dimensions into chunks. A cell of the grid
multiplies one chunk of a block of anchors with the same chunk of a block of
rows; the partial tiles of int64 scores are shuffled together by (anchor block,
row block) and added there. Each whole tile is reduced at once to the few best
rows of each anchor (its positives) or of each window that an anchor's positive
opens (its negatives), so only those leave it.

Blocks follow the order of labels: tiles with a common label give positives,
tiles with different labels negatives, and no tile of one label is made twice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bound_batches, grouped, materialise, partitions, task

#: Rows of a block, anchors of a block and dimensions of a chunk: a tile has at most ROWS x ANCHORS scores of 8 bytes.
ROWS = 1024
ANCHORS = 256
DIMS = 32
#: Scaled components beyond this count as this; sums of products wrap at 64 bits, as longs do.
LARGEST = 2.0**62

BLOCK = "block long, chunk int, n int, ids binary, labels binary, kinds array<long>, marks binary, width int, body binary"
ANCHOR_BLOCK = "grp long, chunk int, n int, ids binary, labels binary, kinds array<long>, homes binary, places binary, width int, body binary"


def _quantised(scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """floor(scale * x) of each component, of rows whose components are all finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            finite = np.isfinite(x)
            bad = np.bincount(np.repeat(np.arange(len(size)), size)[~finite], minlength=len(size)) > 0
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(scale * np.where(finite, x, 0)), -LARGEST, LARGEST).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            ok = np.flatnonzero(~bad)
            body = pa.array([q[at[k] : at[k + 1]].tobytes() for k in ok], pa.binary())
            pick = pa.array(ok)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pick) for c in ("vec_id", "label", "anchor")), body], ["vec_id", "label", "anchor", "q"])

    return task(run)


def _packed(rows: np.ndarray) -> tuple[int, bytes]:
    """rows of integers in the fewest bytes that hold them all: bytes a component, and they."""
    low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return width, rows.astype(f"<i{width}").tobytes()


def _unpacked(body: bytes, width: int) -> np.ndarray:
    return np.frombuffer(body, f"<i{width}").reshape(-1, DIMS)


def _chunks(rows: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """The chunks of several vectors, shorter ones filled up with zeros; one chunk at least."""
    size = np.array([len(r) // 8 for r in rows])
    n = max(1, math.ceil(int(size.max()) / DIMS))
    full = np.zeros((len(rows), n * DIMS), np.int64)
    full[np.arange(n * DIMS)[None, :] < size[:, None]] = np.frombuffer(b"".join(rows), np.int64)
    for k in range(n):
        yield k, full[:, k * DIMS : (k + 1) * DIMS]


def _held(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of so many rows, the last of fewer."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while n + batch.num_rows >= rows:
            yield pa.Table.from_batches([*held, batch.slice(0, rows - n)])
            batch, held, n = batch.slice(rows - n), [], 0
        held.append(batch)
        n += batch.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that come in the order of labels; within a block rows are in the order of vec_id, so ties are."""
    made = 0
    for t in _held(batches, ROWS):
        t = t.sort_by([("vec_id", "ascending"), ("label", "ascending")]).combine_chunks()
        ids, labels, marks = (t.column(c).to_numpy() for c in ("vec_id", "label", "anchor"))
        block = (t.column("part")[0].as_py() << 32) + made
        made += 1
        kinds = np.unique(labels).tolist()
        for k, values in _chunks(t.column("q").to_pylist()):
            width, body = _packed(values)
            columns = [[block], [k], [t.num_rows], [ids.tobytes()], [labels.tobytes()], [kinds], [marks.astype(np.uint8).tobytes()], [width], [body]]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types, strict=True)], [c.split()[0] for c in BLOCK.split(", ")])


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors in blocks of rows, each chunk a row."""
    names = ["label", "home", "place", "chunk", "vec_id", "q"]
    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(row["marks"], np.uint8))
            if len(at):
                values = _unpacked(row["body"], row["width"])[at].astype(np.int64)
                ids, labels = (np.frombuffer(row[c], np.int64)[at] for c in ("ids", "labels"))
                columns = [pa.array(labels), pa.array(np.full(len(at), row["block"])), pa.array(at.astype(np.int32)), pa.array(np.full(len(at), row["chunk"], np.int32)), pa.array(ids), pa.array([v.tobytes() for v in values], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)


def _anchor_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors out of rows (part, label, home, place, qs); qs are an anchor's chunks in order."""
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    for made, t in enumerate(_held(batches, ANCHORS)):
        t = t.combine_chunks()
        ids, labels, homes = (t.column(c).to_numpy().tobytes() for c in ("vec_id", "label", "home"))
        places = t.column("place").to_numpy().astype(np.int32).tobytes()
        kinds = np.unique(t.column("label").to_numpy()).tolist()
        for k, values in _chunks([b"".join(q) for q in t.column("qs").to_pylist()]):
            width, body = _packed(values)
            columns = [[(t.column("part")[0].as_py() << 32) + made], [k], [t.num_rows], [ids], [labels], [kinds], [homes], [places], [width], [body]]
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(columns, types, strict=True)], [c.split()[0] for c in ANCHOR_BLOCK.split(", ")])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in int64: in doubles where no sum can leave the integers that these hold, else in longs, which wrap."""
    most = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (a, b)]
    if most[0] * most[1] * DIMS < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A tile of scores for each pair of chunks; what the tile's reduction needs besides comes with the first chunk."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            a, b = (_unpacked(row.column(f"{s}_body")[0].as_py(), row.column(f"{s}_width")[0].as_py()) for s in "ab")
            yield pa.RecordBatch.from_arrays([row.column("cell"), row.column("chunk"), row.column("meta"), pa.array([_product(a, b).tobytes()], pa.binary())], ["cell", "chunk", "meta", "tile"])


def _tiles(pairs: DataFrame, anchors: DataFrame, rows: DataFrame, reduce: Callable[[np.ndarray, dict], pa.RecordBatch | None], schema: str, windows: DataFrame | None = None) -> DataFrame:
    """reduce(tile, meta) over the whole tile of each of the pairs (grp, block), of which partial tiles are made chunk by chunk and added.

    A pair's partial tiles are one group of ceil(dimensions / DIMS) rows, of 2 MB each.
    """
    first = F.col("chunk") == 0
    side_a = anchors.select("grp", "chunk", F.col("width").alias("a_width"), F.col("body").alias("a_body"), *(F.when(first, F.col(c)).alias(f"a_{c}") for c in ("ids", "labels", "homes", "places")))
    opened = "cast(null as array<struct<i:int,slot:int,id:bigint,score:bigint>>)"
    if windows is not None:
        side_a = side_a.join(windows.withColumnRenamed("grp", "g"), F.col("grp") == F.col("g")).drop("g")
        opened = "if(chunk = 0, windows, null)"
    side_b = rows.select(F.col("block").alias("b"), F.col("chunk").alias("c"), F.col("width").alias("b_width"), F.col("body").alias("b_body"), *(F.when(first, F.col(c)).alias(f"b_{c}") for c in ("ids", "labels")))
    met = pairs.join(side_a, "grp").join(side_b, (F.col("block") == F.col("b")) & (F.col("chunk") == F.col("c")))
    meta = F.when(first, F.struct("grp", "block", "a_ids", "a_labels", "a_homes", "a_places", "b_ids", "b_labels", F.expr(opened).alias("windows"))).alias("meta")
    cells = met.select(F.concat_ws(":", "grp", "block").alias("cell"), "chunk", meta, "a_width", "a_body", "b_width", "b_body")
    kind = cells.schema["meta"].dataType.simpleString()
    partial = cells.mapInArrow(task(_partial), f"cell string, chunk int, meta {kind}, tile binary")

    def added(group: pa.Table) -> pa.RecordBatch | None:
        meta = next(m for m in group.column("meta").to_pylist() if m)
        for c in ("a_ids", "a_labels", "a_homes", "b_ids", "b_labels"):
            meta[c] = np.frombuffer(meta[c], np.int64)
        meta["a_places"] = np.frombuffer(meta["a_places"], np.int32)
        total = np.zeros(len(meta["a_ids"]) * len(meta["b_ids"]), np.int64)
        for tile in group.column("tile"):
            total += np.frombuffer(tile.as_buffer(), np.int64)
        return reduce(total.reshape(len(meta["a_ids"]), -1), meta)

    return grouped(partial, "cell", ["chunk"], added, schema)


def _positives(most: int) -> Callable[[np.ndarray, dict], pa.RecordBatch | None]:
    def reduce(tile: np.ndarray, meta: dict) -> pa.RecordBatch | None:
        """Each anchor's best rows of its own label, itself left out."""
        fits = meta["a_labels"][:, None] == meta["b_labels"][None, :]
        here = np.flatnonzero(meta["a_homes"] == meta["block"])
        fits[here, meta["a_places"][here]] = False
        i, j = _best(tile, fits, np.zeros(len(tile), np.int64), most)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(i), meta["grp"])), pa.array(i.astype(np.int32)), pa.array(meta["a_ids"][i]), pa.array(meta["b_ids"][j]), pa.array(tile[i, j])], ["grp", "i", "anchor_id", "id", "score"])

    return reduce


def _negatives(most: int, low: int, high: int) -> Callable[[np.ndarray, dict], pa.RecordBatch | None]:
    def reduce(tile: np.ndarray, meta: dict) -> pa.RecordBatch | None:
        """The best rows of other labels in each window that a positive opens."""
        if not meta["windows"]:
            return None
        other = meta["a_labels"][:, None] != meta["b_labels"][None, :]
        found = []
        for slot in {w["slot"] for w in meta["windows"]}:
            mine = {w["i"]: w for w in meta["windows"] if w["slot"] == slot}
            i = np.array(sorted(mine))
            score = [mine[k]["score"] for k in i]
            # In integers of any size: low * positive <= high * negative <= high * positive.
            least = np.array([max(-(2**63), -(-low * s // high)) for s in score], np.int64)
            part = tile[i]
            fits = other[i] & (part >= least[:, None]) & (part <= np.array(score, np.int64)[:, None])
            a, j = _best(part, fits, np.zeros(len(i), np.int64), most)
            at = i[a]
            found.append([np.full(len(a), meta["grp"]), at.astype(np.int32), np.full(len(a), slot, np.int32), meta["a_ids"][at], np.array([mine[k]["id"] for k in i], np.int64)[a], np.array(score, np.int64)[a], meta["b_ids"][j], part[a, j]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["grp", "i", "slot", "anchor_id", "positive_id", "positive_score", "id", "score"])

    return reduce


def _best(tile: np.ndarray, fits: np.ndarray, start: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the `most` highest scores of each row among those that fit, ties by place."""
    rows = np.flatnonzero(fits.any(axis=1))
    out_i, out_j = [], []
    for i in rows:
        j = np.flatnonzero(fits[i])
        if len(j) > most:
            down = ~tile[i, j]  # in the other order, and of any long
            cut = np.partition(down, most - 1)[most - 1]
            j, down = j[down <= cut], down[down <= cut]
            j = j[np.argsort(down, kind="stable")[:most]]
        out_i.append(np.full(len(j), i))
        out_j.append(j)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.empty(0, np.int64), np.empty(0, np.int64))


def hard_negatives(vectors: DataFrame, anchor: Column | str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label).

    A row's score is the inner product of floor(scale * x) with the anchor's; higher come first, ties by smaller vec_id.
    Anchors are the rows where `anchor` holds, their positives the first `positives` other rows of their label. For each,
    the first `negatives` rows of another label with low * positive <= high * negative <= high * positive are returned.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. A shorter vector counts
    as filled up with zeros, an empty one as zeros. Rows that repeat a vec_id are rows each: one can be another's positive, and a repeated
    anchor's rows are returned for each. Anchors without positives and windows without rows give none; an empty table gives none.
    Scaled components beyond 2**62 count as that, and scores wrap at 64 bits. Other columns are ignored.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(F.expr(anchor) if isinstance(anchor, str) else anchor, F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = named.where("vec_id is not null and label is not null and embedding is not null")
    ready = whole.mapInArrow(_quantised(scale), "vec_id long, label long, anchor boolean, q binary")
    ranges = max(1, min(partitions(spark), math.ceil(vectors.count() / ROWS)))
    ordered = ready.repartitionByRange(ranges, "label", "vec_id").sortWithinPartitions("label", "vec_id").withColumn("part", F.spark_partition_id().cast("long"))
    rows = materialise(ordered.mapInArrow(task(_row_blocks), BLOCK))

    chosen = rows.select("block", "chunk", "ids", "labels", "marks", "width", "body").mapInArrow(task(_anchors_of), "label long, home long, place int, chunk int, vec_id long, q binary")
    each = materialise(chosen.groupBy("label", "home", "place", "vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "q"))), lambda x: x["q"]).alias("qs")))
    ranges = max(1, min(partitions(spark), math.ceil(each.count() / ANCHORS)))
    order = ["label", "home", "place"]
    dealt = each.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long"))
    anchors = materialise(dealt.mapInArrow(task(_anchor_blocks), ANCHOR_BLOCK))

    # A row for each block, not for each vector.
    groups = anchors.where("chunk = 0").select("grp", F.col("kinds").alias("a_kinds"))
    blocks = rows.where("chunk = 0").select("block", "kinds")
    alike = groups.select("grp", F.explode("a_kinds").alias("kind")).join(blocks.select("block", F.explode("kinds").alias("kind")), "kind").select("grp", "block").distinct()
    local = _tiles(alike, anchors, rows, _positives(positives), "grp long, i int, anchor_id long, id long, score long")
    first = F.row_number().over(W.partitionBy("grp", "i").orderBy(F.desc("score"), "id"))
    own = materialise(local.withColumn("slot", first).where(F.col("slot") <= positives))
    windows = own.groupBy("grp").agg(F.collect_list(F.struct("i", "slot", "id", "score")).alias("windows"))

    # Every block of anchors meets every block of rows: the query set against all rows, in blocks.
    parts = blocks.withColumn("part", F.shiftright("block", 32))
    n_parts = (parts.agg(F.max("part")).first()[0] or 0) + 1
    spread = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))
    unlike = spread.join(parts, "part").where(~((F.size("a_kinds") == 1) & (F.size("kinds") == 1) & (F.col("a_kinds") == F.col("kinds")))).select("grp", "block")
    local = _tiles(unlike, anchors, rows, _negatives(negatives, low, high), "grp long, i int, slot int, anchor_id long, positive_id long, positive_score long, id long, score long", windows)
    ranked = local.withColumn("rank", F.row_number().over(W.partitionBy("grp", "i", "slot").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
