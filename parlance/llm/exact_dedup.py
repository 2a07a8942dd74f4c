"""Exact deduplication by sorting contents.

Texts are lower-cased (A-Z only) and compared as bytes. Equal texts of one batch
become one row before anything is shuffled. These rows are dealt by splitters,
sampled from the texts' first bytes and hashes, to ranges that sort externally;
in each range equal texts are neighbours and are found by full comparison.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer, documents, materialise, partitions, slices, task

#: Bytes of a text in a splitter; texts alike up to there are told apart by their hash.
SPLITTER_BYTES = 256
#: Sampled texts for each range, on average.
SAMPLE_PER_RANGE = 40

REP = "pid int, head binary, h long, body binary, sha string, ids array<long>, best long, at int"


def _lowered(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    keys = batch.column(0).to_pylist()
    raw, at = buffer(batch.column(1))
    for a, b in slices(at, 8_000_000):
        low = raw[at[a] : at[b]].tobytes().lower()  # bytes.lower() changes A-Z only
        cut = (at[a : b + 1] - at[a]).tolist()
        yield keys[a:b], [low[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _head(body: bytes) -> tuple[bytes, int]:
    return body[:SPLITTER_BYTES], xxhash.xxh3_64_intdigest(body) >> 1


def splitters(docs: DataFrame, ranges: int) -> list[tuple[bytes, int]]:
    """ranges - 1 cut points from a sample of SAMPLE_PER_RANGE texts a range, each of SPLITTER_BYTES and a hash: a few MB at most for any input."""
    wanted = ranges * SAMPLE_PER_RANGE
    count = docs.count()

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, bodies in _lowered(batch):
                found = [_head(x) for x in bodies]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.int64())], ["head", "h"])

    share = min(1.0, 1.2 * wanted / max(1, count))
    sample = docs.where(F.abs(F.xxhash64("doc_id", F.lit(17))) % 1_000_000 < F.lit(int(1_000_000 * share) + 1))
    rows = sorted((bytes(x.head), x.h) for x in sample.mapInArrow(task(heads), "head binary, h long").limit(4 * wanted).collect())
    return [rows[len(rows) * k // ranges] for k in range(1, ranges)] if len(rows) >= ranges else rows


def exact_dedup(docs: DataFrame, keep: str = "max") -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    keep is "max" or "min": which doc_id of equal texts stays. Null counts as the
    empty text. Rows that repeat a doc_id and a text are counted each, and only
    one of them is kept. A null doc_id comes after all others in the order of preference: a row without one
    stays (keep_id null) only if no equal text has one. Other columns are
    ignored; an empty table gives no rows. Texts of any length are compared in full.
    """
    docs = documents(docs)
    spark = docs.sparkSession
    ranges = partitions(spark)
    cuts = splitters(docs, ranges)
    choose = max if keep == "max" else min

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, bodies in _lowered(batch):
                members: dict[bytes, list[int]] = {}
                for key, body in zip(keys, bodies, strict=True):
                    members.setdefault(body, []).append(key)  # a dict of bytes compares whole texts
                heads = [_head(x) for x in members]
                best = [choose((k for k in x if k is not None), default=None) for x in members.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bisect.bisect_right(cuts, x) for x in heads], pa.int32()),
                        pa.array([x for x, _ in heads], pa.binary()),
                        pa.array([x for _, x in heads], pa.int64()),
                        pa.array(list(members), pa.binary()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in members], pa.string()),
                        pa.array(list(members.values()), pa.list_(pa.int64())),
                        pa.array(best, pa.int64()),
                        pa.array([x.index(b) for x, b in zip(members.values(), best, strict=True)], pa.int32()),
                    ],
                    ["pid", "head", "h", "body", "sha", "ids", "best", "at"],
                )

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their content: each gets the group of the neighbour that it equals."""
        last: pa.Scalar | None = None
        group = None
        for batch in batches:
            body = batch.column("body")
            raw, at = buffer(body)
            size = np.diff(at)
            best = batch.column("best").to_pylist()
            sha = batch.column("sha").to_pylist()
            out = []
            for k in range(batch.num_rows):
                mine = raw[at[k] : at[k + 1]]
                if last is None or len(last) != size[k] or not np.array_equal(last, mine):
                    group = f"{sha[k]}:{best[k]}"
                out.append(group)
                last = mine
            if last is not None:
                last = last.copy()
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *(batch.column(n) for n in ("sha", "ids", "best", "at"))], ["grp", "sha", "ids", "best", "at"])

    reps = docs.mapInArrow(task(local), REP)
    dealt = reps.repartitionById(ranges, F.col("pid")).sortWithinPartitions("head", "body").drop("head", "h", "pid")
    found = dealt.mapInArrow(task(neighbours), "grp string, sha string, ids array<long>, best long, at int")
    found = materialise(found.withColumn("uid", F.monotonically_increasing_id()))
    # A null comes last; the row that stays is told by its batch, too, in case others repeat its doc_id.
    named = F.col("best").isNotNull() if keep == "max" else F.col("best").isNull()
    stays = (F.max if keep == "max" else F.min)(F.struct(named.alias("named"), "best", "uid")).alias("stays")
    sizes = found.groupBy("grp").agg(stays, F.sum(F.size("ids")).alias("group_size"))
    out = found.join(sizes, "grp").select("sha", F.col("stays.best").alias("keep_id"), (F.col("stays.uid") == F.col("uid")).alias("here"), "group_size", F.posexplode("ids").alias("no", "doc_id"), "at")
    kept = F.col("here") & (F.col("no") == F.col("at"))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))
