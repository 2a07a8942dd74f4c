"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Segments (see segments.py) bring together, in one task, all strings that can
hold a repeat. There the suffixes that are smaller than their successors are
sorted directly; the others are induced by one scan over the buckets of first
bytes; and common prefixes of neighbours tell which strings of the full width
occur elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer, documents, slices, task
from .segments import Plan, Slice, covered, identified, repeats, runs, with_runs

#: Bytes of a string that counts as a repeat, and of the strings that segments are chosen by.
WIDTH, GRAM = 200, 48


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = padded[: len(text)].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last is not."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    out = np.zeros(n, bool)
    if len(differs):
        at = np.searchsorted(differs, np.arange(differs[-1] + 1))
        out[: differs[-1] + 1] = text[differs[at]] < text[differs[at] + 1]
    return out


def sort_directly(text: np.ndarray, places: np.ndarray, depth: int, words: np.ndarray) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes: eight bytes a round, only ties go on."""
    n = len(text)
    order = places[np.argsort(words[places], kind="stable")]
    rank_break = np.concatenate([[True], words[order[1:]] != words[order[:-1]]]) if len(order) else np.empty(0, bool)
    for at in range(8, depth, 8):
        tied = ~rank_break
        tied[:-1] |= ~rank_break[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(rank_break)[where]
        reach = order[where] + at
        value = np.where(reach < n, words[np.minimum(reach, n - 1)], 0)
        by = np.lexsort((value, group))
        order[where] = order[where][by]
        value, group = value[by], group[by]
        rank_break[where[1:]] |= (group[1:] != group[:-1]) | (value[1:] != value[:-1])
    return order


def suffix_array(text: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Places of all suffixes, in the order of their first `depth` bytes at least (uint8 text)."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    rising = smaller_than_next(text)
    direct = sort_directly(text, np.flatnonzero(rising), depth, _words(text))
    edges = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        level = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        own = [level]
        while len(level):  # c followed by a suffix of this very bucket
            before = level[level > 0] - 1
            level = before[(text[before] == c) & ~rising[before]]
            own.append(level)
        own.append(direct[edges[c] : edges[c + 1]])
        bucket = np.concatenate(own)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & ~rising[before]]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            ends = np.flatnonzero(np.diff(text[before])) + 1
            for part in np.split(before, ends):
                waiting[text[part[0]]].append(part)
    return np.concatenate(out)


def equal_neighbours(text: np.ndarray, order: np.ndarray, width: int, words: np.ndarray) -> np.ndarray:
    """Whether each suffix has its first `width` bytes in common with the one before; only pairs alike so far are compared on."""
    same = np.zeros(len(order), bool)
    x = np.arange(1, len(order))
    for at in [*range(0, width - 8, 8), width - 8]:
        x = x[words[order[x] + at] == words[order[x - 1] + at]]
    same[x] = True
    return same


def _symbols(column: pa.Array) -> Iterator[Slice]:
    raw, at = buffer(column)
    for a, b in slices(at):
        part = raw[at[a] : at[b]]
        yield Slice(a, b, part, at[a : b + 1] - at[a], part)


def repeated_strings(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, a, n): runs of n places, from byte a on, where a string of `width` bytes starts that also starts anywhere else."""

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        body = group.column("body").to_pylist()
        n = group.column("n").to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum([len(x) for x in body])]).astype(np.int64)
        text = np.frombuffer(b"".join(body), np.uint8)
        starts = np.zeros(len(text), bool)
        for a, count in zip(at[:-1].tolist(), n.tolist(), strict=True):
            starts[a : a + count] = True
        order = suffix_array(text, width)
        order = order[starts[order]]
        same = equal_neighbours(text, order, width, _words(text))
        hit = same.copy()
        hit[:-1] |= same[1:]
        flags = np.zeros(len(text), bool)
        flags[order[hit]] = True
        a, count = runs(flags)
        # A run may cross from one content into the next only if both touch: contents are longer than their starts, so none does.
        of = np.searchsorted(at, a, "right") - 1
        start = group.column("start").to_numpy()[of] + (a - at[of])
        columns = (group.column("doc_id").to_numpy()[of], group.column("text_key").to_numpy()[of], start.astype(np.int32), count.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc_id", "text_key", "a", "n"])

    return repeats(docs, Plan(width, gram), _symbols, compare, False)


def suffix_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row of docs (doc_id, text): removed are the maximal removed byte runs as (start, end), kept the remaining bytes.

    Texts are UTF-8 bytes, null is empty; every byte covered by a string of `width` bytes that also starts anywhere
    else, in the same text too, goes; matches never cross texts. Shorter texts
    stay whole. Rows that repeat a doc_id, and rows without one, are occurrences of their own; other columns
    are ignored; an empty table gives no rows.
    """
    docs = identified(documents(docs))
    rows = with_runs(docs, repeated_strings(docs, width, gram))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffer(batch.column(1))
            lists = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            sizes, spans, kept = [], [], []
            for k, (a, n) in enumerate(lists):
                text = raw[at[k] : at[k + 1]]
                gone = covered(len(text), a, n, width)
                x, long = runs(gone)
                sizes.append(len(text))
                spans.append([{"start": s, "end": s + m} for s, m in zip(x.tolist(), long.tolist(), strict=True)])
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "removed", "kept"],
            )

    return rows.mapInArrow(task(remove), "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def suffix_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return suffix_dedup(docs).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

