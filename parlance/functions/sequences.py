"""Word lists of a session's recognisers compared with each other: kernels as Arrow UDFs over array<array<string>>."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types

#: A list's place (from 0), another's, and what they have in common.
PAIRS = types.ArrayType(types.StructType([types.StructField("i", types.IntegerType()), types.StructField("j", types.IntegerType()), types.StructField("x", types.DoubleType())]))
#: Shortest runs of words that are looked for, in this order.
RUNS = (8, 2, 1)
#: From so many words on, SequenceMatcher leaves out words that are over one in a hundred.
POPULAR = 200


def _numbered(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a number for every word, equal for equal words; where each list begins; which list each row begins with)."""
    inner = lists.flatten()
    ends = lambda x: np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    words = inner.flatten().dictionary_encode()
    return pc.fill_null(words.indices, len(words.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64), ends(inner), ends(lists)


def _every_pair(rows: np.ndarray, value: Callable[[int, int], float]) -> pa.Array:
    """For each row value(p, q) of every two of its lists, in both orders."""
    left, right, found, size = [], [], [], [0]
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        for p in range(a, b):
            for q in range(a, b):
                if p != q:
                    left.append(p - a)
                    right.append(q - a)
                    found.append(value(p, q))
        size.append(len(found))
    items = pa.StructArray.from_arrays([pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(found, pa.float64())], ["i", "j", "x"])
    return pa.ListArray.from_arrays(pa.array(size, pa.int32()), items)


@F.arrow_udf(PAIRS)
def bag_overlaps(lists: pa.Array) -> pa.Array:
    """Words in common, with their number, against the longer list (two empty ones: 1)."""
    words, at, rows = _numbered(lists)
    kinds = int(words.max(initial=0)) + 1
    cells, times = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at)) * kinds + words, return_counts=True)
    first = np.searchsorted(cells, np.arange(len(at)) * kinds)
    word = cells % kinds

    def value(p: int, q: int) -> float:
        longer = int(max(at[p + 1] - at[p], at[q + 1] - at[q]))
        if not longer:
            return 1.0
        x, y = slice(first[p], first[p + 1]), slice(first[q], first[q + 1])
        _, i, j = np.intersect1d(word[x], word[y], assume_unique=True, return_indices=True)
        return int(np.minimum(times[x][i], times[y][j]).sum()) / longer

    return _every_pair(rows, value)


@F.arrow_udf(PAIRS)
def sequence_similarities(lists: pa.Array) -> pa.Array:
    """Ratcliff-Obershelp similarity of every two lists, as difflib.SequenceMatcher(None, a, b).ratio() has it (two empty ones: 1)."""
    words, at, rows = _numbered(lists)
    size = np.diff(at)
    _, cell, times = np.unique(np.repeat(np.arange(len(size)), size) * (int(words.max(initial=0)) + 1) + words, return_inverse=True, return_counts=True)
    longest = np.repeat(np.where(size >= POPULAR, size // 100 + 1, size), size)
    popular = np.concatenate([[0], np.cumsum(times[cell.ravel()] > longest)])
    grams = {1: words}
    k = 1
    while k < RUNS[0]:
        g = grams[k]
        ahead = np.full(len(g), -1)
        ahead[: max(len(g) - k, 0)] = g[k:]
        _, number = np.unique(g * (int(g.max(initial=0)) + 2) + ahead + 1, return_inverse=True)
        k *= 2
        grams[k] = number.ravel()
    plain = {k: np.concatenate([popular[k:] == popular[:-k], np.zeros(k - 1, bool)]) if len(popular) > k else np.zeros(len(words), bool) for k in RUNS}
    as_list = words.tolist()

    def value(p: int, q: int) -> float:
        a, b = (int(at[p]), int(at[p + 1])), (int(at[q]), int(at[q + 1]))
        total = a[1] - a[0] + b[1] - b[0]
        return 2.0 * _matches(as_list, grams, plain, a, b) / total if total else 1.0

    return _every_pair(rows, value)


def _matches(words: list[int], grams: dict[int, np.ndarray], plain: dict[int, np.ndarray], a: tuple[int, int], b: tuple[int, int]) -> int:
    """Words that blocks match: the longest run (of equals the first in a, then in b) parts what is left of it from what is right of it, and so on in both.

    Runs are taken from the longest, whichever part they lie in: parts don't meet, so their order changes nothing. A run that parts cut goes back with
    what is left of it. Short runs are looked for only within the parts that long ones leave, so the work grows about as the lists do.
    """
    parts = [[x] for x in (*a, *b)] if a[0] < a[1] and b[0] < b[1] else [[], [], [], []]
    a_lo, a_hi, b_lo, b_hi = parts
    total = 0
    for k in RUNS:
        heap = list(_runs(grams[k], plain[k], k, *(np.array(x, np.int64) for x in parts)))
        heapify(heap)
        while heap:
            minus, i, j = heappop(heap)
            end, d = i - minus, j - i
            r = max(bisect_right(a_lo, i) - 1, 0)
            while r < len(a_lo) and a_lo[r] < end:
                lo, hi = max(i, a_lo[r], b_lo[r] - d), min(end, a_hi[r], b_hi[r] - d)
                if hi - lo == -minus:
                    # Popular words beside a run belong to it.
                    while lo > a_lo[r] and lo + d > b_lo[r] and words[lo - 1] == words[lo + d - 1]:
                        lo -= 1
                    while hi < a_hi[r] and hi + d < b_hi[r] and words[hi] == words[hi + d]:
                        hi += 1
                    total += hi - lo
                    new = [x for x in ((a_lo[r], lo, b_lo[r], lo + d), (hi, a_hi[r], hi + d, b_hi[r])) if x[0] < x[1] and x[2] < x[3]]
                    for n, part in enumerate(parts):
                        part[r : r + 1] = [x[n] for x in new]
                    break
                if hi - lo >= k:
                    heappush(heap, (lo - hi, lo, lo + d))
                r += 1
    for i, i_end, j, j_end in zip(*parts, strict=True):
        while i < i_end and j < j_end and words[i] == words[j]:
            i, j, total = i + 1, j + 1, total + 1
    return total


def _runs(gram: np.ndarray, plain: np.ndarray, k: int, a_lo: np.ndarray, a_hi: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(-length, place in a, place in b) of the runs of k and more equal words, popular ones left out, within the parts."""

    def places(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.maximum(hi - lo - k + 1, 0)
        return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(np.arange(len(n)), n)

    x, part = places(a_lo, a_hi)
    y, other = places(b_lo, b_hi)
    y, other = y[plain[y]], other[plain[y]]
    # No number is over the number of words.
    key, own = other * (len(gram) + 1) + gram[y], part * (len(gram) + 1) + gram[x]
    order = np.argsort(key, kind="stable")
    key, y = key[order], y[order]
    first = np.searchsorted(key, own)
    n = np.searchsorted(key, own, "right") - first
    i = np.repeat(x, n)
    if not len(i):
        return iter(())
    of = np.repeat(part, n)
    j = y[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    order = np.lexsort((i, j - i))
    i, j, of = i[order], j[order], of[order]
    new = np.ones(len(i), bool)
    new[1:] = (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1) | (of[1:] != of[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate([begin, [len(i)]])) + k - 1
    return zip((-length).tolist(), i[begin].tolist(), j[begin].tolist(), strict=True)
