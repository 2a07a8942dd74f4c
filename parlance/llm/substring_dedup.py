"""Removal of repeated word windows with suffix automata.

Segments (see segments.py) shard the reference, which is the corpus itself, so
that a window and all its earlier occurrences meet in one shard. A shard's
contents stream, in order of their first place, through a suffix automaton that
has read all before them: its matching statistics (for each word, how many words up to it also
occur earlier) mark the windows to remove, and the automaton then takes the word in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SPACE, Words, buffer, documents, slices, task
from .segments import Plan, Slice, covered, identified, repeats, runs, with_runs

#: Words of a window, and of the strings that segments are chosen by.
WINDOW, GRAM = 20, 6


class Automaton:
    """A suffix automaton of several word sequences, read one word at a time."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, to: dict[bytes, int]) -> int:
        self.next.append(to)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _target(self, p: int, q: int, word: bytes) -> int:
        """The state for p's strings followed by word: q, or a clone of q if q holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def read(self, words: list[bytes]) -> list[int]:
        """Takes in a sequence; for each word, how many words up to it, within the sequence, occurred earlier."""
        out = []
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._target(last, self.next[last][word], word)
                out.append(self.length[last])
                continue
            state = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                self.link[state] = self._target(p, self.next[p][word], word)
            out.append(self.length[self.link[state]])
            last = state
        return out


def _symbols(column: pa.Array) -> Iterator[Slice]:
    """Words by a hash, which only finds candidates, and their bytes with one space after each."""
    raw, at = buffer(column)
    for a, b in slices(at):
        part = raw[at[a] : at[b]]
        words = Words(part, at[a : b + 1] - at[a], hashed=1)
        size = words.end - words.start
        hi = np.cumsum(size + 1) - 1
        plain = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
        inside = np.ones(len(plain), bool)
        inside[hi] = False
        plain[inside] = part[~SPACE[part]]
        yield Slice(a, b, words.hash[0], words.range, plain, hi - size, hi)


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, a, n): runs of n windows, from word a on, that also start earlier (smaller doc_id, or earlier in the same document)."""

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        found: list[tuple[int, int, int, int]] = []
        last, place, automaton = None, None, Automaton()
        for key, doc_id, text_key, start, n, body in zip(*(group.column(c).to_pylist() for c in ("key", "doc_id", "text_key", "start", "n", "body")), strict=True):
            if key != last:
                last, place, automaton = key, None, Automaton()
            if place == (doc_id, text_key, start):
                continue  # a row that repeats another
            place = (doc_id, text_key, start)
            match = np.array(automaton.read(body.split(b" ")))
            a, count = runs(match[window - 1 : window - 1 + n] >= window)
            found += [(doc_id, text_key, start + x, m) for x, m in zip(a.tolist(), count.tolist(), strict=True)]
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "text_key", "a", "n"])

    return repeats(docs, Plan(window, gram), _symbols, compare, True)


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of docs (doc_id, text); kept are the remaining words joined by one space.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged; null texts have none. Every word covered by a window that also starts
    earlier goes; texts shorter than a window stay whole. Of equal rows (doc_id and text) none is earlier than
    the other; of other rows that repeat a doc_id some are, always the same; rows without one come last. Other columns are ignored; an empty table gives no rows.
    """
    return _removed(docs, window, gram, False)


def substring_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return _removed(docs, WINDOW, GRAM, True)


def _removed(docs: DataFrame, window: int, gram: int, digest: bool) -> DataFrame:
    docs = identified(documents(docs))
    rows = with_runs(docs, repeated_windows(docs, window, gram))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, a, n in zip(*(c.to_pylist() for c in batch.columns[1:4]), strict=True):
                words = (text or "").encode().split()  # bytes.split() parts at 0x20 and 0x09-0x0D
                lost = covered(len(words), a, n, window)
                total.append(len(words))
                gone.append(int(lost.sum()))
                left = b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x] if gone[-1] else words)
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", name])

    name = "kept_sha256" if digest else "kept"
    return rows.mapInArrow(task(remove), f"doc_id long, n_words long, n_removed long, {name} string")
