"""Secrets in texts: three base patterns, and strings that a tokenizer finds costly.

A byte-level BPE vocabulary learned from ordinary text spends few tokens on words,
code names and paths, and one for every one or two characters of a random string.
Strings whose characters per token are few are reported, after known digests and
identifiers are excluded.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, task

#: The base patterns, in the order in which kinds of one start are listed. Letters of the first are of either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

#: What the tokenizer judges: whole runs of these characters, of SHORTEST at least.
SHORTEST = 20
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Fewer characters a token than this are random. Words, also invented and compound ones, have 2.5 to 5, base 64 some 1.4, base 32 and hex 1.5 to 1.8.
RATIO = 2.1
#: Long runs are tokenized in pieces of this many characters, whose tokens are added.
PIECE = 1024

#: Digests by their form: MD5, SHA-1, SHA-224, -256, -384, -512 in hex, or named ones in base 64.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}|(?:md5|sha1|sha224|sha256|sha384|sha512)[-_=/][A-Za-z0-9+/=_-]+)")
#: Identifiers by their form: UUIDs, and numbers such as dates, telephone and account numbers.
IDENTIFIER = re.compile(r"(?:urn-)?[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}|[0-9+/_=-]+|(.)\1*")

VOCABULARY = "byte_bpe_50k.tiktoken"


@functools.lru_cache(2)
def load(path: str):
    """The encoding of a file of ranks, named by its path or by its name among the public tokenizers'."""
    import public_tokenizers
    import tiktoken

    if not os.path.exists(path):
        path = public_tokenizers.path(path)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(8192)
def _tokens(path: str, piece: str) -> int:
    return len(load(path).encode_ordinary(piece))


def ratio(text: str, vocabulary: str = VOCABULARY) -> float:
    """Characters a token."""
    return len(text) / max(1, sum(_tokens(vocabulary, text[k : k + PIECE]) for k in range(0, len(text), PIECE)))


def is_random(text: str, vocabulary: str = VOCABULARY, below: float = RATIO) -> bool:
    """Whether a run costs so many tokens, and is neither a digest nor an identifier."""
    return not DIGEST.fullmatch(text) and not IDENTIFIER.fullmatch(text) and ratio(text, vocabulary) < below


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and kind; whole matches, those too short left out."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, base: list[tuple[int, int, int]], vocabulary: str = VOCABULARY, below: float = RATIO) -> list[tuple[int, int, int]]:
    """Random runs that do not lie within a base span."""
    found = []
    k, reach = 0, 0
    for m in RUN.finditer(text):
        # Base spans that start up to here: whether one of them reaches the run's end.
        while k < len(base) and base[k][0] <= m.start():
            reach = max(reach, base[k][2])
            k += 1
        if reach < m.end() and is_random(m.group(), vocabulary, below):
            found.append((m.start(), 3, m.end()))
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame, vocabulary: str = VOCABULARY, below: float = RATIO) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans, masked.

    spans are `kind:start:end` in code points, end exclusive, by start and kind; base_sha256 is of those of the base patterns.
    masked is the text with each character of a span replaced by `*`. Null counts as empty: no spans, and a null text stays null. Texts are scanned
    whole, of whatever length; rows that repeat a doc_id, or have none, are scanned each. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                counts, digests, spans, masked = [], [], [], []
                for text in part.column(1).to_pylist():
                    base = base_spans(text or "")
                    every = sorted(base + random_spans(text or "", base, vocabulary, below))
                    counts.append([sum(x[1] == kind for x in every) for kind in range(4)])
                    digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                    spans.append(written(every))
                    masked.append(_masked(text, every))
                numbers = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(masked, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "masked"])

    return documents(docs).mapInArrow(task(run), "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, masked string")


def _masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for a, _, b in spans:
        if b > done:
            out += [text[done : max(a, done)], "*" * (b - max(a, done))]
            done = b
    return "".join([*out, text[done:]])


def scan_digests(docs: DataFrame) -> DataFrame:
    """secret_scan() with the masked text's digest in its place (null where the text is)."""
    return secret_scan(docs).withColumn("masked_sha256", F.sha2("masked", 256)).drop("masked")
