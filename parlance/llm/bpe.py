"""BPE encoding and decoding with tree concatenation of long texts.

A long text is cut into the leaves of a tree, which are encoded as rows of their own, in
parallel. Joins go up the tree, two neighbours at a time: around each join a window of the text is
encoded afresh, and it grows until it agrees with the left side on one token
before the join and with the right side on one token after it (same id, same
place). A sequence of BPE tokens is the encoding of its text exactly if each
pair of neighbours is, so tokens taken from the left up to the first agreement,
from the window up to the second and from the right from there on are what the
library gives for the whole text. Where nothing agrees, the window ends up as
the whole text. Only what stands between the white space nearest to a join and the
join needs this: a token never crosses a space, so the words between are encoded
once a process and looked up from then on.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, task

TOKENIZER = "word_bpe_49k.json"
#: Characters above which a text is cut, and the widest leaf.
LEAF = 32_768
#: Characters on each side of a join in the first window; each further one is four times as wide.
WINDOW = 64
#: Characters of a leaf's edges within which white space is looked for.
EDGE = 4096
#: Words that a process remembers in each of two generations, the longest of them, and texts that are looked up at once.
REMEMBERED, LONGEST, TEXTS = 150_000, 48, 1024

IDS = "doc_id long, ids array<int>"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer in a file; a name without a folder is one of the installed public vocabularies."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.dirname(path):
        import public_tokenizers

        path = public_tokenizers.path(path)

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def leaves(length: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """The tree's leaves, each `leaf` characters long but the last."""
    return [(a, min(a + leaf, length)) for a in range(0, max(1, length), leaf)]


class Memory:
    """Ids of words seen before: when the younger generation is full it becomes the older one, from which words in use move back."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.most = REMEMBERED
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.seen: dict[str, tuple[int, str, str]] = {}
        self.before: dict[str, tuple[int, str, str]] = {}
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.shared = list(range(max(vocabulary.values(), default=-1) + 1))  # one object for each id
        self.names = [str(i) for i in self.shared]
        self.tokens = [""] * len(self.shared)
        for token, i in vocabulary.items():
            self.tokens[i] = token
        self.lowers = tokenizer.encode("Aa", add_special_tokens=False).ids == tokenizer.encode("aa", add_special_tokens=False).ids
        self.marks = tuple({str(t.content)[:2] for t in tokenizer.get_added_tokens_decoder().values()})

    def forget(self) -> None:
        self.forget_ids()
        self.seen, self.before = {}, {}

    def forget_ids(self) -> None:
        self.young, self.old = {}, {}

    def plain(self, text: str) -> str:
        """The text as the tokenizer's own normaliser has it, where that is no more than lower case: ASCII and nothing like an added token."""
        return text.lower() if self.lowers and text.isascii() and not any(m in text for m in self.marks) else text

    def decode(self, ids: list[int]) -> str:
        """As decode(ids, skip_special_tokens=False): without a decoder the library joins the tokens by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids)) if self.tokenizer.decoder is None else self.tokenizer.decode(ids, skip_special_tokens=False)

    def ids(self, texts: list[str]) -> list[list[int]]:
        split = [self.plain(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = set(chain.from_iterable(split)) - young.keys()
        for word in new & old.keys():
            young[word] = old[word]
        new = list(new - young.keys())
        for word, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            young[word] = [self.shared[i] for i in found.ids]
        out = [list(chain.from_iterable(map(young.__getitem__, w))) for w in split]
        for word in new:
            if len(word) > LONGEST:
                del young[word]
        return out


    def written(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text the number of its ids, the ids in decimal and its tokens, both joined by one space. Only for tokenizers without a decoder, whose decoded text is its words' tokens."""
        split = [self.plain(t).replace("\n", " ").split(" ") for t in texts]
        if len(self.seen) > self.most:
            self.seen, self.before = {}, self.seen
        seen, before = self.seen, self.before
        new = set(chain.from_iterable(split)) - seen.keys()
        for word in new & before.keys():
            seen[word] = before[word]
        new = list(new - seen.keys())
        for word, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            ids = found.ids
            seen[word] = (len(ids), " ".join(map(self.names.__getitem__, ids)), " ".join(map(self.tokens.__getitem__, ids)))
        out = []
        for words in split:
            count, ids, tokens = zip(*map(seen.__getitem__, words), strict=True)
            out.append((sum(count), " ".join(filter(None, ids)), " ".join(filter(None, tokens))))
        for word in new:
            if len(word) > LONGEST:
                del seen[word]
        return out


_MEMORY: dict[int, Memory] = {}


def memory(tokenizer) -> Memory:
    if id(tokenizer) not in _MEMORY:
        _MEMORY[id(tokenizer)] = Memory(tokenizer)
    return _MEMORY[id(tokenizer)]


def word_ids(tokenizer, texts: list[str]) -> list[list[int]]:
    """The ids of texts of moderate length, word by word: no token crosses a space or a line's end, and neither does any normalisation."""
    return [x for k in range(0, len(texts), TEXTS) for x in memory(tokenizer).ids(texts[k : k + TEXTS])]


class Piece:
    """Tokens of text[start:end], with the characters that each comes from."""

    def __init__(self, start: int, end: int, ids: np.ndarray, a: np.ndarray, b: np.ndarray):
        self.start, self.end, self.ids, self.a, self.b = start, end, ids, a, b

    @classmethod
    def of(cls, tokenizer, text: str, start: int, end: int) -> Piece:
        e = tokenizer.encode(text[start:end], add_special_tokens=False)
        at = np.array(e.offsets, np.int64).reshape(-1, 2) + start
        return cls(start, end, np.array(e.ids, np.int32), at[:, 0], at[:, 1])


def _anchors(piece: Piece, text: str, lo: int, hi: int) -> dict[tuple[int, int, int], int]:
    """Tokens within [lo, hi) that may carry an agreement: ASCII only and alone on their characters, so that no normalisation crosses their edges."""
    i, j = np.searchsorted(piece.a, lo), np.searchsorted(piece.a, hi)
    found = {}
    for k in range(i, j):
        a, b = int(piece.a[k]), int(piece.b[k])
        alone = (k == 0 or piece.b[k - 1] <= a) and (k + 1 == len(piece.ids) or piece.a[k + 1] >= b)
        if alone and a < b <= hi and text[max(0, a - 1) : b + 1].isascii():
            found[(a, b, int(piece.ids[k]))] = k
    return found


def join(tokenizer, text: str, left: Piece, right: Piece, window: int = WINDOW) -> Piece:
    """The encoding of two neighbouring pieces' text."""
    at = left.end
    while True:
        lo, hi = max(left.start, at - window), min(right.end, at + window)
        mid = Piece.of(tokenizer, text, lo, hi)
        i = x = 0
        if lo > left.start:
            both = _anchors(mid, text, lo, at - 1)
            before = [(k, mine) for key, mine in _anchors(left, text, lo, at - 1).items() if (k := both.get(key)) is not None]
            if not before:
                window *= 4
                continue
            x, i = max(before)
            i += 1
            x += 1
        else:
            i = 0
        j, y = len(right.ids), len(mid.ids)
        if hi < right.end:
            both = _anchors(mid, text, at + 1, hi - 1)
            after = [(k, mine) for key, mine in _anchors(right, text, at + 1, hi - 1).items() if (k := both.get(key)) is not None]
            if not after:
                window *= 4
                continue
            y, j = min(after)
        return Piece(left.start, right.end, *(np.concatenate([getattr(left, f)[:i], getattr(mid, f)[x:y], getattr(right, f)[j:]]) for f in ("ids", "a", "b")))


def join_all(tokenizer, text: str, pieces: list[Piece]) -> np.ndarray:
    """Up the tree: neighbours are joined two by two until one piece is left."""
    while len(pieces) > 1:
        pieces = [join(tokenizer, text, *pieces[k : k + 2]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
    return pieces[0].ids


def edges(leaf: str) -> tuple[str, str, str]:
    """A leaf as head, middle and tail, parted at spaces within EDGE of its ends; all head if there are none."""
    a = leaf.find(" ", 0, EDGE)
    b = leaf.rfind(" ", max(a + 1, len(leaf) - EDGE))
    return (leaf, "", "") if a < 0 or b <= a else (leaf[:a], leaf[a:b], leaf[b:])


def join_leaves(tokenizer, parts: list[tuple[str, list[int] | None, str]]) -> np.ndarray:
    """A text's ids from its leaves' (head, ids of the middle or None if it is all head, tail)."""
    out: list[np.ndarray] = []
    run: list[str] = []

    def seal() -> None:
        text = "".join(run)
        at = np.concatenate([[0], np.cumsum([len(x) for x in run])]).tolist()
        pieces = [Piece.of(tokenizer, text, a, b) for a, b in zip(at[:-1], at[1:], strict=True)]
        out.append(join_all(tokenizer, text, pieces) if pieces else np.empty(0, np.int32))
        run.clear()

    for head, middle, tail in parts:
        run.append(head)
        if middle is not None:
            seal()
            out.append(np.array(middle, np.int32))
            run.append(tail)
    seal()
    return np.concatenate(out)


def encode_text(tokenizer, text: str, leaf: int = LEAF) -> np.ndarray:
    """One text by the same tree, in this process."""
    parts = [edges(text[a:b]) for a, b in leaves(len(text), leaf)]
    return join_leaves(tokenizer, [(h, word_ids(tokenizer, [m])[0] if m else None, t) for h, m, t in parts])


def _leaf_rows(docs: DataFrame, leaf: int, columns: list[str]) -> DataFrame:
    """A row for each leaf of each long text, as leaves() cuts them: in the JVM, in one pass over the text."""
    return docs.select("k", *columns, F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0))).alias("no", "piece"))


def _split(docs: DataFrame, leaf: int, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.where(F.length("text") <= leaf), rows.where(F.length("text") > leaf)


def encode(docs: DataFrame, tokenizer_path: str = TOKENIZER, leaf: int = LEAF, keep: list[str] | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, ids) of every whole text of docs (doc_id, text), and the string columns named in keep.

    Null and empty texts have no ids; repeated rows are encoded each, under
    their doc_id; other columns are ignored; an empty table gives no rows.
    remembered bounds the words that a process keeps: fewer take less memory and more time, and are kept for one task only.
    """
    return _encoded(docs, tokenizer_path, leaf, False, keep or [], remembered)


def digests(docs: DataFrame, tokenizer_path: str = TOKENIZER, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode() and decode() of every whole text, reduced to digests where they are made."""
    return _encoded(docs, tokenizer_path, leaf, True, [], REMEMBERED)


def _encoded(docs: DataFrame, path: str, leaf: int, digest: bool, keep: list[str], remembered: int) -> DataFrame:
    schema = ", ".join([*(f"`{c}` string" for c in keep), DIGEST if digest else IDS])
    columns = [f"keep{i}" for i in range(len(keep))]

    def out(kept: list[pa.Array], keys: list[int], ids: list) -> pa.RecordBatch:
        if digest:
            made = _digest(load(path), keys, ids)
        else:
            made = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        return pa.RecordBatch.from_arrays([*kept, *made.columns], [*keep, *made.schema.names])

    def known() -> Memory:
        found = memory(load(path))
        found.most = remembered
        return found

    def short_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known()
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                part = batch.slice(k, TEXTS)
                if digest and words.tokenizer.decoder is None:
                    found = [(n, hashlib.sha256(a.encode()).hexdigest(), hashlib.sha256(b.encode()).hexdigest()) for n, a, b in words.written(part.column(-1).to_pylist())]
                    made = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(made, (pa.int64(), pa.string(), pa.string()), strict=True))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield out(part.columns[1:-1], part.column(0).to_pylist(), words.ids(part.column(-1).to_pylist()))
        if remembered < REMEMBERED:
            words.forget()

    def leaf_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known()
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                parts = [edges(x) for x in part.column("piece").to_pylist()]
                ids = words.ids([m for _, m, _ in parts])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([h for h, _, _ in parts], pa.string()), pa.array([i if m else None for i, (_, m, _) in zip(ids, parts, strict=True)], pa.list_(pa.int32())), pa.array([t for _, _, t in parts], pa.string())],
                    ["k", *columns, "no", "head", "middle", "tail"],
                )
        words.forget_ids()

    def joined(group: pa.Table) -> pa.RecordBatch:
        rows = group.select(["k", "head", "middle", "tail"]).to_pydict()
        kept = [group.column(c).slice(0, 1).combine_chunks() for c in columns]
        kept = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in kept]
        own = rows["k"][0].split(":")[0]
        return out(kept, [int(own) if own else None], [join_leaves(load(path), list(zip(rows["head"], rows["middle"], rows["tail"], strict=True)))])

    named = docs.select("doc_id", "text", *(F.col(c).cast("string").alias(n) for c, n in zip(keep, columns, strict=True)))
    short, long = _split(named, leaf, columns)
    # A long text's leaves meet again under its row's own number, so repeated rows with one doc_id, or none, stay apart.
    keyed = long.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.monotonically_increasing_id()).alias("k"), *columns, "text")
    kinds = ", ".join(["k string", *(f"{c} string" for c in columns), "no int, head string, middle array<int>, tail string"])
    coded = _leaf_rows(keyed, leaf, columns).repartition("k", "no").mapInArrow(task(leaf_rows), kinds)
    whole = grouped(coded, "k", ["no"], joined, schema)
    return short.mapInArrow(task(short_rows), schema).union(whole)


def _digest(tokenizer, keys: list[int], ids: list) -> pa.RecordBatch:
    known = memory(tokenizer)
    names = known.names
    counts, first, second = [], [], []
    for one in ids:
        one = one if isinstance(one, list) else one.tolist()
        counts.append(len(one))
        first.append(hashlib.sha256(" ".join(map(names.__getitem__, one)).encode()).hexdigest())
        second.append(hashlib.sha256(known.decode(one).encode()).hexdigest())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def decode(encoded: DataFrame, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_path)
        for batch in batches:
            texts = [memory(tokenizer).decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(task(run), "doc_id long, text string")
