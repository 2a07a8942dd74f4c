"""Language identification: the family first, then one-versus-one within it.

Texts are lower-cased, everything but letters becomes a space, and hashed n-grams
of one to four letters (with spaces as word edges) vote with the weights of linear
support vector machines. One-versus-rest machines choose the family; within it a
machine for each pair of languages votes. Machines only tell known languages apart,
so a score is bounded too by how usual a text's n-grams are in the language chosen.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import grouped, materialise, task, with_columns

#: Families of closely related languages; a language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "mk"),
    "indic": ("hi", "mr", "ne", "pa", "bn", "gu", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "uralic": ("fi", "et", "hu"),
}
DIMENSIONS = 1 << 12
#: Labelled rows that a language is learned from, at most; drawn by a hash of doc_id from all of them.
PER_LANGUAGE = 400
#: Rows on either side of a family's machine, at most; drawn by the same hash.
PER_SIDE = 1600
#: Languages whose counts are broadcast to the rows; more are joined by a shuffle.
BROADCAST_ROWS = 10_000
#: Characters that are scored at once.
CHARS = 200_000
#: Standard deviations by which a text's n-grams may be less usual than its language's own texts, for a score of 0.5.
DOUBT = 5.25
#: Share of n-grams that a language's texts to learn from are taken to lack.
UNSEEN = 0.01
#: Letters of the parts by which a doubted text is judged again.
PART = 100
#: Below this score the pipeline takes a text for no known language.
REJECT_BELOW = 0.5

_LETTER = regex.compile(r"\p{L}")
_NOT = regex.compile(r"[^\p{L}\p{M}]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def family(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), lang)


def letters(text: str | None) -> str:
    """The lower-cased words of a text between single spaces; empty if it has no letter."""
    if not text:
        return ""
    low = text.lower()
    if low.isascii():
        low = low.translate(_ASCII)
    else:
        low = _NOT.sub(" ", low)
    low = " ".join(low.split())
    return f" {low} " if low and _LETTER.search(low) else ""


_ASCII = {c: " " for c in range(128) if not chr(c).isalpha()}


#: Ends each text in a batch, so that no n-gram reads from one text into the next.
PAD = "\0\0\0"


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams (n of 1 to 4) at each letter of letters() of each text, which letters count (all but PAD), and where each text begins."""
    at = np.concatenate([[0], np.cumsum([len(t) + len(PAD) for t in texts])]).astype(np.int64)
    codes = np.frombuffer("".join(t + PAD for t in texts).encode("utf-32-le"), np.uint32)
    out = np.empty((len(codes), 4), np.uint16)
    grams = codes.copy()
    for n in range(4):
        if n:
            grams = grams * np.uint32(0x01000193)
            grams[: max(0, len(codes) - n)] ^= codes[n:]
        mixed = (grams + np.uint32(n * 0x3C6EF372)) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
        out[:, n] = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 12)
    return out, codes != 0, at


def _sums(found: tuple[np.ndarray, np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text of features(), a column for each machine."""
    grams, counts, at = found
    out = np.zeros((len(at) - 1, weights.shape[1]))
    for k in range(weights.shape[1] if counts.any() else 0):
        w = weights[:, k].astype(np.float32)
        per = w[grams[:, 0]]
        for n in range(1, 4):
            per += w[grams[:, n]]
        out[:, k] = np.add.reduceat(per * counts, at[:-1], dtype=np.float64)
    return out / np.maximum(1, 4 * (np.diff(at) - len(PAD)))[:, None]


def _usual(found: tuple[np.ndarray, np.ndarray, np.ndarray], tables: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Mean weight of the n-grams of each text of features(), by the row of tables that `which` names for it."""
    grams, counts, at = found
    if not counts.any():
        return np.zeros(len(which))
    flat = tables.ravel()
    start = np.repeat(which.astype(np.int32) * DIMENSIONS, np.diff(at))
    per = flat[start + grams[:, 0]]
    for n in range(1, 4):
        per += flat[start + grams[:, n]]
    return np.add.reduceat(per * counts, at[:-1], dtype=np.float64) / np.maximum(1, 4 * (np.diff(at) - len(PAD)))


def vector(text: str) -> np.ndarray:
    grams, counts, _ = features([text])
    v = np.bincount(grams[counts].ravel(), minlength=DIMENSIONS).astype(np.float64)
    return v / max(1.0, v.sum())


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 60) -> tuple[np.ndarray, float, float]:
    """A linear machine with squared hinge loss by dual coordinate descent; y is -1 or 1. Returns weights, bias and the mean margin."""
    z = np.hstack([x, np.ones((len(x), 1))])
    weigh = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    norm = np.einsum("ij,ij->i", z, z) + 0.5 / (c * weigh)
    alpha, w = np.zeros(len(x)), np.zeros(z.shape[1])
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * (z[i] @ w) - 1 + alpha[i] * 0.5 / (c * weigh[i])
            new = max(0.0, alpha[i] - g / norm[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * z[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    margin = float(np.median(np.abs(z @ w))) or 1.0
    return w[:-1], float(w[-1]), margin


class Machine(NamedTuple):
    """What one task learns: of a language its table, or the weights of a machine that parts `name` from `other` (a language, or None: all other families)."""

    kind: str
    name: str
    other: str | None


class Model:
    """weights: a column for each machine, families first; tables: a row for each language, the logarithms of its n-grams' shares.

    usual: the mean of such logarithms over one of the language's texts that the shares leave out
    (the median), its variance from text to text, and that over a text's n-grams.
    """

    def __init__(self, learned: dict[Machine, tuple[np.ndarray, list[float]]]):
        self.langs = sorted(m.name for m in learned if m.kind == "language")
        self.families = sorted({family(v) for v in self.langs})
        found = [m for m in learned if m.kind != "language"]
        self.machines = sorted(found, key=lambda m: (m.kind != "family", m.name, m.other or ""))
        tables = [learned[Machine("language", v, None)] for v in self.langs]
        self.tables = np.array([t for t, _ in tables], np.float32).reshape(-1, DIMENSIONS)
        self.usual = np.array([u for _, u in tables]).reshape(-1, 3)
        self.weights = np.array([learned[m][0] for m in self.machines], np.float32).reshape(-1, DIMENSIONS).T
        self.bias = np.array([learned[m][1][0] for m in self.machines])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        clean = [letters(t) for t in texts]
        if not self.langs:
            return ["und"] * len(clean), [0.0] * len(clean)
        chosen, faith, lack = self._decide(clean)
        size = np.array([max(1, len(t)) for t in clean])
        doubt = self._doubt(lack, self.usual[chosen, 1], self.usual[chosen, 2], size)
        for i in np.flatnonzero(doubt > DOUBT):
            doubt[i] = min(doubt[i], self._doubt_of_parts(clean[i]))
        score = np.minimum(faith, 1 / (1 + np.exp(np.clip(doubt - DOUBT, -30, 30))))
        lang = [self.langs[k] if t else "und" for k, t in zip(chosen, clean, strict=True)]
        return lang, [float(min(1.0, max(0.0, v))) if t else 0.0 for v, t in zip(score, clean, strict=True)]

    @staticmethod
    def _doubt(lack: np.ndarray, between: np.ndarray, within: np.ndarray, size: np.ndarray) -> np.ndarray:
        return lack / np.sqrt(between + within / size)

    def _doubt_of_parts(self, text: str) -> float:
        """Doubt where each word counts once and each part may be of another known language: texts of two languages or of repeated words are not doubted for that."""
        once = f" {' '.join(dict.fromkeys(text.split()))} "
        parts = [once[k : k + PART] for k in range(0, len(once), PART)]
        found = features(parts)
        lack = np.array([self.usual[k, 0] - _usual(found, self.tables, np.full(len(parts), k)) for k in range(len(self.langs))])
        best, size = lack.argmin(axis=0), np.array([len(t) for t in parts])
        mean = lambda v: np.average(v, weights=size)
        return float(self._doubt(mean(lack.min(axis=0)), mean(self.usual[best, 1]), mean(self.usual[best, 2]), size.sum()))

    def _decide(self, clean: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text of letters(): its language's place in langs, the machines' share for it, and by how much its n-grams are less usual than that language's."""
        cuts = [0]
        size = 0
        for k, t in enumerate(clean):
            size += len(t)
            if size > CHARS:
                cuts.append(k + 1)
                size = 0
        if cuts[-1] < len(clean):
            cuts.append(len(clean))
        out = [self._decide_part(clean[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return tuple(np.concatenate(v) for v in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0), np.zeros(0))

    def _decide_part(self, clean: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(clean)
        found = features(clean)
        margins = _sums(found, self.weights) + self.bias if self.machines else np.zeros((n, 0))
        share = 1 / (1 + np.exp(-np.clip(3 * margins, -30, 30)))
        if len(self.families) > 2:
            fam = share[:, : len(self.families)]
        elif len(self.families) == 2:
            fam = np.stack([share[:, 0], 1 - share[:, 0]], axis=1)
        else:
            fam = np.ones((n, len(self.families)))
        votes = {v: np.zeros(n) for v in self.langs}
        faith = {v: np.ones(n) for v in self.langs}
        for k, (_, a, b) in enumerate(self.machines):
            if b is not None:
                p = share[:, k]
                votes[a] += (p >= 0.5) + p * 1e-3
                votes[b] += (p < 0.5) + (1 - p) * 1e-3
                faith[a] = np.minimum(faith[a], p)
                faith[b] = np.minimum(faith[b], 1 - p)
        chosen = fam.argmax(axis=1)
        best, score = np.zeros(n, int), np.zeros(n)
        for i in range(n):
            members = [v for v in self.langs if family(v) == self.families[chosen[i]]]
            lang = max(members, key=lambda v: (votes[v][i], faith[v][i]))
            best[i] = self.langs.index(lang)
            score[i] = min(fam[i, chosen[i]], faith[lang][i])
        return best, score, self.usual[best, 0] - _usual(found, self.tables, best)


def machines(langs: list[str]) -> list[Machine]:
    """All that is to be learned: a table of each language, a machine for each family (for two families: one) and for each pair of languages in one."""
    families = sorted({family(v) for v in langs})
    out = [Machine("language", v, None) for v in langs]
    if len(families) > 1:
        out += [Machine("family", f, None) for f in (families if len(families) > 2 else families[:1])]
    return out + [Machine("pair", a, b) for f in families for a, b in combinations([v for v in langs if family(v) == f], 2)]


def _learn_table(x: np.ndarray) -> tuple[np.ndarray, list[float]]:
    m, total = len(x), x.sum(axis=0)
    table = np.log((1 - UNSEEN) * total / m + UNSEEN / DIMENSIONS)
    own = np.array([np.log((1 - UNSEEN) * np.maximum(0, total - v) / max(1, m - 1) + UNSEEN / DIMENSIONS) @ v for v in x])
    # Medians, as some of the texts may have a wrong label. Few texts show little of how much texts differ: a quarter is added as if another text had been half a unit off.
    middle = np.median(own)
    between = (1.4826 * np.median(np.abs(own - middle))) ** 2 + 0.25 / (m - 1) if m > 1 else np.inf
    share = total / total.sum()
    return table, [float(middle), float(between), float(share @ (table - share @ table) ** 2)]


def _learn_machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, list[float]]:
    scale = np.sqrt(np.mean(x**2, axis=0)) + 1e-4
    x = x / scale
    length = np.sqrt((x**2).sum(axis=1)).mean() or 1.0
    x /= length
    w, bias, margin = svm(x, y)
    return w / scale / length / margin, [bias / margin]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, per_side: int = PER_SIDE) -> Model:
    """Learn from text and lang of labelled rows that are not held out.

    At most per_language rows of each language are used, drawn by a hash of doc_id from all of them, and at most
    per_side on either side of a family's machine. Every machine is fitted in a task of its own from its own rows;
    the driver gets weights, DIMENSIONS numbers a machine. Null texts, texts without a letter and null labels teach
    nothing; without any other the model predicts `und` for all. The result doesn't depend on how rows are dealt.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("key"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("key")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = materialise(rows.groupBy("lang").count())
    share = counts.select(F.col("lang").alias("l"), F.least(F.lit(1.0), F.lit(1.1 * per_language) / F.col("count")).alias("share"))
    share = F.broadcast(share) if counts.count() <= BROADCAST_ROWS else share
    drawn = (F.abs(F.xxhash64(F.col("key"), F.lit(9))) % 1_000_003) / 1_000_003.0 < F.col("share")
    order = F.xxhash64(F.col("key"), F.lit(9))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                clean = [letters(t) for t in part.column(0).to_pylist()]
                use = pa.array([i for i, t in enumerate(clean) if t], pa.int64())
                found = pa.array([vector(t).astype(np.float32).tobytes() for t in clean if t], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(1).take(use), part.column(2).take(use), found], ["lang", "h", "v"])

    known = rows.join(share, F.col("lang") == F.col("l")).where(drawn).select("text", "lang", order.alias("h")).mapInArrow(task(vectors), "lang string, h long, v binary")
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "v"))
    sample = materialise(known.withColumn("place", place).where(F.col("place") <= per_language))

    sizes = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}  # a row for each language, as the model has
    wanted = machines(sorted(sizes))
    sides: dict[str, list[tuple[int, float, float]]] = {v: [] for v in sizes}  # machine, side, share of the language's rows
    for k, (kind, name, other) in enumerate(wanted):
        if kind == "language":
            sides[name].append((k, 1.0, 1.0))
        elif kind == "pair":
            sides[name].append((k, 1.0, 1.0))
            sides[other].append((k, -1.0, 1.0))
        else:
            for y in (1.0, -1.0):
                members = [v for v in sizes if (family(v) == name) == (y > 0)]
                for v in members:
                    sides[v].append((k, y, min(1.0, per_side / sum(sizes[m] for m in members))))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (lang, h, v) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "v")), strict=True)):
                to = [(k, y) for k, y, part in sides[lang] if part >= 1 or (h * 0x9E3779B97F4A7C15 + k * 0xD6E8FEB86659FD93) % 2**64 < part * 2**64]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in to], pa.int32()), pa.array([y for _, y in to], pa.float64()), pa.array([h] * len(to), pa.int64()), pa.array([v] * len(to), pa.binary())], ["machine", "side", "h", "v"])

    def fit(group: pa.Table) -> pa.RecordBatch:
        k = group.column("machine")[0].as_py()
        x = np.frombuffer(b"".join(group.column("v").to_pylist()), np.float32).reshape(-1, DIMENSIONS).astype(np.float64)
        found, numbers = _learn_table(x) if wanted[k].kind == "language" else _learn_machine(x, group.column("side").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([found.astype(np.float32).tobytes()], pa.binary()), pa.array([numbers], pa.list_(pa.float64()))], ["machine", "found", "numbers"])

    fitted = grouped(sample.select("lang", "h", "v").mapInArrow(task(dealt), "machine int, side double, h long, v binary"), "machine", ["h", "side", "v"], fit, "machine int, found binary, numbers array<double>")
    return Model({wanted[r["machine"]]: (np.frombuffer(r["found"], np.float32), list(r["numbers"])) for r in fitted.collect()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text of docs (doc_id, text).

    Null texts and texts without a letter are `und` with score 0; of equal votes the machine's margin decides.
    Repeated rows are predicted each; other columns play no part; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS x machines numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                lang, score = sent.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task(run), "doc_id long, lang_pred string, score double")


def identify_rows(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns of docs (text among them) with lang_pred and score, as identify() finds them.

    Columns of these two names give way; nulls, empty texts, repeated rows and empty tables are as in identify().
    """
    columns = [c for c in columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batch: pa.RecordBatch) -> list[pa.Array]:
        lang, score = sent.value.predict(batch.column("text").to_pylist())
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

    return with_columns(docs, columns, predict, "lang_pred string, score double")
