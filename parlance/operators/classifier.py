"""A text classifier of short clauses: character n-grams, TF-IDF and logistic regression in pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens


def char_ngrams(text: Column, least: int = 2, most: int = 4) -> Column:
    """All n-grams of each word's characters, with a space on either side of the word."""
    def grams(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - n + 1)), lambda i: F.substring(padded, i, F.lit(n)))
        return F.concat(*(of(n) for n in range(least, most + 1)))

    return F.flatten(F.transform(tokens(text), grams))


def train(samples: DataFrame, c: float = 1.5, features: int = 1 << 14) -> PipelineModel:
    """Fit on samples (text, label): classes weigh alike however many samples they have; c is the inverse strength of regularisation."""
    counts = samples.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    found = [r.n for r in counts.collect()]
    total, k = sum(found), len(found)
    d = samples.join(counts, "label").select("label", char_ngrams(F.col("text")).alias("grams"), (F.lit(total) / (F.lit(k) * F.col("n"))).alias("weight"))
    # The fit reads its rows many times over; what they are drawn from is not read again each time.
    d = d.persist()
    stages: list[Transformer] = [
        StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc"),
        CountVectorizer(inputCol="grams", outputCol="tf", vocabSize=features),
        IDF(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol="x"),
        LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", regParam=1.0 / (c * max(1, total)), elasticNetParam=0.0, standardization=False, maxIter=100),
    ]
    try:
        return Pipeline(stages=stages).fit(d)
    finally:
        d.unpersist()


#: Documents whose counts are one dense table, and words whose n-grams a task remembers, at most.
ROWS, REMEMBERED = 8, 100_000


def _probabilities(model: PipelineModel) -> Callable[[Column], Column]:
    """The stages after the first as one function of a text's tokens: the probability of each label.

    A word's n-grams are looked up once in a task, however often it is said.
    """
    _, counter, idf, _, fitted = model.stages
    place = {g: k for k, g in enumerate(counter.vocabulary)}
    weights, slopes, base = idf.idf.toArray(), fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    known: dict[str, np.ndarray] = {}

    def grams(word: str, least: int = 2, most: int = 4) -> np.ndarray:
        padded = f" {word} "
        found = (padded[k : k + n] for n in range(least, most + 1) for k in range(max(1, len(padded) - n + 1)))
        return np.array([place[g] for g in found if g in place], np.int64)

    @F.arrow_udf("array<double>")
    def probabilities(tokens: pa.Array) -> pa.Array:
        said = tokens.flatten().dictionary_encode()
        index, words = said.indices.to_numpy(zero_copy_only=False), said.dictionary.to_pylist()
        if len(known) > REMEMBERED:
            known.clear()
        lists = [known[w] if w in known else known.setdefault(w, grams(w)) for w in words]
        size = np.array([len(x) for x in lists], np.int64)
        first, every = np.cumsum(size) - size, np.concatenate([*lists, np.empty(0, np.int64)])
        ends = np.cumsum(np.concatenate([[0], pc.list_value_length(tokens).to_numpy(zero_copy_only=False)])).astype(np.int64)
        out = []
        for a in range(0, len(tokens), ROWS):
            b = min(a + ROWS, len(tokens))
            row, word = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1])), index[ends[a] : ends[b]]
            cell, times = np.unique(row * len(words) + word, return_counts=True)
            row, word = np.divmod(cell, max(1, len(words)))
            n = size[word]
            take = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            x = np.bincount(np.repeat(row * len(weights), n) + every[take], np.repeat(times, n), (b - a) * len(weights)).reshape(b - a, -1)
            x *= weights
            long = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            margin = x @ slopes.T / np.where(long > 0, long, 1) + base
            margin = np.hstack([-margin, margin]) if len(base) == 1 else margin
            with np.errstate(over="ignore"):
                out.append(1 / np.exp(margin[:, None, :] - margin[:, :, None]).sum(axis=2) if len(base) > 1 else 1 / (1 + np.exp(-margin)))
        p = np.concatenate([*out, np.empty((0, max(2, len(base))))])
        return pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], p.ravel())

    return probabilities


def predict(texts: DataFrame, model: PipelineModel) -> DataFrame:
    """texts with lang, score, and probabilities by label (of equal ones the first is the lang)."""
    labels = model.stages[0].labels
    p = F.col("_p")
    d = texts.withColumn("_p", _probabilities(model)(tokens(F.col("text"))))
    named = F.create_map(*(x for k, v in enumerate(labels) for x in (F.lit(v), p[k])))
    best = F.element_at(F.array(*map(F.lit, labels)), F.array_position(p, F.array_max(p)).cast("int"))
    return d.withColumns({"lang": best, "score": F.array_max(p), "probabilities": named}).drop("_p")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
