"""Similarity join of documents on word n-grams with Bayesian pruning of candidates.

Documents with one set of n-grams are one class. Bands of MinHash values link
classes to candidate clusters, so that each class's text is sent to its cluster's
tasks once (a cluster larger than a block: once for each other block). There
MinHash values are compared a few at a time, pairs whose posterior probability
of reaching the threshold has fallen below the tolerance go, and the rest is
verified on the exact sets. Links are counted where they are found; pairs are
never emitted, only a forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, buffer, documents, grouped, materialise, shingles, slices, task
from .components import components, local_forest
from .minhash import STAR, Sets, band_keys, bayes_pairs, blocks_of, buckets_of, densified, exact_pairs, sketch, spread, star_edges, star_rows

NGRAM, THRESHOLD = 5, 0.8
#: A pair goes when P(Jaccard >= THRESHOLD) falls below this.
TOLERANCE = 1e-7
#: MinHash bins, and bands x values of them: a pair at the threshold shares no band with probability (1 - 0.8**6)**42 < 3e-6.
BINS_LOG2, BANDS, ROWS = 8, 42, 6


def _distinct(values: np.ndarray) -> np.ndarray:
    s = np.sort(values)
    keep = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=keep[1:])
    return s[keep]


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray], list[bytes]]]:
    """Sorted distinct n-gram hashes of each text and a key of its set, a slice of rows at a time.

    The key is a digest of both halves of the n-grams' 128-bit hashes; empty where there are none.
    """
    raw, at = buffer(column)
    for a, b in slices(at):
        (one, two), of = shingles(Words(raw[at[a] : at[b]], at[a : b + 1] - at[a]), n)
        sets = [_distinct(one[x:y]) for x, y in zip(of[:-1], of[1:], strict=True)]
        keys = [xxhash.xxh3_128_digest(s.tobytes() + _distinct(two[x:y]).tobytes()) if len(s) else b"" for s, x, y in zip(sets, of[:-1], of[1:], strict=True)]
        yield a, sets, keys


def _exact_sets(column: pa.Array, n: int) -> tuple[list[np.ndarray], list[np.ndarray], list[bytes]]:
    """Hashes as in _sets(), numbers that are equal only for n-grams with equal 128-bit hashes, and the sets' keys."""
    sets, keys, flat, other = [], [], [], []
    raw, at = buffer(column)
    for a, found, key in _sets(column, n):
        b = a + len(found)
        (one, two), of = shingles(Words(raw[at[a] : at[b]], at[a : b + 1] - at[a]), n)
        sets += found
        keys += key
        for x, y in zip(of[:-1], of[1:], strict=True):
            order = np.argsort(one[x:y], kind="stable")
            flat.append(one[x:y][order])
            other.append(two[x:y][order])
    h, g = np.concatenate(flat), np.concatenate(other)
    order = np.argsort(h, kind="stable")
    if (g[order[1:]] != g[order[:-1]])[h[order[1:]] == h[order[:-1]]].any():
        code = np.unique(np.column_stack([h, g]), axis=0, return_inverse=True)[1].ravel().astype(np.uint64)
        return sets, [_distinct(x) for x in np.split(code, np.cumsum([len(x) for x in flat])[:-1])], keys
    return sets, sets, keys


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    item = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return sketch(item, np.concatenate(sets) if sets else np.empty(0, np.uint64), len(sets), BINS_LOG2)


def jaccard_join(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, rep_id, group_size, component_id, n_links, kept.

    Words are `[^\\x20\\x09-\\x0D]+`; a text of fewer than n words has one n-gram, all
    of them; null texts and texts without words have none, link with nothing and
    are each a class of their own. rep_id is the smallest doc_id of the texts with the
    same set of n-grams and group_size their number; n_links counts the other
    documents with Jaccard >= threshold, copies included; component_id is the
    smallest doc_id that links reach; kept marks it. Rows that repeat a doc_id count as
    documents of their own, of which all or none are kept. A row without a doc_id links with nothing and is kept, with null rep_id
    and component_id; other columns are ignored; an empty table gives no rows. N-grams are equal if 128-bit hashes of
    their words' bytes are.
    """
    every = documents(docs)
    docs = every.where("doc_id is not null")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, sets, digest in _sets(batch.column(1), n):
                keys = densified(_signatures(sets))
                bands = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(keys, BANDS, ROWS).ravel()), BANDS).cast(pa.list_(pa.int64()))
                size = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + len(sets)]), pa.array(digest, pa.binary()), bands, size], ["doc_id", "cls", "bands", "size"])

    found = docs.mapInArrow(task(features), "doc_id long, cls binary, bands array<long>, size long")
    found = materialise(found)
    wordless = found.where(F.length("cls") == 0).select("doc_id", F.col("doc_id").alias("own"))
    found = found.where(F.length("cls") > 0)
    classes = materialise(found.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("size").alias("size")))

    buckets = buckets_of(classes)

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).flatten().to_numpy()
            yield star_rows(keys, np.repeat(batch.column(0).to_numpy(), BANDS), buckets)

    stars = classes.select("rep", "bands").mapInArrow(task(bucketed), STAR)
    clusters = components(star_edges(stars))
    sized = clusters.join(classes.select("rep", "n", "cls", "size"), F.col("node") == F.col("rep"))
    blocks = sized.groupBy(F.col("component").alias("c")).agg(blocks_of(F.count(F.lit(1)), F.sum("size")).alias("blocks"))
    members = sized.join(blocks, F.col("component") == F.col("c")).select("component", "blocks", "rep", "n", "cls")
    # A class's text stands for it at the smallest doc_id; of rows that repeat that doc_id, a text with the class's set.
    texts = docs.join(members, F.col("doc_id") == F.col("rep"))
    jobs = spread(texts.select("component", "blocks", "rep", "n", "text", "cls"), F.col("component"), F.col("blocks"), F.col("rep"))

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        group = group.combine_chunks()
        rep, count, side = (group.column(c).to_numpy() for c in ("rep", "n", "side"))
        sets, exact, keys = _exact_sets(group.column("text").chunk(0), n)
        own = np.array([k == c for k, c in zip(keys, group.column("cls").to_pylist(), strict=True)], bool)
        own[own] = _firsts(rep[own])
        if not own.all():
            rep, count, side, sets, exact = rep[own], count[own], side[own], [s for s, k in zip(sets, own, strict=True) if k], [s for s, k in zip(exact, own, strict=True) if k]
        i, j = bayes_pairs(_signatures(sets), side, threshold, tolerance)
        real = exact_pairs(Sets.of(exact), i, j, threshold)
        i, j = i[real], j[real]
        if not len(i):
            return None
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, i, count[j])
        np.add.at(links, j, count[i])
        child, root = local_forest(rep[i], rep[j])
        has = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([rep[has], child])), pa.array(np.concatenate([links[has], np.zeros(len(child), np.int64)])), pa.array(np.concatenate([rep[has], root]), mask=np.arange(len(has) + len(child)) < len(has))],
            ["rep", "links", "root"],
        )

    results = materialise(grouped(jobs.select("job", "rep", "n", "cls", "side", "text"), "job", ["rep"], compare, "rep long, links long, root long"))
    joined = components(results.where("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = results.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "r")
    per = classes.select("cls", "rep", "n").join(links, F.col("rep") == F.col("r"), "left").join(joined, F.col("rep") == F.col("node"), "left")
    per = per.select("cls", F.col("rep").alias("rep_id"), F.col("n").alias("group_size"), F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = found.select("doc_id", "cls").join(per, "cls")
    out = out.select("doc_id", "rep_id", "group_size", "component_id", "n_links", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    none = F.lit(None).cast("long")
    # Rows that link with nothing: each is a class of its own.
    alone = every.where("doc_id is null").select("doc_id", none.alias("own")).unionByName(wordless)
    return out.unionByName(alone.select("doc_id", F.col("own").alias("rep_id"), F.lit(1).cast("long").alias("group_size"), F.col("own").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept")))


def _firsts(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), bool)
    out[np.unique(values, return_index=True)[1]] = True
    return out
