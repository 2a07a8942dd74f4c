"""A corpus pipeline of five stages: each works on all that the one before it kept.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import bpe, jaccard_join, language_id, line_dedup, mixing
from parlance.llm.common import discard, materialise, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(rows: DataFrame) -> DataFrame:
    """The columns of `documents`; n_chars follows the text."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter (null and empty texts too), and those whose language the machines doubt, go; lang becomes the prediction. Repeated rows are judged each."""
    model = language_id.train(docs)
    found = language_id.identify_rows(docs, model, [*COLUMNS])
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= language_id.REJECT_BELOW))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated and nearly repeated lines go; a document that had text and has none left goes with them. Null texts stay null; documents without a doc_id keep their lines."""
    rows = line_dedup.without_lines(docs, line_dedup.line_dedup(docs))
    return _as_documents(rows.where(F.col("text").isNull() | F.col("text").rlike(r"\S")))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays; documents without a doc_id link with nothing and stay. Rows that repeat a doc_id stay or go together."""
    kept = jaccard_join.jaccard_join(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias("k")).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col("k"), "left_semi").select(*COLUMNS)
    return named.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each document's text is the words that the mix takes of it, in its own order, those taken twice twice. Documents without words, null texts too, give the mix nothing and go."""
    return _as_documents(mixing.mixed_texts(docs, [*COLUMNS]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding: doc_id, lang, source, ids and n_tokens; a null text has no ids. Repeated rows are encoded each."""
    ids = bpe.encode(docs, keep=["lang", "source"], remembered=30_000)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", detect_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can't express the learned stage that comes first; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage wrote on the way goes when its result is written. An empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = written()
        docs = materialise(stage(spark, docs, sf_dir))
        discard(spark, before, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
