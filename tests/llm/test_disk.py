"""What queries leave on disk once they have used it."""

import os
import time

from pyspark.sql import functions as F

from parlance.llm import line_dedup
from parlance.llm.common import CLEANUP, drop, materialise, shared_dir, written


def shuffles(spark):
    """Names of the session's shuffle files."""
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {x for top in tops for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_") and x.endswith(".data")}


def tables(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_shuffle_files_go_with_their_query(spark):
    spark.conf.set(CLEANUP, "false")
    df = spark.range(0, 4000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    df.collect()
    before = shuffles(spark)
    out = materialise(df)
    until = time.time() + 10
    while shuffles(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles(spark) - before
    assert spark.conf.get(CLEANUP) == "false"
    assert out.count() == df.count() == 1000 and sorted(out.collect()) == sorted(df.collect())


def test_only_named_tables_go(spark):
    a, b, none = materialise(spark.range(5)), materialise(spark.range(6)), materialise(spark.range(0))
    n = written()
    drop(a, none)
    assert written() == n - 2 and b.count() == 6


def test_lines_and_buckets_go_once_used(docs, spark):
    rows = docs([(k, f"one line that is here\nanother line number {k} of them, and it is long\n{k}") for k in range(60)])
    tables_before = tables(spark)
    removed = line_dedup.line_dedup(rows)
    files = {f.rsplit("/", 2)[-2] for f in removed.inputFiles()}
    left = tables(spark) - tables_before
    assert files and files <= left
    columns = [set(spark.read.parquet(f"{shared_dir(spark)}/{x}").columns) for x in left]
    assert not [c for c in columns if c & {"line", "hub"}]
    assert removed.count() >= 59
