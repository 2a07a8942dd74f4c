from pyspark.sql import functions as F

from parlance.operators import interaction
from parlance.sources import relations
from parlance.streaming import conversations as live


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def stream(spark, sf_dir, tmp_path, name):
    import os

    os.symlink(f"{sf_dir}/{name}.parquet", tmp_path / "part.parquet")
    return spark.readStream.schema(spark.read.parquet(f"{sf_dir}/{name}.parquet").schema).parquet(str(tmp_path))


def test_windows_equal_their_batch(spark, sf_dir, tmp_path):
    batch = live.windowed_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))
    out = drain(live.windowed_counts(stream(spark, sf_dir, tmp_path, "events")), "counts", "complete")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_duplicates_go(spark, sf_dir, tmp_path):
    s = stream(spark, sf_dir, tmp_path, "events")
    out = drain(live.distinct_rows(s, ["user_id"], "1000 days"), "firsts")
    assert out.count() == spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct().count()


def test_running_metrics_equal_the_report(spark, sf_dir, tmp_path):
    t = relations.turns(spark, sf_dir).select("session_id", "s_ms", "e_ms", "speaker")
    path = str(tmp_path / "turns")
    t.coalesce(1).write.parquet(path)
    out = drain(live.running_metrics(spark.readStream.schema(t.schema).parquet(path)), "running", "update")
    want = interaction.report(relations.turns(spark, sf_dir)).select("session_id", "total_turns", "switches", F.coalesce(F.col("latency_mean_ms"), F.lit(-1.0)).alias("m"))
    got = out.select("session_id", "turns", "switches", F.when(F.col("latencies") > 0, F.col("latency_sum_ms") / F.col("latencies")).otherwise(-1.0).alias("m"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
