"""Odd cases that a reviewer's third round found, each wrong before."""

import random

from pyspark.sql import functions as F

from parlance import queries_blocks
from parlance.llm import line_dedup
from parlance.operators import monologue, review, speakers
from parlance.plans import engine
from parlance.sources import relations


def test_shares_round_their_exact_value(spark, tmp_path):
    """5220 of 20480 ms is 0.2548828125 exactly, a tie that goes to the even digit."""
    rows = [(1, 0, "user", "a " * 123), *((1, k, "assistant", "b " * n) for k, n in ((1, 120), (2, 120), (3, 119)))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries_blocks.interaction_aliases(spark, str(tmp_path)).first().speaker_dominance == "SPEAKER_00:0.254882812,SPEAKER_01:0.745117188"


def test_a_cut_monologue_ends_where_its_last_word_ends(spark):
    """Words of overlapping turns may start later and end earlier."""
    words = [{"ws_ms": a, "seg_idx": 0, "word_idx": k, "we_ms": b, "word": "w"} for k, (a, b) in enumerate([(0, 4000), (4000, 8009), (7990, 8001), (8001, 9000)])]
    row = [(1, 0, 0, "A", 0, 9000, 4, "w w w w", words, False, 0.0, True, 0.7)]
    schema = "session_id long, turn_idx long, span long, speaker string, s_ms long, e_ms long, n_words long, text string, words array<struct<ws_ms:long,seg_idx:long,word_idx:long,we_ms:long,word:string>>, in_range boolean, silence_ratio double, interruption_free boolean, score double"
    got = monologue.best(spark.createDataFrame(row, schema), limits=monologue.Limits(2_000, 3_000, 6_000, 8_000, 100)).first()
    assert (got.e_ms, got.n_words, got.text) == (8009, 3, "w w w")


def test_alike_lines_beside_smaller_ones_that_are_not(spark):
    """Pairs at 0.9 in buckets whose smallest line is alike to neither."""
    random.seed(5)
    letters = "abcdefghijklmnopqrstuvwxyz "

    def changed(line, places):
        x = list(line)
        for p in places:
            x[p] = random.choice(letters.replace(x[p], ""))
        return "".join(x)

    rows, pairs = [], []
    for g in range(8):
        base = "".join(random.choices(letters, k=200))
        pairs.append((10_000 + 2 * g, 10_001 + 2 * g))
        rows += [(pairs[-1][0], changed(base, [3])), (pairs[-1][1], changed(base, [196]))]
        rows += [(1000 * g + k, changed(base, random.sample(range(20, 180, 10), 7))) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    gone = {r.doc_id for r in line_dedup.line_dedup(df).collect()}
    assert gone == {z for _, z in pairs}


def test_rules_are_tried_once_on_a_text(spark):
    """Edges of words as before; a rule's pattern stands once in the plan, not once in each branch."""
    rows = [("help",), ("xhelp",), ("help_",), ("é help\n",), ("HELP! flight",), ("kitna",), ("galat?",), ("sign up",), ("",), (None,)]
    df = spark.createDataFrame(rows, "text string").select(speakers.domain(F.col("text"), F.length("text") > 3).alias("x"), speakers.intents(F.col("text")).alias("i"))
    assert [r.x.value for r in df.collect()] == ["customer_support", "casual", "casual", "customer_support", "mixed", "sales", "customer_support", "onboarding", "unknown", "unknown"]
    assert [r.i for r in df.collect()][5:8] == [["transaction"], ["question", "complaint"], ["informational"]]
    plan = df.select("x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("doctor") == 1 and plan.count("namaskar") == 1


def test_distances_are_dealt_over_all_tasks(spark):
    df = spark.range(40).select(F.col("id").alias("session_id"), F.lit(0).alias("idx"), F.lit("one two").alias("asr_text"), F.lit("one too").alias("reviewed_text"))
    found = review.error_rates(df)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {(r.word_errors, r.char_errors) for r in found.collect()} == {(1, 1)}


def test_words_meet_their_segments_where_they_are(spark, tmp_path):
    """Words of a run are dealt by session once, with their texts, and not again for their segments."""
    rows = [(s, k, "user" if k % 2 else "assistant", "one two, three") for s in range(3) for k in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, spoken = engine.annotate(*(f(spark, str(tmp_path)) for f in (relations.turns, relations.segments, relations.words)))
        plan = spoken._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert dealt and not [x for x in dealt if "seg_idx" in x or "word_idx" in x]
    assert spoken.count() == 36 and {r.word for r in spoken.where("word_idx = 1").collect()} == {"two,"}
