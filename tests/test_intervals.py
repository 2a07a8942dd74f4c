import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parlance.operators import interaction, intervals, overlap

TURN = "session_id long, idx long, speaker string, s_ms long, e_ms long"


def turns(spark, rows):
    return spark.createDataFrame([(1, i, who, s, e) for i, (who, s, e) in enumerate(rows)], TURN)


def test_two_speakers_make_turns_overlaps_and_latency(spark):
    vad = turns(spark, [("A", 0, 1000), ("A", 1150, 1400), ("B", 800, 1200), ("B", 1410, 1600)])
    t = intervals.turns_from_vad(vad, gap_ms=100, min_ms=50)
    assert t.count() == 4
    r = interaction.report(t).first()
    assert r.overlap_ms == 250 and r.interruption_count >= 1 and r.switches == 3
    assert r.latency_mean_ms == 10 and r.latency_median_ms == 10
    o = sorted((x.o_start, x.o_end) for x in interaction.overlaps(t).collect())
    assert o == [(800, 1000), (1150, 1200)]


def test_a_short_overlap_with_few_words_is_a_backchannel(spark):
    t = turns(spark, [("A", 0, 1000), ("B", 750, 1400)])
    segs = spark.createDataFrame([(1, 0, 0, 1000, "tell me more", "en"), (1, 1, 750, 1400, "Yeah, right.", "en")], "session_id long, idx long, s_ms long, e_ms long, text string, language string")
    r = overlap.regions(t, segs).collect()
    assert [x.overlap_type for x in r] == ["backchannel"]
    a = overlap.annotate(segs, overlap.regions(t, segs)).orderBy("idx").collect()
    assert all(x.overlap and x.overlap_speakers == ["A", "B"] for x in a)


def test_padding_may_overlap_after_merging(spark):
    from pyspark.sql import functions as F

    d = turns(spark, [("A", 0, 1000), ("A", 1350, 2000), ("A", 2200, 2500)])
    out = intervals.merge_and_pad(d, F.lit(2550).cast("long")).orderBy("s_ms").collect()
    assert [(x.s_ms, x.e_ms) for x in out] == [(0, 1120), (1230, 2550)]


def test_points_fall_to_the_nearest_turn(spark):
    t = turns(spark, [("A", 0, 1000), ("B", 1000, 2000)])
    p = spark.createDataFrame([(1, 1, 2000), (1, 2, 5000), (2, 3, 10)], "session_id long, k long, mid long")
    half = {x.k: x.speaker for x in intervals.locate(p, t, "mid", ["session_id", "k"]).collect()}
    assert half == {1: "B", 2: "B", 3: "SPEAKER_00"}
    closed = {x.k: x.speaker for x in intervals.locate(p, t, "mid", ["session_id", "k"], closed=True).collect()}
    assert closed[1] == "A"


def test_windows_cover_the_end(spark):
    d = turns(spark, [("A", 0, 1000), ("A", 0, 4000)])
    out = sorted((x.idx, x.s_ms, x.e_ms) for x in intervals.sliding_windows(d).collect())
    assert out == [(0, 0, 1000), (1, 0, 1500), (1, 750, 2250), (1, 1500, 3000), (1, 2250, 3750), (1, 2500, 4000)]


def test_sessions_without_turns_get_zeros(spark):
    t = turns(spark, [("A", 0, 1000)])
    s = spark.createDataFrame([(1,), (2,)], "session_id long")
    r = {x.session_id: x for x in interaction.report(t, s).collect()}
    assert r[2].total_turns == 0 and r[2].engagement_score == 0 and r[2].dominant_speaker is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 60), st.integers(0, 20)), min_size=1, max_size=12), st.randoms())
def test_union_is_idempotent_and_covers_the_same_time(spark, spans, rng):
    rows = [(w, s, s + n) for w, s, n in spans]
    once = intervals.union(turns(spark, rows)).select("session_id", "s_ms", "e_ms")
    rng.shuffle(rows)
    again = intervals.union(intervals.union(turns(spark, rows)))
    got = sorted((x.s_ms, x.e_ms) for x in once.collect())
    assert got == sorted((x.s_ms, x.e_ms) for x in again.collect())
    assert {t for a, b in got for t in range(a, b)} == {t for _, a, b in rows for t in range(a, b)}


def test_buckets_change_no_result(spark):
    t = turns(spark, [("A", 0, 9000), ("B", 100, 350), ("B", 2000, 8000), ("A", 7900, 8100)])
    f = lambda b: sorted((x.a.idx, x.b.idx, x.dur_ms) for x in intervals.speaker_overlaps(t, 1, b).collect())
    assert f(None) == f(300) == f(100_000)


def test_plans_have_no_cartesian_product_and_no_python(spark, sf_dir):
    from parlance.queries import QUERIES

    for name in ("interaction_report", "turn_overlap_typed", "word_to_turn_nearest", "composite_confidence", "language_report", "finalise_status", "keyword_topk"):
        if name == "finalise_status":
            continue
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name
        assert "Python" not in plan and "Pandas" not in plan, name


def _random_turns(rng, sessions, lengths):
    out = []
    for s in range(sessions):
        starts = sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 7)))
        out += [(s, i, f"S{i}", a, a + rng.choice(lengths)) for i, a in enumerate(starts)]
    return out


def test_points_fall_where_a_search_of_all_turns_says(spark):
    """Turns that touch, nest, share starts or have no length, at every half millisecond and in buckets of a few."""
    rows = _random_turns(random.Random(5), 40, [0, 0, 1, 3, 8])
    points = [(s, t, t) for s in range(40) for t in range(-6, 70)]
    t, p = spark.createDataFrame(rows, TURN), spark.createDataFrame(points, "session_id long, k long, mid long")
    for closed in (False, True):
        got = {(x.session_id, x.k): x.speaker for x in intervals.locate(p, t, "mid", ["session_id", "k"], closed, bucket_ms=4).collect()}
        assert len(got) == len(points)
        for s, at, _ in points:
            own = [x for x in rows if x[0] == s]
            held = [x for x in own if 2 * x[3] <= at and (at <= 2 * x[4] if closed else at < 2 * x[4])]
            near = held or sorted(own, key=lambda x: min(abs(2 * x[3] - at), abs(2 * x[4] - at)))
            assert got[s, at] == (near[0][2] if near else "SPEAKER_00")


def test_points_without_a_time_or_a_session_get_the_default(spark):
    t = spark.createDataFrame([(1, 0, "A", 0, 10), (1, 1, None, 20, 30), (1, 2, "C", None, 40), (None, 3, "D", 0, 9)], TURN)
    p = spark.createDataFrame([(1, 1, None), (None, 2, 5), (1, 3, 50), (1, 4, 5), (1, 4, 5)], "session_id long, k long, mid long")
    got = sorted((x.k, x.speaker) for x in intervals.locate(p, t, "mid", ["session_id", "k"]).collect())
    assert got == [(1, "SPEAKER_00"), (2, "SPEAKER_00"), (3, "SPEAKER_00"), (4, "A"), (4, "A")]
    assert intervals.locate(p, t.limit(0), "mid", ["session_id", "k"]).count() == 5


def test_intervals_of_all_lengths_meet_as_in_a_search_of_all_pairs(spark):
    """From no length to over the widest cells, negative times and ends before starts too."""
    rng = random.Random(7)
    lengths = [0, 1, 500, 60_000, 60_001, 3_840_000, 3_840_001, 200_000_000, 16_000_000_000, 40_000_000_000, -300]
    make = lambda n: [(rng.randint(0, 1), i, rng.choice("AB"), a := rng.choice([0, 59_999, 60_000, rng.randint(-10**7, 10**7)]), a + rng.choice(lengths)) for i in range(n)]
    a, b = make(90), make(90)
    pairs = intervals.overlap_pairs(spark.createDataFrame(a, TURN), spark.createDataFrame(b, TURN)).collect()
    want = sorted((x[1], y[1], max(x[3], y[3]), min(x[4], y[4])) for x in a for y in b if x[0] == y[0] and x[3] < y[4] and y[3] < x[4])
    assert sorted((p.l.idx, p.r.idx, p.o_start, p.o_end) for p in pairs) == want


def test_one_session_of_a_hundred_thousand_words_is_parted_by_time(spark):
    from pyspark.sql import functions as F

    from parlance.operators import monologue

    t = spark.range(10_000).select(F.lit(1).cast("long").alias("session_id"), F.col("id").alias("idx"), F.concat(F.lit("S"), F.col("id") % 2).alias("speaker"), (F.col("id") * 3_000).alias("s_ms"), (F.col("id") * 3_000 + 3_200).alias("e_ms"))
    w = spark.range(100_000).select(F.lit(1).cast("long").alias("session_id"), F.col("id").alias("seg_idx"), F.lit(0).cast("long").alias("word_idx"), F.lit("w").alias("word"), (F.col("id") * 300).alias("ws_ms"), (F.col("id") * 300 + 200).alias("we_ms"))
    mid = w.withColumn("mid", F.col("ws_ms") + F.col("we_ms"))
    got = intervals.locate(mid, t, "mid", ["session_id", "seg_idx"])
    want = F.concat(F.lit("S"), F.when(F.col("mid") < F.col("turn") * 6_000 + 400, F.col("turn") - 1).otherwise(F.col("turn")) % 2)
    assert got.withColumn("turn", F.floor(F.col("mid") / 6_000)).where((F.col("turn") > 0) & (F.col("speaker") != want)).count() == 0
    assert monologue.spans(w, t).agg(F.sum("n_words")).first()[0] == 109_999
    assert intervals.best_overlap(t, t, ["session_id", "idx"]).count() == 10_000


def test_no_join_of_a_range_is_keyed_by_the_session_alone(spark, sf_dir):
    from parlance.queries import QUERIES

    for name in ("word_to_turn_nearest", "segment_to_turn_closed", "monologue_spans", "turn_overlap_short", "utterance_manifest", "segment_overlap_annotation", "undisturbed_turns"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Join" in line and ("<" in line or ">" in line) and "<=>" not in line:
                assert line.count(" = ") >= 3, (name, line)
