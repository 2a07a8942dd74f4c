"""Cases that a reviewer's fourth round found, each wrong before."""

import json

import pytest

from parlance import queries
from parlance.operators import monologue
from parlance.plans import engine
from parlance.sources import relations

REPORTS = ("interaction", "language", "quality", "tiers", "speakers", "monologue", "validation", "code_switch", "code_switch_density")


@pytest.fixture(scope="module")
def talks(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("talks"))
    rows = [(1, 0, "user", "um hello there. what is the price"), (1, 1, "assistant", "haan nahi it is ten, " * 30), (1, 2, "user", "ok"), (2, 0, "system", "be kind"), (2, 1, "user", "namaste")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(d + "/conversations.parquet")
    return d


def test_a_session_record_holds_every_report(spark, talks):
    """only six columns were selected, so Spark left out the joins and the work of all other reports."""
    found = {r.session_id: r.asDict() for r in queries.session_records(spark, talks).collect()}
    whole = engine.run(*(f(spark, talks) for f in (relations.turns, relations.segments, relations.words)))
    assert set(found) == {1, 2}
    assert not [c for c in whole.columns if c not in found[1] and f"{c}_sha256" not in found[1]]
    assert all(r[c] is not None for r in found.values() for c in REPORTS)
    r = {c: json.loads(found[1][c]) for c in REPORTS}
    assert r["interaction"]["total_turns"] == found[1]["total_turns"] == 3 and r["interaction"]["dominant_speaker"] == "SPEAKER_01"
    assert r["language"]["n_languages"] == 3 and r["code_switch"]["switch_count"] == r["language"]["switch_count"] == 2
    assert sum(r["tiers"].values()) == found[1]["n_segments"] == r["quality"]["segment_count"] == 3
    people = r["speakers"]["profiles"]
    assert list(people) == ["SPEAKER_00", "SPEAKER_01"] and [people[k]["n_turns"] for k in people] == [2, 1]
    assert sum(p["word_count"] for p in people.values()) == r["quality"]["word_count"] == r["code_switch_density"]["words"] == 7 + 150 + 1
    assert people["SPEAKER_00"]["filler_count"] == 1 and r["code_switch_density"]["switches"] > 0
    assert r["monologue"]["speaker"] == "SPEAKER_01" and "haan nahi it is ten," in r["monologue"]["text"]
    assert len(r["validation"]["issues"]) == r["validation"]["issue_count"] == found[1]["issue_count"]


def test_what_is_found_of_segments_and_words_is_in_the_record(spark, talks):
    """overlaps, matrix languages and words were made or left out, and in no record."""
    r = {x.session_id: x for x in engine.run(*(f(spark, talks) for f in (relations.turns, relations.segments, relations.words))).collect()}
    a = r[1].annotations.segments
    assert [x.idx for x in a] == [0, 1, 2] and [x.matrix_language for x in a] == ["en", "en", "en"] and a[1].cs_density > 0 == a[0].cs_density
    assert {x.overlap_type is not None for x in a if x.overlap} <= {True} and all(x.confidence_band_relative for x in a)
    words = r[1].words.list
    assert len(words) == 158 and [(w.text, w.trailing_punct, w.lang) for w in words[:3]] == [("um", "", "en"), ("hello", "", "en"), ("there", ".", "en")]
    assert r[2].words.list[0].lang == "hi-Latn" and len(r[2].annotations.segments) == 1


def test_spans_of_a_turn_are_broken_one_by_one_where_they_lie(spark):
    """Spans with their words are dealt by turn once, and not again for who broke in."""
    words = [(1, 0, k, 1000 * t, 1000 * t + 900, f"w{t}") for k, t in enumerate((0, 1, 2, 10, 11, 12, 40, 41))]
    words = spark.createDataFrame(words, "session_id long, seg_idx long, word_idx long, ws_ms long, we_ms long, word string")
    turns = spark.createDataFrame([(1, 0, "A", 0, 50_000), (1, 1, "B", 10_500, 10_600), (1, 2, "B", 60_000, 61_000)], "session_id long, idx long, speaker string, s_ms long, e_ms long")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = monologue.spans(words, turns)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "span" in x]
    assert [(r.span, r.n_words, r.interruption_free) for r in found.orderBy("span").collect()] == [(0, 3, True), (1, 3, False), (2, 2, True)]
    for longest in (1_000, 5_000):
        limits = monologue.Limits(100, 200, 500, longest)
        whole, bare = (monologue.best(found, limits=limits, keep_words=k).drop("words").first() for k in (True, False))
        assert whole == bare and whole.n_words > 0
