"""Comparisons of recognisers' words: the same values as before, in one shuffle, and in time for long sessions."""

import random
import time
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from parlance import queries
from parlance.functions import sequences
from parlance.operators import consensus


def _lists(seed):
    random.seed(seed)
    base = [f"w{int(random.random() ** 2 * random.choice([2, 20, 300]))}" for _ in range(random.choice([0, 1, 30, 199, 200, 400]))]
    return [base, [w for k, w in enumerate(base) if k % 7 != 6], [w for k, w in enumerate(base) for w in ([w, w] if k % 5 == 4 else [w])], random.sample(base, len(base))]


def test_pairs_of_lists_as_difflib_has_them(spark):
    rows = [(s, f"e{k}", words) for s in range(40) for k, words in enumerate(_lists(s))]
    df = spark.createDataFrame([*rows, (None, "e0", ["a"]), (None, "e1", ["a"]), (1, None, ["a"])], "session_id long, engine string, words array<string>")
    said = {(s, e): w for s, e, w in rows}
    found = consensus.sequences(df).join(consensus.bags(df), ["session_id", "engine", "peer"]).collect()
    assert len(found) == 40 * 12
    for r in found:
        a, b = said[r.session_id, r.engine], said[r.session_id, r.peer]
        assert r.similarity == SequenceMatcher(None, a, b).ratio()
        assert r.bag == ((Counter(a) & Counter(b)).total() / max(len(a), len(b)) if a or b else 1.0)


def test_a_long_session_is_compared_in_time(spark):
    """8,000 words: parting at each of thousands of blocks by a look at all that is left took minutes."""
    random.seed(3)
    base = [f"w{random.randrange(2000)}" for _ in range(8000)]
    twice = [w for k, w in enumerate(base) for w in ([w, w] if k % 5 == 4 else [w])]
    df = spark.createDataFrame([(base, twice)], "a array<string>, b array<string>").select(sequences.sequence_similarities(F.array("a", "b")).alias("x"))
    began = time.perf_counter()
    assert [p.x for p in df.first().x] == [2.0 * 8000 / 17600] * 2
    assert time.perf_counter() - began < 20


def test_texts_of_sessions_travel_once(spark, sf_dir):
    """One shuffle of the turns serves the numbering, the times, the gathering by engine and the comparison."""
    for name in ("candidate_bag_overlap", "token_sequence_similarity", "timing_agreement"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, name
