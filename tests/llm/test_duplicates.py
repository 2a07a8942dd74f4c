import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import components, embedding_dedup, jaccard_join, line_dedup, minhash, segments, substring_dedup, suffix_dedup
from parlance.llm.common import grams_hash


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7), (None, 3)]
    want = Sets({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None and b is not None:
            want.join(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components.components(df).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: want.find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- op 4 -------------------------------------------------------------------------------------------------------


def fuzzy(rng, line):
    k = rng.randrange(len(line))
    return line[:k] + rng.choice("xyz ") + line[k + 1 :]


def line_corpus(rng):
    base = ["".join(rng.choice("abcdefghij klmno") for _ in range(rng.randint(60, 160))) for _ in range(12)]
    rows = []
    for i in range(50):
        lines = [rng.choice([lambda: rng.choice(base), lambda: fuzzy(rng, rng.choice(base)), lambda: "", lambda: "  ", lambda: "ab", lambda: "".join(rng.choice("abcdef ") for _ in range(90))])() for _ in range(rng.randint(1, 8))]
        rows.append((i, "\n".join(lines)))
    return rows + [(60, None), (61, ""), (62, "\n\n")]


def brute_lines(rows):
    first = {}
    for i, t in sorted(rows):
        for k, x in enumerate((t or "").split("\n")):
            if x.strip():
                first.setdefault(x, (i, k))
    lines = list(first)
    sets = {x: {x[k : k + 8] for k in range(max(1, len(x) - 7))} for x in lines}
    s = Sets(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            x, y = sets[lines[a]], sets[lines[b]]
            if len(x & y) >= 0.8 * len(x | y):
                s.join(a, b)
    keep = {}
    for k, x in enumerate(lines):
        keep[s.find(k)] = min(keep.get(s.find(k), first[x]), first[x])
    at = {x: keep[s.find(k)] for k, x in enumerate(lines)}
    return {i: [x for k, x in enumerate((t or "").split("\n")) if not x.strip() or at[x] == (i, k)] for i, t in rows}


def test_line_dedup(docs):
    rows = line_corpus(random.Random(3))
    want = brute_lines(rows)
    got = {r.doc_id: r for r in line_dedup.line_digests(docs(rows)).collect()}
    assert {i: r.kept_sha256 for i, r in got.items()} == {i: sha("\n".join(x)) for i, x in want.items()}
    texts = {r.doc_id: r.text for r in line_dedup.without_lines(docs(rows), line_dedup.line_dedup(docs(rows))).collect()}
    assert texts == {i: None if i == 60 else "\n".join(x) for i, x in want.items()}
    assert line_dedup.line_digests(docs([])).count() == 0


@pytest.mark.parametrize("inter,union", [(80, 100), (16, 20), (8, 10), (4, 5)])
def test_alike_lines_share_a_band(inter, union):
    """Pairs of lines at exactly the threshold, long and short."""
    n, half = 20_000, (union - inter) // 2
    hashes = np.random.default_rng(1).integers(0, 2**64, (n, union), dtype=np.uint64)
    keys = []
    for x in (hashes[:, : inter + half], np.hstack([hashes[:, :inter], hashes[:, inter + half :]])):
        signature = minhash.densified(minhash.sketch(np.repeat(np.arange(n), x.shape[1]), x.ravel(), n, line_dedup.BINS_LOG2))
        keys.append(minhash.band_keys(signature, line_dedup.BANDS, line_dedup.ROWS))
    assert (~(keys[0] == keys[1]).any(axis=1)).sum() <= 2


def test_repeated_rows_are_one_document(docs):
    r = line_dedup.line_digests(docs([(1, "one line here"), (1, "one line here"), (2, "one line here")])).collect()
    assert sorted((x.doc_id, x.n_removed) for x in r) == [(1, 0), (1, 0), (2, 1)]


# ---- op 5 -------------------------------------------------------------------------------------------------------


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + rng.normal(scale=0.22, size=16)).tolist(), int(i % 6 < 3)) for i in range(240)]
    rows += [(300 + k, rows[0][1], 1) for k in range(40)] + [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] + [1.0] * 15, 1), (404, rows[0][1], None), (405, [], 1), (406, rows[0][1][:8], 1)]
    unit, ok = {}, []
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[i] = np.array(v) / np.linalg.norm(v)
            ok.append((i, label))
    links, sets = Counter(), Sets([i for i, *_ in rows])
    for a, la in ok:
        for b, lb in ok:
            if a < b and la == lb and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93:
                links[a] += 1
                links[b] += 1
                sets.join(a, b)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("unit", F.lit("x"))
    for window in (256, 8):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_dedup(df, window=window).collect()}
        assert got == {i: (links[i], sets.find(i), sets.find(i) == i) for i, *_ in rows}
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_embeddings_of_a_dense_label(spark):
    """Vectors with a common direction, which sign hashes hardly tell apart: every planted pair is found."""
    rng = np.random.default_rng(6)
    n, d, pairs = 6000, 48, 150
    side = lambda k: (v := rng.normal(size=(k, d - 1))) / np.linalg.norm(v, axis=1, keepdims=True)
    common, spread = np.sqrt(0.85), np.sqrt(0.15)
    u = side(n)
    w = side(pairs)
    w -= (w * u[:pairs]).sum(axis=1, keepdims=True) * u[:pairs]
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    near = 1 - (1 - 0.94) / 0.15
    u[n - pairs :] = near * u[:pairs] + np.sqrt(1 - near**2) * w
    v = np.hstack([np.full((n, 1), common), spread * u])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = v @ v.T >= 0.93
    np.fill_diagonal(linked, False)
    sets = Sets(range(n))
    for a, b in zip(*np.nonzero(linked), strict=True):
        sets.join(int(a), int(b))
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_dedup(df).collect()}
    assert got == {i: (int(linked[i].sum()), sets.find(i)) for i in range(n)}


# ---- ops 6 and 7 ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("letters", ["ab", "abc", "a", "abcdefgh"])
def test_suffix_array(letters):
    rng = random.Random(6)
    for n in (1, 2, 3, 50, 400):
        text = "".join(rng.choice(letters) for _ in range(n)).encode()
        order = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8), 16)
        assert sorted(order.tolist()) == list(range(n))
        cut = [text[k : k + 16] for k in order]
        assert cut == sorted(cut)
        rising = suffix_dedup.smaller_than_next(np.frombuffer(text, np.uint8))
        assert rising.tolist() == [text[k:] < text[k + 1 :] if k + 1 < n else False for k in range(n)]


def repeat_corpus(rng):
    passage = ["".join(rng.choice("abcdefg hij é") for _ in range(rng.randint(150, 500))) for _ in range(6)]
    noise = lambda n: "".join(rng.choice("klmnop qrs\n") for _ in range(n))
    rows = [(i, noise(rng.randint(0, 300)) + rng.choice(passage) + noise(rng.randint(0, 300)) + (rng.choice(passage) if i % 3 else "")) for i in range(40)]
    rows += [(50, "ab" * 400), (51, "z" * 201), (52, "z" * 200), (53, None), (54, ""), (55, "word " * 90), (56, "x" * 199), (57, passage[0] * 3), (58, rows[0][1]), (59, rows[0][1])]
    return rows


@pytest.mark.parametrize("hot", [4096, 1])
def test_suffix_dedup(docs, monkeypatch, hot):
    monkeypatch.setattr(segments, "HOT", hot)
    rows = repeat_corpus(random.Random(7))
    count = Counter(b[k : k + 200] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - 199))
    want = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[i] = (len(b), int(gone.sum()), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_digests(docs(rows)).collect()}
    assert got == want
    assert suffix_dedup.suffix_digests(docs([])).count() == 0


@pytest.mark.parametrize("hot", [4096, 1])
def test_substring_dedup(docs, monkeypatch, hot):
    monkeypatch.setattr(segments, "HOT", hot)
    rng = random.Random(8)
    passage = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(15, 60))) for _ in range(6)]
    noise = lambda n: " ".join(f"n{rng.randrange(40)}" for _ in range(n))
    rows = [(i, noise(rng.randint(0, 30)) + "\t" + rng.choice(passage) + "\x0b" + noise(rng.randint(0, 30)) + " " + rng.choice(passage)) for i in range(40)]
    rows += [(50, "und " * 90), (51, "a b " * 30), (52, None), (53, ""), (54, "a b c"), (55, rows[0][1]), (56, rows[0][1])]
    rng.shuffle(rows)
    seen, gone = {}, defaultdict(set)
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - 19):
            if tuple(w[k : k + 20]) in seen:
                gone[i].update(range(k, k + 20))
            else:
                seen[tuple(w[k : k + 20])] = 1
    want = {i: (len(w), len(gone[i]), sha(b" ".join(x for k, x in enumerate(w) if k not in gone[i]))) for i, t in rows for w in [(t or "").encode().split()]}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_digests(docs(rows)).collect()}
    assert got == want
    assert substring_dedup.substring_digests(docs([])).count() == 0


def test_automaton_matches():
    rng = random.Random(9)
    for _ in range(60):
        machine, seen = substring_dedup.Automaton(), []
        for _ in range(4):
            s = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
            out = machine.read([ord(c) for c in s])
            for e in range(len(s)):
                best = max((n for n in range(1, e + 2) if any(t[k : k + n] == s[e - n + 1 : e + 1] for t in seen for k in range(len(t) - n + 1)) or any(s[k : k + n] == s[e - n + 1 : e + 1] for k in range(e - n + 1))), default=0)
                assert out[e] == best
            seen.append(s)


def test_gram_hashes_depend_on_content_only():
    x = np.frombuffer(b"..abcde..abcde", np.uint8)
    h = grams_hash(x, 5)
    assert (h[:3] == h[7:]).all() and len(set(h.tolist())) == 7


# ---- op 10 ------------------------------------------------------------------------------------------------------


def near_corpus(rng):
    rows = []
    for g in range(8):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 12, 60, 200]))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            rows.append((len(rows), rng.choice([" ", "\n"]).join(w)))
    return rows + [(200, None), (201, ""), (202, " "), (203, "one"), (204, "one"), (205, "one two")]


def brute_join(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {i}
    links, s = Counter(), Sets(sets)
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12:
                links[a] += 1
                links[b] += 1
                s.join(a, b)
    return {i: (links[i], s.find(i), s.find(i) == i) for i in sets}


@pytest.mark.parametrize("rows_in_block", [512, 2])
def test_jaccard_join(docs, monkeypatch, rows_in_block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", rows_in_block)
    rows = near_corpus(random.Random(10))
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in jaccard_join.jaccard_join(docs(rows)).collect()}
    assert got == brute_join(rows)
    assert jaccard_join.jaccard_join(docs([])).count() == 0


def test_intersections_by_matrix_and_by_hand():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    got = minhash._all_common(minhash.Sets.of(sets))
    i, j = np.triu_indices(30, 1)
    assert (minhash._common(minhash.Sets.of(sets), i, j) == got[i, j]).all()
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_pruning_keeps_all_pairs_at_the_threshold():
    assert minhash.least_matches(0, 0.8, 1e-7) == 0
    assert minhash.least_matches(64, 0.8, 1e-7) < 40 < minhash.least_matches(64, 0.8, 0.5)


# ---- hashes ------------------------------------------------------------------------------------------------------


def thue_morse(n, a, b):
    """A word on which polynomial hashes modulo 2**64 of it and of its complement agree, whatever the base."""
    return [(a, b)[bin(k).count("1") % 2] for k in range(n)]


def test_words_are_told_apart_by_their_bytes(docs):
    one, other = "".join(thue_morse(4096, "a", "b")), "".join(thue_morse(4096, "b", "a"))
    rest = " ".join(f"w{k}" for k in range(19))
    r = {x.doc_id: x.n_removed for x in substring_dedup.substring_digests(docs([(1, f"{one} {rest}"), (2, f"{other} {rest}")])).collect()}
    assert r == {1: 0, 2: 0}
    r = jaccard_join.jaccard_join(docs([(1, f"{one} x y z"), (2, f"{other} x y z")])).collect()
    assert [x.n_links for x in r] == [0, 0] and all(x.kept for x in r)


def test_lines_sets_are_exact():
    rng = random.Random(2)
    for k in (3, 8, 11):
        lines = ["".join(rng.choice("abé日本c") for _ in range(rng.randint(0, 40))) for _ in range(40)] + ["", "ab"]
        sets = line_dedup._sets(lines, k)
        want = [{x[i : i + k] for i in range(len(x) - k + 1)} for x in lines]
        got = [set(sets.code[a:b].tolist()) for a, b in zip(sets.at[:-1], sets.at[1:], strict=True)]
        assert [len(g) for g in got] == [len(w) for w in want]
        assert all(len(got[a] & got[b]) == len(want[a] & want[b]) for a in range(len(lines)) for b in range(a))


def test_equal_values_stand_together(monkeypatch):
    """Also where hashes begin alike for different values, as a constant hash makes all do."""
    for alike in (False, True):
        if alike:
            monkeypatch.setattr(line_dedup, "mix", lambda x: np.zeros_like(x))
        for n in (0, 1, 2, 1000):
            values = np.random.default_rng(n).integers(0, 50, n).astype(np.uint64)
            order = line_dedup._equal_together(values)
            assert sorted(order.tolist()) == list(range(n))
            ranked = values[order].astype(np.int64)
            assert np.count_nonzero(np.diff(ranked)) == max(0, len(set(values.tolist())) - 1)


def test_smallest_hashes_of_bins():
    rng = np.random.default_rng(4)
    item, hashes = rng.integers(0, 9, 700).astype(np.int32), rng.integers(0, 2**64, 700, dtype=np.uint64)
    hashes[:9] = np.uint64(2**64 - 1)
    expected = np.full((9, 64), minhash.EMPTY)
    for k, h in zip(item.tolist(), hashes.tolist(), strict=True):
        low = min((h >> 26) & 0xFFFFFFFF, 0xFFFFFFFE)
        expected[k, h >> 58] = min(expected[k, h >> 58], low)
    assert (minhash.sketch(item, hashes, 9, 6) == expected).all()


def test_rows_without_an_id_stay(docs):
    text = " ".join(f"word{k}" for k in range(60))
    rows = docs([(None, text), (1, text), (None, None), (2, text)])
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert [(x.doc_id, x.n_removed) for x in sorted(substring_dedup.substring_digests(rows).collect(), key=key)][:2] == [(1, 0), (2, 60)]
    assert sorted(x.n_removed for x in substring_dedup.substring_digests(rows).collect() if x.doc_id is None) == [0, 60]
    assert sorted(x.n_removed for x in suffix_dedup.suffix_digests(rows).collect()) == [0, len(text), len(text), len(text)]
    assert sorted((x.doc_id or 0, x.n_links, x.kept) for x in jaccard_join.jaccard_join(rows).collect()) == [(0, 0, True), (0, 0, True), (1, 1, True), (2, 1, False)]
    assert sorted((x.doc_id or 0, x.n_removed) for x in line_dedup.line_digests(rows).collect()) == [(0, 0), (0, 0), (1, 0), (2, 1)]


def test_different_texts_under_one_id(docs):
    a, b = " ".join(f"a{k}" for k in range(80)), "short text"
    rows = docs([(1, a), (1, b), (2, a)])
    assert sorted((x.doc_id, x.n_words, x.n_removed) for x in substring_dedup.substring_digests(rows).collect()) == [(1, 2, 0), (1, 80, 0), (2, 80, 80)]
    assert sorted((x.doc_id, x.n_removed) for x in suffix_dedup.suffix_digests(rows).collect()) == [(1, 0), (1, len(a)), (2, len(a))]


def test_large_buckets_of_lines(docs, monkeypatch):
    """Clusters of more lines than a block or a batch holds."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    monkeypatch.setattr(line_dedup, "COMPARE", 16)
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdefgh") for _ in range(120)) for _ in range(2)]
    rows = [(i, fuzzy(rng, fuzzy(rng, rng.choice(base)))) for i in range(70)]
    got = {r.doc_id: r.n_removed for r in line_dedup.line_digests(docs(rows)).collect()}
    assert got == {i: int(not x) for i, x in brute_lines(rows).items()}
