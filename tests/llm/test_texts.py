import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import bpe, exact_dedup, language_id, mixing
from parlance.llm.common import table


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# ---- op 1 -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    return bpe.load(bpe.TOKENIZER)


def hard_texts():
    rng = random.Random(1)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    return [
        "", " ", "a", "a" * 3000, pick("abcdefgé'sİ ́1!?", 4000), pick("etaoinsr", 5000), pick("ab \n\t", 3000),
        "x<|endoftext|>y" * 200, "'s'll're" * 300, " " * 2000, "é" * 2000, "ΣΑΣ ß İ" * 300, "日本語" * 700, "̈" * 1000, "12345!!.." * 300, "'" * 2000,
    ]


@pytest.mark.parametrize("leaf", [50, 333])
def test_joins_give_what_the_library_gives(tokenizer, leaf):
    for text in hard_texts():
        assert bpe.encode_text(tokenizer, text, leaf).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_bare_windows_agree_too(tokenizer):
    """The tree join alone, without white space to fall back on."""
    rng = random.Random(4)
    for _ in range(40):
        text = "".join(rng.choice("aeinorst'é1") for _ in range(rng.randint(2, 600)))
        cut = sorted(rng.sample(range(1, len(text)), min(3, len(text) - 1)))
        pieces = [bpe.Piece.of(tokenizer, text, a, b) for a, b in zip([0, *cut], [*cut, len(text)], strict=True)]
        assert bpe.join_all(tokenizer, text, pieces).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_encode_and_decode(spark, docs, tokenizer):
    rows = [(i, t) for i, t in enumerate(hard_texts())] + [(100, None), (101, "same"), (101, "same")]
    df = docs(rows)
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, leaf=400).collect())
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df, leaf=400)).collect()}
    assert back[101] == tokenizer.decode(tokenizer.encode("same", add_special_tokens=False).ids)
    assert bpe.digests(docs([])).count() == 0


# ---- op 2 -------------------------------------------------------------------------------------------------------


def test_exact_dedup(spark, docs):
    rng = random.Random(2)
    rows = [(i, rng.choice(["Abc", "abc", "ABC é", "abc É", "", None, "x" * 300 + rng.choice("AaBb")])) for i in range(200)]
    low = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    want = sorted((i, max(groups[low(t)]), len(groups[low(t)]), i == max(groups[low(t)]), sha(low(t))) for i, t in rows)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs(rows)).collect())) == want
    least = exact_dedup.exact_dedup(docs(rows), keep="min").where("kept").count()
    assert least == len(groups)


def test_exact_dedup_of_repeated_rows_keeps_one(docs):
    r = exact_dedup.exact_dedup(docs([(1, "a"), (1, "A"), (1, "b"), (None, "c")])).collect()
    assert sorted((x.doc_id or 0, x.group_size, x.kept) for x in r) == [(0, 1, True), (1, 1, True), (1, 2, False), (1, 2, True)]
    assert exact_dedup.exact_dedup(docs([])).count() == 0


# ---- op 8 -------------------------------------------------------------------------------------------------------


def water(sizes, weights, share=1.5):
    want, left, out = share * sum(sizes.values()), dict(sizes), {}
    want = min(want, 2 * sum(sizes.values()))
    while left:
        level = want / sum(weights[s] for s in left)
        full = [s for s in left if level * weights[s] > 2 * left[s] + 1e-9]
        if not full:
            return out | {s: level * weights[s] for s in left}
        for s in full:
            out[s] = 2.0 * left.pop(s)
            want -= out[s]
    return out


def test_targets_and_words_taken(spark):
    rng = random.Random(3)
    rows = [(i, "\t".join("w" for _ in range(rng.randint(0, 400))) if i % 17 else None, rng.choice(["b", "a", None, "c", "d"])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("rank", F.lit(1))
    got = mixing.mixed(df).toPandas()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert {int(a): int(b) for a, b in zip(got.doc_id, got["size"], strict=True)} == size
    src = {i: s for i, _, s in rows}
    totals = {}
    for i, s in src.items():
        totals[s] = totals.get(s, 0) + size[i]
    order = sorted((s for s in totals if s is not None)) + [None]
    want = water(totals, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    got["source"] = got.doc_id.map(src)
    for s in order:
        part = got[got.source.isna() if s is None else got.source == s]
        assert abs(part.target.iloc[0] - want[s]) < 1e-6
        assert abs(part.taken.sum() - want[s]) <= 0.02 * want[s] + 64
    assert (got.taken <= 2 * got["size"]).all()
    again = mixing.mixed(df).toPandas()
    assert dict(zip(again.doc_id, again.taken, strict=True)) == dict(zip(got.doc_id, got.taken, strict=True))


def test_mixed_texts_hold_the_words_taken(spark, docs):
    rng = random.Random(5)
    df = docs([(i, " ".join(f"w{i}_{k}" for k in range(rng.randint(0, 200)))) for i in range(60)])
    taken = {r.doc_id: r.taken for r in mixing.mixed(df).collect()}
    texts = {r.doc_id: r.text for r in mixing.mixed_texts(df, ["doc_id", "text", "source"]).collect()}
    assert {i: n for i, n in taken.items() if n} == {i: len(t.split()) for i, t in texts.items()}
    assert all(w.startswith(f"w{i}_") for i, t in texts.items() for w in t.split())


def test_mixing_nothing(spark, docs):
    assert mixing.mixed(docs([])).count() == 0
    r = mixing.mixed(docs([(1, None), (2, ""), (3, None)])).collect()
    assert [(x["size"], x.taken) for x in r] == [(0, 0)] * 3


def test_permutations_are_permutations():
    import numpy as np

    for n in (1, 2, 3, 17, 1000):
        for key in (0, 99):
            got = mixing._permute(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(got.tolist()) == list(range(n))


def test_shards_add_up_to_the_quotas():
    import numpy as np

    quota = np.array([500, 0, 37, 1203])
    shards = -(-int(quota.sum()) // 64)
    whole = list(mixing.shard_counts(quota, shards, 64, 1, 0, shards))
    assert (sum(c for _, c, _ in whole) == quota).all() and all(c.sum() == 64 for _, c, _ in whole[:-1])
    part = list(mixing.shard_counts(quota, shards, 64, 1, 5, 9))
    assert [(s, c.tolist(), d.tolist()) for s, c, d in part] == [(s, c.tolist(), d.tolist()) for s, c, d in whole[5:9]]


def test_large_splits_are_drawn():
    left = np.array([2_000_000_000, 0, 700_000_000, 40, 300_000_000], np.int64)
    n = int(left.sum()) // 2
    drawn = np.array([mixing._split(np.random.default_rng(k), left, n) for k in range(400)])
    assert (drawn.sum(axis=1) == n).all() and (drawn >= 0).all() and (drawn <= left).all()
    share = left / left.sum()
    sd = np.sqrt(n * share * (1 - share))  # of a multinomial draw
    assert np.allclose(drawn.std(axis=0), sd, rtol=0.2) and (np.abs(drawn.mean(axis=0) - left / 2) <= sd * 0.25).all()


# ---- op 9 -------------------------------------------------------------------------------------------------------


def test_held_out_languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    r = language_id.identify(docs, model).join(docs.select(F.col("doc_id").alias("d"), "lang"), F.col("doc_id") == F.col("d")).collect()
    held = [x for x in r if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    assert len(r) == docs.count() and sum(x.lang == x.lang_pred for x in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 for x in r)


def test_texts_without_letters_are_und(spark, docs):
    train = docs([(i, t) for i, t in enumerate(["the cat and the dog"] * 8)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = language_id.train(train)
    r = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs([(1, None), (2, "123 ... 4"), (3, ""), (4, "the cat")]), model).collect()}
    assert r[1] == r[2] == r[3] == ("und", 0.0) and r[4][0] in ("en", "de")
    assert language_id.identify(docs([]), model).count() == 0


def test_nothing_to_learn_from(spark, docs):
    model = language_id.train(docs([(1, "x")]).withColumn("lang", F.lit(None).cast("string")))
    assert language_id.identify(docs([(1, "some words")]), model).first().lang_pred == "und"


def test_a_prediction_does_not_depend_on_its_neighbours(spark, sf_dir):
    model = language_id.train(table(spark, sf_dir, "documents"))
    texts = ["The house", "la maison", "das Haus, und", "x"]
    assert [s for t in texts for s in model.predict([t])[1]] == model.predict(texts)[1]
