"""Identifiers at the ends of the long range, null ones, and rows that repeat one."""

import hashlib

import pytest

from parlance.llm import bpe, exact_dedup, jaccard_join, substring_dedup, suffix_dedup

LOW, HIGH = -(2**63), 2**63 - 1


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup_keeps_the_ends_of_the_range(docs, keep):
    rows = [(LOW, "a"), (HIGH, "b"), (None, "b"), (None, "c"), (LOW, "d"), (None, "D"), (LOW, "e"), (HIGH, "E"), (None, "e"), (None, "c")]
    got = exact_dedup.exact_dedup(docs(rows).repartition(3), keep=keep).collect()
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == sorted((str(i), hashlib.sha256(t.lower().encode()).hexdigest()) for i, t in rows)
    best = {"a": LOW, "b": HIGH, "c": None, "d": LOW, "e": HIGH if keep == "max" else LOW}
    for text, stays in best.items():
        group = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        assert {r.keep_id for r in group} == {stays}
        assert [r.doc_id for r in group if r.kept] == [stays]
        assert {r.group_size for r in group} == {len(group)}


@pytest.mark.parametrize("digests", [suffix_dedup.suffix_digests, substring_dedup.substring_digests])
def test_removal_keeps_the_ends_of_the_range(docs, digests):
    shared = " ".join(f"word{k}" for k in range(60))
    rows = [(HIGH, shared), (None, shared), (LOW, "short"), (HIGH, "x")]
    got = digests(docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    removed = {(r.doc_id, r[1]): r.n_removed for r in got}
    size = 60 if "n_words" in got[0].asDict() else len(shared)
    assert removed[None, size] == size  # the row without an id comes last
    assert removed[HIGH, size] == (0 if "n_words" in got[0].asDict() else size)


def test_long_texts_without_an_id(docs):
    pytest.importorskip("public_tokenizers")
    tokenizer = bpe.load(bpe.TOKENIZER)
    text = "some words and then more of them " * 60 + "unsplit" * 300
    rows = [(None, text), (None, text + "!"), (7, text), (LOW, text), (None, None), (None, "a")]
    got = bpe.encode(docs(rows), leaf=500).collect()
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((str(i), x) for i, x in want)
    found = bpe.digests(docs(rows), leaf=500).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)


def test_repeated_rows_without_words_link_with_nothing(docs):
    rows = [(5, ""), (5, ""), (5, None), (6, " "), (None, ""), (8, "a b c d e f"), (9, "a b c d e f"), (5, "a b c d e f")]
    got = jaccard_join.jaccard_join(docs(rows)).collect()
    assert len(got) == len(rows)
    alone = sorted((r.doc_id or 0, r.rep_id, r.group_size, r.component_id, r.n_links, r.kept) for r in got if r.group_size == 1)
    assert alone == [(0, None, 1, None, 0, True), *[(5, 5, 1, 5, 0, True)] * 3, (6, 6, 1, 6, 0, True)]
    assert sorted((r.doc_id, r.rep_id, r.n_links, r.kept) for r in got if r.group_size == 3) == [(5, 5, 2, True), (8, 5, 2, False), (9, 5, 2, False)]
