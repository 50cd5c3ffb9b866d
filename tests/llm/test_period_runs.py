"""Periodic runs against a plain search, odd rows included."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetquarry.llm import period_runs, queries
from fleetquarry.llm.suffix_tree import SuffixTree


def plain_runs(words, min_length=6, min_exponent=4):
    """Every period by itself: the longest stretches in which words a period apart are equal."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_exponent * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_the_tree_ranks_suffixes_and_extends_pairs(symbols):
    tree, n = SuffixTree(symbols), len(symbols)
    closed = [s + 1 for s in symbols] + [0]
    order = sorted(range(n + 1), key=lambda i: closed[i:])
    assert tree.rank[order].tolist() == list(range(n + 1))
    pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
    if pairs:
        i, j = np.array(pairs).T

        def plain(a, b):
            k = 0
            while a + k < n and b + k < n and symbols[a + k] == symbols[b + k]:
                k += 1
            return k

        assert tree.extension(i, j).tolist() == [plain(a, b) for a, b in pairs]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 6)), max_size=5),
    st.sampled_from([(6, 4), (2, 2), (3, 3), (6, 2.5)]),
)
def test_runs_are_those_of_a_plain_search(blocks, limits):
    symbols = [x for block, times in blocks for x in block * times]
    want = plain_runs(symbols, *limits)
    assert [tuple(r) for r in period_runs.runs_of(symbols, *limits).tolist()] == want
    codes = np.array(symbols, np.int64)
    parts = period_runs.stretches(codes, np.zeros(len(codes), np.int64), *limits)
    assert all(any(s <= a and a + n <= e for s, e in parts) for a, n, _ in want)
    if parts:
        assert [tuple(r) for r in period_runs._text_runs(symbols, parts, *limits).tolist()] == want


def test_stretches_of_one_text_do_not_see_those_of_another():
    codes, own = np.array([1] * 8), np.array([0] * 4 + [1] * 4)
    assert period_runs.stretches(codes, own, 3, 4) == [(0, 4), (4, 8)]
    assert period_runs.stretches(codes, own, 6, 4) == []


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n ", "a", "a a a a a", "a a a a a a", "A a A a A a A a A", "é é é é é é漢", "a b " * 40, "  x y"]
    for i in range(60):
        words = [rng.choice("abcdef") for _ in range(rng.randrange(80))]
        out.append(rng.choice([" ", "\n", "  "]).join(words + words[:3] * rng.randrange(8)))
    return [*out, " ".join(rng.choice(["w%d" % k for k in range(50)]) for _ in range(6000)) + " x y" * 3000]


def test_every_document_against_the_plain_search(spark, tmp_path):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(None, "b b b b b b b", "y", 2), (3, "a", "y", 2), (3, "a", "y", 2)]
    rows += [(1000 + i, "one two three four five six seven eight nine ten " * 3, None, None) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_period_runs(spark, str(tmp_path)).collect()]
    want = [plain_row(i, t) for i, t, *_ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_period_runs(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("limits", [(6, 4), (4, 2)])
def test_the_operator_keeps_its_own_limits(spark, limits):
    text = "a b a b c d d d d e f g e f g"
    row = period_runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), *limits).first()
    want = plain_runs(text.split(), *limits)
    assert [tuple(r) for r in row["runs"]] == want and row["n_words"] == 15
    gone = {i for s, n, q in want for i in range(s + q, s + n)}
    assert row["collapsed"] == " ".join(w for i, w in enumerate(text.split()) if i not in gone)
