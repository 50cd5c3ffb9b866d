"""Suffix arrays of shards: as many array operations for many fragments as for few, and the prefixes that plain comparisons give."""

from __future__ import annotations

import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fleetquarry.llm import suffix_array, suffix_dedup


def shard_rows(n: int) -> pa.RecordBatch:
    """``n`` fragments of one seed in pairs of documents, every second of which repeats the windows of the one before."""
    rng = random.Random(n)
    middle = bytes(rng.randrange(97, 123) for _ in range(20))
    rows = []
    for i in range(0, n, 2):
        left, right = (bytes(rng.randrange(97, 123) for _ in range(15)) for _ in range(2))
        rows += [(i, left + middle + right, 1), (i + 1, b"<" + left + middle + right + b">", 3)]
    at = [(i << suffix_dedup._START | windows - 1) for i, _, windows in rows]
    names = ["kind", "seed", "fragment", "doc_id", "at", "bytes"]
    columns = [[1] * n, [7] * n, list(range(n)), [i for i, _, _ in rows], at, [b for _, b, _ in rows]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def calls_of(rows: pa.RecordBatch) -> tuple[int, list[tuple[int, int]]]:
    calls, found = 0, []

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        for batch in suffix_dedup._shard(iter([rows]), 1 << 30):
            found += zip(batch.column("doc_id").to_pylist(), batch.column("at").to_pylist())
    finally:
        sys.setprofile(None)
    return calls, found


def test_a_shard_is_solved_by_arrays_not_by_fragments():
    few, _ = calls_of(shard_rows(1000))
    many, found = calls_of(shard_rows(8000))
    # the second window of each odd document starts behind its first byte
    assert sorted(found) == [(i, i + 1 << suffix_dedup._START) for i in range(1, 8000, 2)]
    assert many - few < 3 * 7000


@pytest.mark.parametrize("shard_bytes", [1, 500, 1 << 20])
def test_shards_end_where_seeds_do(shard_bytes):
    """Batches that part a seed, empty ones, shards of one seed or of all: the same windows."""
    one = shard_rows(40)
    seeds = [pa.array(np.repeat(np.arange(4), 10) + k) for k in (0, 3)]
    rows = [pa.RecordBatch.from_arrays([one.column(0), s, *one.columns[2:]], one.schema.names) for s in seeds]
    batches = [b.slice(i, 7) for b in rows for i in (*range(0, 40, 7), 40)]
    found = [x for b in suffix_dedup._shard(iter(batches), shard_bytes) for x in b.column("doc_id").to_pylist()]
    assert sorted(found) == sorted([*range(1, 40, 2)] * 2)


@pytest.mark.parametrize("symbols, most", [(2, 50), (4, 9), (257, 50), (1 << 40, 5)])
def test_common_prefixes_are_counted_to_the_symbol(symbols, most):
    rng = np.random.default_rng(symbols)
    text = np.concatenate([rng.integers(0, symbols, 400), np.tile(rng.integers(0, symbols, 60), 3), np.full(70, symbols - 1)])
    plain = text.tolist()
    order = np.array(sorted(range(len(plain)), key=lambda i: plain[i:]))

    def shared(i: int, j: int) -> int:
        k = 0
        while k < most and max(i, j) + k < len(plain) and plain[i + k] == plain[j + k]:
            k += 1
        return k

    assert suffix_array.common_prefixes(text, order, most).tolist() == [shared(i, j) for i, j in zip(order, order[1:])]


def test_doubling_sorts_strings_of_few_and_many_names():
    for symbols, n in ((1, 90), (2, 300), (40, 300), (300, 300), (1, 1)):
        names = np.random.default_rng(n).integers(0, symbols, n)
        plain = names.tolist()
        assert suffix_array._by_doubling(names).tolist() == sorted(range(n), key=lambda i: plain[i:])


def documents(n: int) -> list[tuple[int, str]]:
    """Passages of a few words, each in many documents between others, copies, a text of one letter."""
    rng = random.Random(n)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(40, 120))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(passages) + rng.choice(["", "x", "yz"]) for _ in range(6))) for i in range(n)]
    return [*rows, (n, rows[0][1]), (n + 1, "x" * 400), (n + 2, "y" + "x" * 200), (-1, rows[3][1][20:])]


def test_fragments_are_exchanged_by_bucket():
    """A batch sends a row a bucket, or for every PIECE fragments of one, not a row a fragment."""
    rows = documents(300)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["doc_id", "text"])
    sent = pa.Table.from_batches(list(suffix_dedup._cut(iter([batch]), 64)))
    fragments = sum(len(x) for x in sent.column("rows").to_pylist()) // 32
    assert sent.num_rows <= 64 and fragments > 4000


@pytest.mark.parametrize("limits", [{}, {"held": 3, "most": 2}, {"held": 50, "most": 5, "shard_bytes": 700}, {"held": 10}])
def test_buckets_that_are_thinned_out_give_the_same_rows(spark, monkeypatch, limits):
    monkeypatch.setattr(suffix_dedup, "PIECE", 7)
    monkeypatch.setattr(suffix_dedup, "PIECES_BYTES", 500)
    rows = documents(60)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), **limits)
    seen: dict[str, int] = {}
    for i, t in sorted(rows):
        for p in range(len(t) - 49):
            seen.setdefault(t[p : p + 50], i)
    want = {}
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - 49):
            if seen[t[p : p + 50]] < i:
                gone[p : p + 50] = [True] * 50
        want[i] = (len(t), sum(gone), sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone)))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect()} == want


def test_a_bucket_is_judged_in_parts_as_at_once():
    """Thinned out after every few rows, or never: the same rows are settled or left with one doubt the more, none is lost."""
    rows = documents(200)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["doc_id", "text"])
    sent = list(suffix_dedup._cut(iter([batch.slice(i, 20) for i in range(0, len(rows), 20)]), 1))
    once, parts = (pa.Table.from_batches(list(suffix_dedup._settle(iter(sent), 1 << 30, n))) for n in (1 << 30, 100))
    assert Counter(zip(*(once.column(c).to_pylist() for c in ("kind", "doc_id", "at")))) == Counter(zip(*(parts.column(c).to_pylist() for c in ("kind", "doc_id", "at"))))
    some = pa.Table.from_batches(list(suffix_dedup._settle(iter(sent), 3, 100)))
    assert suffix_dedup.BIG in some.column("kind").to_pylist() and some.num_rows >= once.num_rows
