"""Periodic runs of words: Lyndon roots extended in both directions by suffix trees.

Every run contains a Lyndon word as long as its period that is the longest Lyndon word at its start, by
one of the two inverse orders of words (Bannai et al. 2017). So two candidates for each word are enough. A candidate is
extended to the right by the suffix tree of the text and to the left by that of its reversal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import mixed, slices
from fleetquarry.llm.suffix_tree import SuffixTree

MIN_LENGTH = 6
MIN_EXPONENT = 4
BATCH_BYTES = 2 << 20
KIND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_periods(rank: list[int]) -> tuple[list[int], list[int]]:
    """Lengths of the longest Lyndon words at each position by the order of ``rank`` and by its inverse; 0 where
    the word would reach the end of the text with its terminator."""
    n = len(rank) - 1
    smaller, greater = [0] * n, [0] * n
    down, up = [n], []
    for i in range(n - 1, -1, -1):
        own = rank[i]
        while rank[down[-1]] > own:  # the terminator, of the least rank, stays
            down.pop()
        smaller[i] = down[-1] - i
        down.append(i)
        while up and rank[up[-1]] < own:
            up.pop()
        if up:
            greater[i] = up[-1] - i
        up.append(i)
    return smaller, greater


def runs_of(symbols: list[int], min_length: int = MIN_LENGTH, min_exponent: float = MIN_EXPONENT) -> np.ndarray:
    """(start, length, period) of every run in ``symbols``, by start, then period.

    ``min_exponent`` is 2 at least: shorter repeats are no runs.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead, behind = SuffixTree(symbols), SuffixTree(symbols[::-1])
    periods = np.concatenate(lyndon_periods(ahead.rank.tolist())).reshape(2, n)
    order, i = np.nonzero(periods)
    p = periods[order, i]
    right = ahead.extension(i, i + p)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    # the text before i and before i + p, read backwards
    left[inner] = behind.extension(n - i[inner], n - i[inner] - p[inner])
    length = left + p + right
    keep = length >= np.maximum(min_length, np.maximum(2, min_exponent) * p)
    found = np.stack([i - left, length, p], axis=1)[keep]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def stretches(codes: np.ndarray, own: np.ndarray, min_length: int, min_exponent: float) -> list[tuple[int, int]]:
    """Ranges of words that hold every run of their texts; ``own`` is the text of each word.

    In a run of exponent e two neighbouring words stand together at least ceil(e) - 1 times. Between two words
    that do so less often in their text no run goes on, so the text falls apart there. Counts are taken
    by hashed pairs: a collision joins stretches, it never parts one.
    """
    if not len(codes):
        return []
    same = own[1:] == own[:-1]
    need = math.ceil(max(2, min_exponent)) - 1
    if need > 1:
        slots = (1 << max(10, int(len(codes)).bit_length() + 1)) - 1
        key = mixed(mixed(codes[:-1].astype(np.uint64) << np.uint64(32) | codes[1:].astype(np.uint64)) + own[1:].astype(np.uint64))
        at = (key & np.uint64(slots)).astype(np.int64)
        same &= np.bincount(at[same], minlength=slots + 1)[at] >= need
    cuts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(codes)]])
    long = np.flatnonzero(np.diff(cuts) >= max(2, min_length))
    return [(int(cuts[k]), int(cuts[k + 1])) for k in long]


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words as a dictionary array, and len+1 offsets of the texts in them; words are cut at ASCII blanks."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full).dictionary_encode(), kept[ends.astype(np.int64)]


def _text_runs(codes: list[int], parts: list[tuple[int, int]], min_length: int, min_exponent: float) -> np.ndarray:
    """Runs of one text, found in its ``parts``, which a mark of its own each keeps apart."""
    symbols, places, local = [], [], {}
    for k, (s, e) in enumerate(parts):
        symbols += [local.setdefault(c, len(local)) for c in codes[s:e]]
        places += range(s, e)
        symbols.append(-1 - k)
        places.append(e)
    symbols.pop()
    marks = len(parts)
    found = runs_of([s + marks for s in symbols], min_length, min_exponent)
    found[:, 0] = np.array(places, np.int64)[found[:, 0]]
    return found


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, n_words, runs, collapsed), one row for each row.

    Words are runs of characters other than ASCII blanks. A run is a longest stretch of words with smallest
    period q whose length is at least ``min_length`` and ``min_exponent`` * q; runs stand by start, then
    period. ``collapsed`` are the words, one blank between, without those that stand in a run after its first q words.

    Null, empty and blank texts have no words and no runs, and '' is left of them. Repeated rows and rows without doc_id
    stay; other columns are dropped whatever their names; an empty table gives no row. Documents are only mapped; a
    task holds one batch of texts, and trees for the repetitive stretches of one text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            words, ends = _words(batch.column("text"))
            codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            parts: dict[int, list[tuple[int, int]]] = {}
            for s, e in stretches(codes, own, min_length, min_exponent):
                parts.setdefault(int(own[s]), []).append((s, e))
            found, kept = [[] for _ in range(batch.num_rows)], np.ones(len(codes), bool)
            for d, pieces in parts.items():
                base = int(ends[d])
                text = codes[base : int(ends[d + 1])].tolist()
                runs = _text_runs(text, [(s - base, e - base) for s, e in pieces], min_length, min_exponent)
                found[d] = [{"start": s, "length": n, "period": p} for s, n, p in runs.tolist()]
                for s, n, p in runs.tolist():
                    kept[base + s + p : base + s + n] = False
            left = np.concatenate([[0], np.cumsum(kept)])[ends]
            flat = words.filter(pa.array(kept)).dictionary_decode().cast(pa.large_string())
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat), pa.scalar(" ", pa.large_string()))
            runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(found, runs_type), texts.cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, {KIND}")
