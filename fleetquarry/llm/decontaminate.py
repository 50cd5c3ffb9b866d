"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact verification.

Every window of a document that is as long as a benchmark item gets a SimHash. Fingerprints are
cut into blocks; two within the radius are close in at least one block, so probing each
block's table within its share of the radius finds every item within the radius. Whatever is found is
verified by the similarity of the weighted shingles themselves.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.blobs import read_blob, write_blob
from fleetquarry.llm.common import all_columns, enter, mixed, packed, ragged, slices, unused
from fleetquarry.session import shared_dir

WORDS = 5
SIMILARITY = 0.8
#: Fingerprint bits, blocks and radius: at a similarity of 0.8 of numbered shingles about 39 of 256 bits differ, by 6.
LANES = 4
BITS = 64 * LANES
BLOCKS = 32
RADIUS = 63
#: Words of benchmark text in a block, and blocks that a task holds; more of them take further passes over the documents.
ITEM_WORDS = 500_000
BLOCKS_HELD = 4
#: Windows whose fingerprints are made at a time.
WINDOWS = 2048
BATCH_BYTES = 2 << 20

_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_BLOCK = BITS // BLOCKS
# all ways to change up to RADIUS // BLOCKS bits of a block
_FLIPS = np.array(
    [sum(1 << i for i in c) for n in range(RADIUS // BLOCKS + 1) for c in combinations(range(_BLOCK), n)], np.int64
)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the lower-cased texts, and len+1 offsets of the texts.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII.
    """
    buffer, offsets = packed(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    inside = np.zeros(len(buffer) + 2, bool)
    inside[1:-1] = _WORD[buffer]
    first = np.zeros(len(buffer) + 1, bool)
    first[offsets] = True  # a text starts: no word goes on from the one before
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * _powers(base, len(buffer)), out=sums[1:])
    # the sum over a word, moved to where it would stand at the text's start
    back = _powers(inverse, len(buffer))[starts] if len(starts) else starts.astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * back), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of WORDS consecutive words at each position; the last WORDS-1 have none."""
    n = len(hashes) - WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, WORDS):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + n]
    return mixed(out)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """For each shingle BITS signs, 1 or -1."""
    lanes = np.stack([mixed(hashes + np.uint64(0x632BE59BD9B4E019 * (i + 1) % (1 << 64))) for i in range(LANES)], axis=1)
    return np.unpackbits(lanes.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Each occurrence of a shingle as a value of its own, so that repeats weigh like different shingles."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    place = np.arange(len(hashes))
    nth = np.empty(len(hashes), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return np.where(nth == 0, hashes, mixed(hashes + nth * np.uint64(0x9E3779B97F4A7C15)))


def _print_of(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs > 0, axis=-1).view(np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted similarity: shared over joint occurrences of shingles, repeats counted."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(at[: len(a)], minlength=len(keys))
    right = np.bincount(at[len(a) :], minlength=len(keys))
    joint = np.maximum(left, right).sum()
    return float(np.minimum(left, right).sum() / joint) if joint else 0.0


def _within(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in ``known`` (sorted)."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


@dataclass
class Index:
    """Items by length in words; for each block a sorted list of (block value, item)."""

    ids: list[int]
    sets: list[np.ndarray]
    sizes: np.ndarray
    prints: np.ndarray
    known: np.ndarray = field(init=False)
    tables: dict[int, tuple[np.ndarray, np.ndarray]] = field(init=False)

    def __post_init__(self):
        self.known = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.known >> np.uint64(42)).astype(np.int64)] = True
        self.tables, self.by_size = {}, {}
        for size in np.unique(self.sizes):
            own = np.flatnonzero(self.sizes == size)
            self.by_size[int(size)] = np.unique(np.concatenate([self.sets[i] for i in own]))
            keys = _block_keys(self.prints[own]).ravel()
            order = np.argsort(keys, kind="stable")
            self.tables[int(size)] = keys[order], np.repeat(own, BLOCKS)[order]

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = self.filter[(hashes >> np.uint64(42)).astype(np.int64)]
        maybe = np.flatnonzero(out)
        out[maybe] = _within(self.known, hashes[maybe])
        return out

    def near(self, mark: np.ndarray, size: int) -> np.ndarray:
        """Items of ``size`` words whose fingerprint is within RADIUS of ``mark``."""
        keys, items = self.tables[size]
        probes = (_block_keys(mark[None]).ravel()[:, None] ^ _FLIPS).ravel()
        lo, hi = np.searchsorted(keys, probes), np.searchsorted(keys, probes, "right")
        hit = hi > lo
        found = np.unique(items[ragged(lo[hit], hi[hit] - lo[hit])])
        return found[np.bitwise_count(self.prints[found] ^ mark).sum(axis=1) <= RADIUS]


def _block_keys(prints: np.ndarray) -> np.ndarray:
    """Block values of fingerprints (rows), each with its block's number above the value."""
    values = np.ascontiguousarray(prints).view(np.uint8).astype(np.int64)
    return values + (np.arange(BLOCKS, dtype=np.int64) << _BLOCK)


def build_index(items: list[tuple[int, str | None]]) -> Index:
    """The items with at least WORDS words; shorter and null ones match nothing."""
    hashes, ends = words(pa.array([t for _, t in items], pa.string()))
    ids, sets, sizes, prints = [], [], [], []
    for (item, _), s, e in zip(items, ends[:-1], ends[1:]):
        own = shingles(hashes[s:e])
        if len(own):
            ids.append(item), sets.append(own), sizes.append(e - s)
            prints.append(_print_of(_bits(numbered(own)).sum(axis=0)))
    return Index(ids, sets, np.array(sizes, np.int64), np.array(prints, np.uint64).reshape(-1, LANES))


def _regions(hit: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Shingle ranges that hold every window of ``size`` words with a hit in it, clipped and joined."""
    at = np.flatnonzero(hit)
    reach = size - WORDS + 1
    lo, hi = np.maximum(at - reach + 1, 0), np.minimum(at + reach, len(hit))
    cut = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]])) if len(at) else at
    return [(int(lo[i]), int(hi[j - 1])) for i, j in zip(cut, [*cut[1:], len(at)])]


def _marked(own: np.ndarray, starts: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, fingerprint) of the windows of ``width`` shingles of ``own`` at ``starts`` (rising).

    Windows with the same shingles, as in texts that repeat a passage, are equally similar to any item: the first stands for
    them. Memory depends on WINDOWS and the width alone.
    """
    lo, hi = int(starts[0]), int(starts[-1]) + width
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(own[lo:hi]))])
    starts = np.sort(starts[np.unique(sums[starts - lo + width] - sums[starts - lo], return_index=True)[1]])
    # where each shingle stands next, and the first place at which any of those from a start on has stood before
    order = np.argsort(own[lo:hi], kind="stable")
    again = np.full(hi - lo, hi - lo, np.int64)
    same = own[lo:hi][order[1:]] == own[lo:hi][order[:-1]]
    again[order[:-1][same]] = order[1:][same]
    again = np.minimum.accumulate(again[::-1])[::-1]
    at = 0
    while at < len(starts):
        group = starts[at : at + WINDOWS]
        group = group[group < group[0] + WINDOWS]
        a, z = int(group[0]), int(group[-1]) + width
        signs = np.zeros((z - a + 1, BITS), np.int32)
        np.cumsum(_bits(own[a:z]), axis=0, out=signs[1:])
        marks = _print_of(signs[group - a + width] - signs[group - a])
        for start, mark in zip(group.tolist(), marks):
            if again[start - lo] < start - lo + width:
                mark = _print_of(_bits(numbered(own[start : start + width])).sum(axis=0))
            yield start, mark
        at += len(group)


def find(hashes: np.ndarray, index: Index, hit: np.ndarray) -> dict[int, tuple[float, int, int]]:
    """Items that a document (its word hashes) holds: item -> (similarity, first word, words).

    ``hit`` tells which of its shingles any item has. A window that reaches the similarity shares so
    many shingles with its item, so other windows are passed over without loss.
    """
    own, best = shingles(hashes), {}
    if not len(own):
        return {}
    at, hit = np.flatnonzero(hit), np.zeros(len(own), bool)
    for size in index.tables:
        hit[:] = False
        hit[at] = _within(index.by_size[size], own[at])  # what items of this length have
        if not hit.any():
            continue
        width = min(size, len(hashes)) - WORDS + 1  # a shorter document is one window
        # the windows of the least weight: SIMILARITY of the item's shingles are hits
        need = SIMILARITY * (size - WORDS + 1) - 1e-9
        for lo, hi in _regions(hit, size):
            if hit[lo:hi].sum() < need or hi - lo < width:
                continue
            sums = np.cumsum(np.concatenate([[0], hit[lo:hi]]))
            starts = np.flatnonzero(sums[width:] - sums[:-width] >= need)
            if not len(starts):
                continue
            for start, mark in _marked(own, starts + lo, width):
                for i in index.near(mark, size):
                    score = similarity(own[start : start + width], index.sets[i])
                    key = (score, -int(start))
                    if score >= SIMILARITY and key > best.get(index.ids[i], ((-1.0, 0), 0))[0]:
                        best[index.ids[i]] = key, width + WORDS - 1
    return {item: (score, -start, n) for item, ((score, start), n) in best.items()}


def _hits(texts: pa.Array, paths: list[str]) -> Iterator[tuple[int, dict[int, tuple[float, int, int]]]]:
    """(row, items found) for the rows of a batch that hold items of the blocks at ``paths``; a row may come again."""
    hashes, ends = words(texts)
    own = shingles(hashes)
    for path in paths:
        index = _index(path)
        hits = index.has(own)
        marked = np.searchsorted(np.flatnonzero(hits), ends)  # hits before each document
        for d in np.flatnonzero(np.diff(marked)):
            s, e = int(ends[d]), int(ends[d + 1])
            # shingles inside the document
            found = find(hashes[s:e], index, hits[s : max(s, e - WORDS + 1)])
            if found:
                yield int(d), found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): for each document and benchmark item that it
    holds, the most similar window, the first one on ties.

    ``docs(doc_id, text)``, ``benchmark(item_id, text)``. Null, empty and short texts (under five words)
    match nothing on either side; rows without an item_id are left out; a repeated item_id counts
    each of its texts; repeated documents repeat; without items there is no row. Documents are only mapped, never
    shuffled. The benchmark is indexed by tasks in blocks of a bounded number of words; BLOCKS_HELD blocks are
    looked up in one pass over the documents.
    """
    kind = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    out = None
    for paths in _index_files(benchmark):
        def run(batches: Iterator[pa.RecordBatch], paths: list[str] = paths) -> Iterator[pa.RecordBatch]:
            enter("decontaminate", _index)
            for batch in slices(batches, "text", BATCH_BYTES):
                rows: dict[tuple[int, int], tuple[float, int, int]] = {}
                for d, found in _hits(batch.column("text"), paths):
                    for item, v in found.items():
                        rows[d, item] = max(v, rows.get((d, item), v), key=lambda x: (x[0], -x[1]))
                if rows:
                    ids = batch.column("doc_id").take(pa.array([d for d, _ in rows])).to_pylist()
                    table = [(i, item, *v) for i, ((_, item), v) in zip(ids, rows.items())]
                    names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*table)], names)

        part = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], kind) if out is None else out


@lru_cache(BLOCKS_HELD)
def _index(path: str) -> Index:
    return pickle.loads(read_blob(path))


def _index_files(benchmark: DataFrame) -> list[list[str]]:
    """Files of indexes of about ITEM_WORDS words each, in groups for one pass; tasks write them to the shared folder.

    All texts of one item_id are in one block.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
    # words have about two characters at least
    size = items.agg(F.sum(F.char_length("text") / 2)).first()[0] or 0
    blocks = 1 + int(size) // ITEM_WORDS
    root = shared_dir(benchmark.sparkSession, "benchmark-index")

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        path = f"{root}/{key[0]}"
        held = sorted(zip(rows["item_id"].tolist(), rows["text"].tolist()), key=lambda r: (r[0], r[1] or ""))
        write_blob(path, [pickle.dumps(build_index(held))])
        return pd.DataFrame({"path": [path]})

    placed = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    paths = sorted(r["path"] for r in placed.groupBy("block").applyInPandas(build, "path string").collect())
    return [paths[k : k + BLOCKS_HELD] for k in range(0, len(paths), BLOCKS_HELD)]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.

    Each row is judged by its own text, so rows without doc_id and unlike texts under one doc_id are no exception. All
    columns pass through the map; nothing is shuffled.
    """
    columns, kind, name = all_columns(docs), docs.schema, unused(docs, "__text")
    for paths in _index_files(benchmark):
        def run(batches: Iterator[pa.RecordBatch], paths: list[str] = paths) -> Iterator[pa.RecordBatch]:
            enter("decontaminate", _index)
            for batch in slices(batches, name, BATCH_BYTES):
                kept = np.ones(batch.num_rows, bool)
                kept[[d for d, _ in _hits(batch.column(name), paths)]] = False
                rows = batch.filter(pa.array(kept))
                yield pa.RecordBatch.from_arrays(rows.columns[:-1], rows.schema.names[:-1])

        docs = docs.select(*columns, F.col("text").cast("string").alias(name)).mapInArrow(run, kind)
    return docs
