"""Exact duplicate passages by sharded suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id.
Sorting all suffixes of a corpus at one place is out of reach, so suffixes are dealt to shards:

1. Each window of LENGTH bytes has a seed, its K-gram of the least hash. Equal windows have equal
   seeds. Neighbouring windows with one seed form a fragment, named by a hash of its bytes.
2. Fragments meet by seed, packed into buckets of seeds. Equal fragments of different documents settle all
   their windows. Seeds with only one fragment, or one document, are done.
3. The other fragments, mostly the rims of repeated passages, go to shards by seed. A shard builds the
   suffix array of its fragments by induced sorting and finds windows that
   are equal by their common prefixes.
4. Settled windows come back to their documents as byte runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import mixed, packed, packed_bytes, ragged, slices, stored
from fleetquarry.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 50
K = 20
WIDTH = LENGTH - K + 1
BATCH_BYTES = 4 << 20
#: Bytes of one suffix array, and fragments of one seed above which its windows are dealt one by one.
SHARD_BYTES = 2 << 20
FRAGMENTS = 8192
#: Bytes of text whose fragments fill one bucket of seeds; the most buckets; rows of a bucket that are held before they are thinned out;
#: rows packed into one binary, and bytes of these in one batch.
BUCKET_BYTES, BUCKETS, HELD = 2 << 20, 1 << 16, 1 << 20
PIECE, PIECES_BYTES = 1 << 15, 64 << 20

#: where = settled (1 bit, in packed rows alone), text mark (20), start of the first window (36), windows less one (6)
_SETTLED, _MARK, _START = 62, 42, 6
MARK, ASK, BIG = 0, 1, 2


def _hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash and the inverse powers: of [s, e) it is (sums[e]-sums[s])*inverse[s]."""
    base = 0x9E3779B97F4A7C15
    power, back = np.full(len(buffer), base, np.uint64), np.full(len(buffer) + 1, pow(base, -1, 1 << 64), np.uint64)
    power[:1], back[0] = 1, 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    letters = mixed(np.arange(1, 257, dtype=np.uint64))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(letters[buffer] * power, out=sums[1:])
    return sums, back


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def fragments(buffer: np.ndarray, offsets: np.ndarray, hashes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, seed, fragment) of all fragments, in text order; windows count
    from the document's start."""
    none = np.zeros(0, np.int64)
    if len(buffer) < LENGTH:
        return none, none, none, none, none
    sums, back = hashes
    n = len(buffer) - LENGTH + 1
    grams = mixed((sums[K:] - sums[:-K]) * back[: len(sums) - K])
    # the upper half orders, the place below it breaks ties and tells the seed's position
    ranked = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    seed_at = (_least(ranked, WIDTH)[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = document[:n] == document[LENGTH - 1 :]
    new = np.ones(n, bool)
    new[1:] = (seed_at[1:] != seed_at[:-1]) | (document[1:n] != document[: n - 1])
    first = np.flatnonzero(new & inside)
    edges = np.flatnonzero(np.concatenate([new | ~inside, [True]]))
    windows = edges[np.searchsorted(edges, first, "right")] - first
    ends = first + windows + LENGTH - 1
    named = mixed((sums[ends] - sums[first]) * back[first] + windows.astype(np.uint64))
    own = document[first]
    return own, first - offsets[own], windows, grams[seed_at[first]].view(np.int64), named.view(np.int64)


def _marks(offsets: np.ndarray, hashes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """20 bits of each text, to tell texts under one doc_id apart."""
    sums, back = hashes
    return (mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]]) >> np.uint64(44)).astype(np.int64)


_ROWS = ["kind", "seed", "fragment", "doc_id", "at"]
_KIND = "kind int, seed long, fragment long, doc_id long, at long"


def _rows(kind: int | np.ndarray, seed, fragment, doc_id, at) -> pa.RecordBatch:
    kinds = np.broadcast_to(np.int32(kind), len(at)) if np.isscalar(kind) else kind
    columns = [np.ascontiguousarray(kinds, np.int32), seed, fragment, doc_id, at]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _ROWS)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def _cut(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Step 1. Of equal fragments in a batch only the one of the smallest doc_id goes on; the others are
    settled here. So a copied passage sends one row a batch, not one a copy."""
    for batch in slices(batches, "text", BATCH_BYTES):
        buffer, offsets = packed(batch.column("text"))
        hashes = _hashes(buffer)
        own, start, windows, seed, fragment = fragments(buffer, offsets, hashes)
        if not len(own):
            continue
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[own]
        at = _marks(offsets, hashes)[own] << _MARK | start << _START | windows - 1
        # a fragment's bytes settle its seed
        order = np.argsort(fragment)
        seed, fragment, ids, at = seed[order], fragment[order], ids[order], at[order]
        first = _firsts(seed, fragment)
        least = np.minimum.reduceat(ids, np.flatnonzero(first))[np.cumsum(first) - 1]
        # copies inside the least document stay: an equal fragment may be in a smaller document yet
        settled = ids > least
        # settled rows pass through the exchange anywhere; a seed's upper half is low, it was the least of its neighbours
        spread = np.where(settled, mixed(at.view(np.uint64)).view(np.int64), seed)
        bucket = (spread & (buckets - 1)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        rows = np.empty((len(order), 4), np.int64)
        for i, column in enumerate((seed, fragment, ids, at | settled.astype(np.int64) << _SETTLED)):
            rows[:, i] = column[order]
        yield from _pieces(bucket[order], rows)


def _pieces(bucket: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``rows`` packed bucket by bucket, in binaries of up to PIECE rows."""
    edges = np.append(np.flatnonzero(_firsts(bucket)), len(bucket))
    starts = np.concatenate([np.arange(s, e, PIECE) for s, e in zip(edges, edges[1:])])
    ends = np.append(starts[1:], len(bucket))
    width = rows.itemsize * rows.shape[1]
    step = max(1, PIECES_BYTES // (width * PIECE)) if len(rows) * width > PIECES_BYTES else len(starts)
    for i in range(0, len(starts), step):
        s, e = starts[i : i + step], ends[i : i + step]
        where = (np.append(s, e[-1]) - s[0]) * width
        data = pa.py_buffer(np.ascontiguousarray(rows[s[0] : e[-1]]))
        packed_rows = pa.BinaryArray.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(where.astype(np.int32)), data])
        yield pa.RecordBatch.from_arrays([pa.array(bucket[s].astype(np.int32)), packed_rows], ["bucket", "rows"])


def _judge(rows: np.ndarray, most: int, big: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind of each row and whether it goes on. Of equal fragments all but those of the least document are settled; seeds with
    several fragments in several documents are open, and those of more than ``most`` open rows, or in ``big``, are dealt one by one."""
    seed, fragment, ids = rows[:, 0], rows[:, 1], rows[:, 2]
    order = np.argsort(fragment)
    s, i = seed[order], ids[order]
    new = _firsts(s, fragment[order])
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    least, greatest = np.minimum.reduceat(i, starts), np.maximum.reduceat(i, starts)
    left = i == least[group]
    # the groups of equal fragments, by seed
    of_seed = np.argsort(s[starts])
    new = _firsts(s[starts][of_seed])
    firsts, seeds = np.flatnonzero(new), np.cumsum(new) - 1
    several = np.diff(np.append(firsts, len(of_seed))) > 1
    several &= np.minimum.reduceat(least[of_seed], firsts) != np.maximum.reduceat(greatest[of_seed], firsts)
    count = np.add.reduceat(np.add.reduceat(left.astype(np.int64), starts)[of_seed], firsts)
    known = np.isin(s[starts][of_seed][firsts], big)
    kind_of_seed = np.where(known | (several & (count > most)), BIG, ASK)
    kind_of_group, open_group = np.empty(len(starts), np.int32), np.empty(len(starts), bool)
    kind_of_group[of_seed], open_group[of_seed] = kind_of_seed[seeds], (several | known)[seeds]
    kind, goes_on = np.empty(len(rows), np.int32), np.empty(len(rows), bool)
    kind[order] = np.where(left, kind_of_group[group], MARK)
    goes_on[order] = ~left | open_group[group]
    return kind, goes_on


def _settle(batches: Iterator[pa.RecordBatch], most: int, held_rows: int) -> Iterator[pa.RecordBatch]:
    """Step 2, over packed rows sorted by bucket.

    A bucket is held and judged at its end. Before it grows over ``held_rows`` it is thinned out: rows that a smaller document
    settles go, and so do those of seeds with more than ``most`` open rows, whatever is still to come for them.
    """
    held: list[np.ndarray] = []
    size, bound, now, big = 0, held_rows, None, np.zeros(0, np.int64)

    def out(rows: np.ndarray, kind: int | np.ndarray) -> pa.RecordBatch:
        # of settled rows only their place is read again
        names = [np.where(kind == MARK, 0, rows[:, i]) for i in range(2)]
        return _rows(kind, *names, *(np.ascontiguousarray(rows[:, i]) for i in range(2, 4)))

    def whole() -> pa.RecordBatch:
        rows = np.concatenate(held)
        kind, goes_on = _judge(rows, most, big)
        return out(rows[goes_on], kind[goes_on])

    for batch in batches:
        if not batch.num_rows:
            continue
        buckets = batch.column("bucket").to_numpy()
        data, offsets = packed_bytes(batch.column("rows"))
        table, ends = data.view(np.int64).reshape(-1, 4), offsets // 32
        edges = np.append(np.flatnonzero(_firsts(buckets)), len(buckets))
        for a, b in zip(edges, edges[1:]):
            if buckets[a] != now:
                if held:
                    yield whole()
                held, size, bound, now, big = [], 0, held_rows, buckets[a], big[:0]
            for s in range(ends[a], ends[b], held_rows):
                rows = table[s : min(s + held_rows, ends[b])]
                settled = rows[:, 3] >> _SETTLED > 0
                if settled.any():
                    done = rows[settled]
                    done[:, 3] &= (1 << _SETTLED) - 1
                    yield out(done, MARK)
                    rows = rows[~settled]
                if not len(rows):
                    continue
                held.append(rows)
                size += len(rows)
                if size > bound:
                    rows = np.concatenate(held)
                    kind, _ = _judge(rows, most, big)
                    gone = kind != ASK
                    yield out(rows[gone], kind[gone])
                    big = np.union1d(big, rows[kind == BIG, 0])
                    rest = rows[~gone]
                    held, size = [rest] if len(rest) else [], len(rest)
                    bound = max(held_rows, 2 * size)
    if held:
        yield whole()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of asked fragments, cut from their documents."""
    names = ["kind", "seed", "fragment", "doc_id", "at", "bytes"]
    for batch in slices(batches, "text", BATCH_BYTES):
        buffer, offsets = packed(batch.column("text"))
        lists = batch.column("asked")
        counts = pc.list_value_length(lists).to_numpy()
        asked = lists.flatten()
        at = asked.field("at").to_numpy()
        own = np.repeat(np.arange(len(counts)), counts)
        # under one doc_id there may be several texts; a fragment is of the one that it was cut from
        right = (at >> _MARK & 0xFFFFF) == _marks(offsets, _hashes(buffer))[own]
        start = offsets[own] + (at >> _START & (1 << 36) - 1)
        size = (at & 63) + LENGTH
        start, size = start[right], size[right]
        data = buffer[ragged(start, size)]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        fields = [asked.field(n).filter(pa.array(right)) for n in ("kind", "seed", "fragment")]
        cut = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        ids = batch.column("doc_id").take(pa.array(own[right]))
        yield pa.RecordBatch.from_arrays([*fields, ids, pa.array(at[right]), cut], names)


def repeated_windows(data: np.ndarray, sizes: np.ndarray, windows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows) of the runs, in text order, of windows that also start in a text with a smaller id.

    ``data`` holds the texts one after the other; of each the first ``windows`` windows are judged.
    """
    own = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.zeros(len(data) + len(sizes), np.int16)  # a 0 ends a text; no window reaches over it
    whole[np.arange(len(data)) + own] = data.astype(np.int16) + 1
    starts = np.cumsum(sizes + 1) - sizes - 1
    suffixes = suffix_array(whole, 257)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)[suffixes]
    # equal windows stand together in the array, and so they do among the windows alone
    judged = suffixes - starts[owner] < windows[owner]
    suffixes, owner = suffixes[judged], owner[judged]
    begins = np.flatnonzero(np.concatenate([[True], common_prefixes(whole, suffixes, LENGTH) < LENGTH]))
    own_ids = ids[owner]
    least = np.repeat(np.minimum.reduceat(own_ids, begins), np.diff(np.append(begins, len(suffixes))))
    flags = np.zeros(len(whole) + 2, np.int8)
    flags[suffixes + 1] = own_ids > least
    # the place of a 0 is no window, so that no run goes from one text to the next
    edges = np.flatnonzero(np.diff(flags))
    first, end = edges[::2], edges[1::2]
    text = np.searchsorted(starts, first, "right") - 1
    return text, first - starts[text], end - first


def _shard(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Step 3, over rows sorted by seed: suffix arrays of about ``shard_bytes``, seeds kept whole."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, at = (table.column(n).to_numpy() for n in ("doc_id", "at"))
        data, offsets = packed_bytes(table.column("bytes"))
        text, first, windows = repeated_windows(data, np.diff(offsets), (at & 63) + 1, ids)
        at = (at[text] >> _START) + first << _START | windows - 1
        return pa.RecordBatch.from_arrays([pa.array(ids[text]), pa.array(at)], ["doc_id", "at"])

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        seed = batch.column("seed").to_numpy()
        bytes_to = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())])
        edges = np.flatnonzero(_firsts(seed))
        if held and seed[0] == last:
            edges = edges[1:]
        start, last = 0, seed[-1]
        while True:
            # the first seed that begins once there are bytes enough
            enough = max(start, int(np.searchsorted(bytes_to, bytes_to[start] + shard_bytes - size)))
            at = int(np.searchsorted(edges, enough))
            if at == len(edges):
                break
            held.append(batch.slice(start, edges[at] - start))
            yield solve(held)
            held, size, start = [], 0, int(edges[at])
        held.append(batch.slice(start))
        size += int(bytes_to[-1] - bytes_to[start])
    if held:
        yield solve(held)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: each document with the bytes of its settled windows removed."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in slices(batches, "text", BATCH_BYTES):
        buffer, offsets = packed(batch.column("text"))
        lists = batch.column("found")
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        own = np.repeat(np.arange(len(counts)), counts)
        right = (at >> _MARK & 0xFFFFF) == _marks(offsets, _hashes(buffer))[own]
        at, own = at[right], own[right]
        start = offsets[own] + (at >> _START & (1 << 36) - 1)
        covered = np.zeros(len(buffer) + 1, np.int32)
        np.add.at(covered, start, 1)
        np.subtract.at(covered, start + (at & 63) + LENGTH, 1)
        gone = np.cumsum(covered[:-1]) > 0
        sums = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = gone[offsets[:-1][np.diff(offsets) > 0]]
        spans = np.concatenate([[0], np.cumsum(begins)])
        kept = [hashlib.sha256(buffer[s:e][~gone[s:e]].tobytes()).hexdigest() for s, e in zip(offsets[:-1], offsets[1:])]
        columns = [batch.column("doc_id"), np.diff(offsets), sums[offsets[1:]] - sums[offsets[:-1]], spans[offsets[1:]] - spans[offsets[:-1]], kept]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, most: int = FRAGMENTS, held: int = HELD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs(doc_id, text)``.

    Bytes are the UTF-8 of the whole text (null: none). A text under LENGTH bytes keeps all. Rows with the same
    doc_id take nothing from each other; rows without doc_id are neither changed nor compared.
    Strings are judged on the input, and spans are maximal removed runs. ``shard_bytes``, ``most`` and ``held`` bound memory and do not change
    the result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = rows.where("doc_id is not null and length(text) > 0")
    # as many buckets as the text asks for, so that one fits a task whatever the size of the table
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(BUCKETS, max(64, 1 << (size // BUCKET_BYTES).bit_length()))
    met = known.mapInArrow(partial(_cut, buckets=buckets), "bucket int, rows binary").repartition("bucket").sortWithinPartitions("bucket")
    found = stored(met.mapInArrow(partial(_settle, most=most, held_rows=held), _KIND), "settled")
    open_rows = found.where(F.col("kind") != MARK)
    asked = open_rows.groupBy("doc_id").agg(F.collect_list(F.struct("kind", "seed", "fragment", "at")).alias("asked"))
    # a document's fragments are bounded by its text; a repeated row only repeats its own
    cut_kind = _KIND + ", bytes binary"
    texts = stored(known.join(asked, "doc_id").mapInArrow(_texts, cut_kind), "fragments")
    sharded = texts.where(F.col("kind") == ASK).repartition("seed").sortWithinPartitions("seed")
    shards = sharded.mapInArrow(partial(_shard, shard_bytes=shard_bytes), "doc_id long, at long")
    marks = found.where(F.col("kind") == MARK).select("doc_id", "at").unionByName(shards).unionByName(_one_by_one(texts))
    spans = marks.groupBy("doc_id").agg(F.collect_set("at").alias("found"))
    return rows.join(spans, "doc_id", "left").mapInArrow(
        _runs, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _one_by_one(texts: DataFrame) -> DataFrame:
    """Windows of seeds with more than FRAGMENTS fragments: each is compared by its bytes' digest, so
    a frequent seed spreads over as many keys as it has different windows."""
    windows = texts.where(F.col("kind") == BIG).select(
        "doc_id", "at", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("at").bitwiseAND(F.lit(63)))).alias("i")
    )
    window = F.substring(F.col("bytes"), F.col("i").cast("int") + 1, F.lit(LENGTH))
    windows = windows.select(
        "doc_id", F.md5(window).alias("window"),
        F.shiftleft(F.shiftright("at", _START) + F.col("i"), _START).alias("at"),
    )
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    return windows.join(least, "window").where("doc_id > least").select("doc_id", "at")
