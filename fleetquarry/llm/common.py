"""What several of the operators share: stored tables, packed texts, ragged arrays, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquarry.session import shared_dir, shuffles_dropped


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the cluster's shared folder and read back: cuts the lineage,
    and a lost executor costs a re-read, not a recomputation."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name`` or, if a column has it, a longer one that none has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def all_columns(df: DataFrame) -> list[Column]:
    """Every column, names with dots and blanks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def packed(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings in one buffer, and len+1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def packed_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all binaries, none of them null, in one buffer, and len+1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` has about ``limit`` bytes at most.

    Only memory depends on it: a text is never cut, so a longer one is a batch of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if len(sizes) > start:
            yield batch.slice(start)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0]+1, ... (lengths[0] of them), starts[1], ..."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers), for well spread hash bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_worker = {"operator": "", "caches": ()}


def enter(operator: str, *caches) -> None:
    """Called where a task starts: a reused Python worker gives back what the operators before ``operator`` have left in it.

    Their ``caches`` are cleared, and memory that Arrow and the C library hold unused returns to the system; the caches of
    the operator itself stay from task to task.
    """
    if _worker["operator"] != operator:
        for cache in _worker["caches"]:
            cache.cache_clear()
        gc.collect()
        _worker.update(operator=operator, caches=caches)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a partition's edges: each node with the least node it reaches there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, r) for x in parent if (r := root(x)) != x]
    if pairs:
        a, b = zip(*pairs)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a long, b long)``; root is its component's least node.

    Each task first shrinks its own edges to a forest. Then large-star and small-star steps
    alternate until nothing changes, each written to the shared folder. A step is a grouped
    minimum and a join, so a node with many neighbours is never collected. Empty edges give
    no rows; self-loops and repeats do not matter.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = stored(edges.mapInArrow(_forest, "a long, b long"), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
