"""Nearest neighbours by inner product: multi-index hashing of learned rotated binary codes.

Vectors get one more component that makes their lengths equal, so the largest inner product is the
smallest angle. Codes are the signs under several rotations learned on a bounded sample (iterative
quantisation, Gong and Lazebnik 2011). Codes are cut into 16-bit substrings, each with its own
index (Norouzi et al. 2012): a code within the radius is within radius // SUBSTRINGS in some
substring, so probing those retrieves every such code. They are reranked by the vectors
themselves in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import stored

BITS = 256
SUBSTRINGS = BITS // 16
#: Rows the rotations and the radius are learned on, and the share of true neighbours in the sample
#: that must lie within the radius. In more rows neighbours are nearer, so the share grows.
SAMPLE_ROWS = 4096
REACHED = 0.97
ITERATIONS = 20
#: Rows of one index block, and queries of one query block.
INDEX_ROWS = 32_768
QUERY_ROWS = 8_192


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components given and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Codes:
    """rotation: columns give the bits; longest: the greatest vector length; radius: Hamming distance."""

    rotation: np.ndarray
    longest: float
    radius: int

    def of(self, rows: np.ndarray, query: bool) -> np.ndarray:
        """Codes (rows of 16-bit substrings) of vectors, as queries or as indexed rows."""
        return _signs(_level(rows, self.longest, query) @ self.rotation)


def _signs(projected: np.ndarray) -> np.ndarray:
    return np.packbits(projected > 0, axis=1).view(np.uint16)


def _level(rows: np.ndarray, longest: float, query: bool) -> np.ndarray:
    sizes = np.linalg.norm(rows, axis=1)
    if query:
        return np.hstack([rows / sizes[:, None], np.zeros((len(rows), 1))])
    rest = np.sqrt(np.maximum(0, 1 - (sizes / longest) ** 2))
    return np.hstack([rows / longest, rest[:, None]])


def _distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(codes).view(np.uint64) ^ np.ascontiguousarray(code).view(np.uint64)).sum(axis=1)


def learn(sample: np.ndarray, longest: float, k: int, seed: int = 5) -> Codes:
    """Rotations that bring the sample close to the corners of a cube, and the radius that reaches
    the share REACHED of the k nearest of sampled queries."""
    rng = np.random.default_rng(seed)
    level = _level(sample, longest, False)
    _, _, axes = np.linalg.svd(level, full_matrices=False)
    axes = axes[:BITS].T
    reduced, columns = level @ axes, []
    while sum(c.shape[1] for c in columns) < BITS:
        turn = np.linalg.qr(rng.normal(size=(reduced.shape[1],) * 2))[0]
        for _ in range(ITERATIONS):
            u, _, v = np.linalg.svd(np.where(reduced @ turn > 0, 1.0, -1.0).T @ reduced)
            turn = (u @ v).T
        columns.append(axes @ turn)
    rotation = np.hstack(columns)[:, :BITS]
    codes, asked = _signs(level @ rotation), _signs(_level(sample, longest, True) @ rotation)
    distances = []
    for q in rng.permutation(len(sample))[:200]:
        score = sample @ sample[q]
        score[q] = -np.inf
        near = np.argsort(-score)[: min(k, len(sample) - 1)]
        distances.append(_distance(codes[near], asked[q]))
    reached = np.concatenate(distances) if distances else np.zeros(0)
    return Codes(rotation, longest, int(np.ceil(np.quantile(reached, REACHED))) if len(reached) else BITS)


class Block:
    """Substring indexes of a block of codes: each distinct value with its rows."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for part in range(SUBSTRINGS):
            order = np.argsort(codes[:, part], kind="stable")
            values, starts = np.unique(codes[order, part], return_index=True)
            self.tables.append((values, np.append(starts, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius``."""
        seen = np.zeros(len(self.codes), bool)
        for part, (values, starts, order) in enumerate(self.tables):
            # probes outnumber the values of a block, so the values are tested instead
            close = np.bitwise_count(values ^ code[part]) <= radius // SUBSTRINGS
            seen[order[np.repeat(close, np.diff(starts))]] = True
        rows = np.flatnonzero(seen)
        return rows[_distance(self.codes[rows], code) <= radius]


def search(codes: Codes, k: int, ids: np.ndarray, rows: np.ndarray, asked: np.ndarray, queries: np.ndarray) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, score): the k best of one block for each query. The radius grows where
    fewer than k rows are within it."""
    block, marks, out = Block(codes.of(rows, False)), codes.of(queries, True), []
    for query_id, query, mark in zip(asked, queries, marks):
        radius, others = codes.radius, int((ids != query_id).sum())
        while True:
            found = block.within(mark, radius)
            found = found[ids[found] != query_id]
            if len(found) >= min(k, others) or radius >= BITS:
                break
            radius = min(BITS, radius + SUBSTRINGS)
        score = (rows[found] * query).sum(axis=1)  # row by row: equal vectors score equally
        best = np.lexsort((ids[found], -score))[:k]
        out += zip([query_id] * len(best), ids[found[best]], score[best])
    return out


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors(vec_id, embedding)`` whose vec_id is divisible
    by ``every``, its k nearest other rows by inner product, ties to the smaller vec_id.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without
    a vec_id and vectors of another than the most common length. Rows that share a vec_id are no
    candidates of each other; each is a candidate of the rest, and a repeated query counts once. Index and
    queries are dealt in blocks by a hash; a task gets one block of each, never more.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("m"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    kind = "query_id long, vec_id long, score double"
    if top is None:
        found = vectors.sparkSession.createDataFrame([], kind)
        return found.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    rows = stored(rows.where(F.size("v") == top["d"]), "vectors")
    share = min(1.0, SAMPLE_ROWS / top["n"])
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < max(share, 1e-9) * (1 << 30))
    sample = drawn.orderBy("vec_id", "v").toPandas()
    if not len(sample):
        sample = rows.orderBy("vec_id").limit(1).toPandas()
    codes = learn(np.stack(sample["v"]), float(top["m"]), k)
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    index_blocks, query_blocks = -(-top["n"] // INDEX_ROWS), max(1, -(-queries.count() // QUERY_ROWS))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    repeat = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    indexed = rows.select("vec_id", "v", deal(index_blocks).alias("i")).withColumn("q", repeat(query_blocks))
    asked = queries.select("vec_id", "v", deal(query_blocks).alias("q")).withColumn("i", repeat(index_blocks))

    def compare(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = search(codes, k, block["vec_id"].to_numpy(), np.stack(block["v"]), queries["vec_id"].to_numpy(), np.stack(queries["v"]))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = indexed.groupBy("i", "q").cogroup(asked.groupBy("i", "q")).applyInPandas(compare, kind)
    # the best k of all blocks: k rows a block for each query
    best = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k).alias("b")
    )
    ranked = best.select("query_id", F.posexplode("b").alias("p", "b"))
    return ranked.select("query_id", (F.col("p") + 1).alias("rank"), "b.vec_id", "b.score")
