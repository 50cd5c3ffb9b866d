"""SimHash near-duplicates by covering locality-sensitive hashing.

Every pair of fingerprints within the radius agrees on all bits of at least one mask of a
small structured family (Pagh 2016), so looking for equal masked values finds every pair
without any chance of a miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import all_columns, components, enter, stored, unused

BITS = 64
RADIUS = 3
WORDS = 3
SEED = 42
#: Buckets of up to this many fingerprints are joined; larger ones are compared in blocks.
JOINED = 16
BLOCK = 2048

# byte -> its eight bits, one to each byte of a 64-bit lane
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number with those bits that are set in over half of ``hashes`` (uint64)."""
    n = len(hashes)
    if n == 0:
        return 0
    rows = _LANES[hashes.astype(">u8").view(np.uint8).reshape(n, 8)]
    # a lane holds counts up to 255
    sums = np.add.reduceat(rows, np.arange(0, n, 255), axis=0)
    counts = sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of the text's shingles; 0 without words (or for null)."""
    parts = (text or "").encode().lower().split()  # on bytes: A-Z and the six ASCII blanks only
    if not parts:
        return 0
    flat = b" ".join(parts)
    if len(parts) <= words:
        shingles = [flat]
    else:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1)[: 1 - words or None].tolist()
        shingles = [flat[s:e] for s, e in zip(starts, ends[words - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, seed) for s in shingles), np.uint64, len(shingles)))


def fingerprints(docs: DataFrame, words: int = WORDS, mark: Column | None = None) -> DataFrame:
    """(doc_id, fp long, mark long) for every row of ``docs(doc_id, text)``; ``mark`` passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("simhash")
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            columns = [batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "mark"])

    mark = F.lit(None) if mark is None else mark
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), mark.cast("long").alias("mark")).mapInArrow(
        run, "doc_id long, fp long, mark long"
    )


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2^(radius+1)-1 masks; for any set of up to ``radius`` bits one mask avoids them all.

    Bit i carries a vector of radius+1 binary digits; the mask of v has bit i where the two have
    an odd inner product. ``radius`` vectors cannot span the space, so some v is orthogonal to
    the vectors of all differing bits.
    """
    size = 1 << (radius + 1)
    vector = [1 + (i * 7) % (size - 1) for i in range(bits)]
    masks = []
    for v in range(1, size):
        masks.append(sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _linked(fps: np.ndarray, others: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside ``fps``, or between ``fps`` and ``others``."""
    nodes = fps if others is None else np.concatenate([fps, others])
    parent = np.arange(len(nodes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        rest = nodes[i + 1 :] if others is None else others
        near = np.flatnonzero(np.bitwise_count(rest ^ fps[i]) <= radius) + (i + 1 if others is None else len(fps))
        for j in near:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(int(nodes[i]), int(nodes[r])) for i in range(len(nodes)) if (r := root(i)) != i]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``prints(fp long)`` that connect every pair
    within ``radius``: all pairs of small buckets, a spanning forest for each block of large ones.

    A bucket without a size limit is cut into blocks of BLOCK fingerprints, and a task gets one
    pair of blocks, so no task holds more and no list of all pairs is made.
    """
    rows = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                    for t, m in enumerate(covering_masks(radius))
                )
            )
        ).alias("b"),
    ).select("fp", "b.t", "b.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(sizes, ["t", "key"]), "buckets")
    few = members.where(F.col("n") <= JOINED)
    pairs = (
        few.alias("x")
        .join(few.alias("y"), ["t", "key"])
        .where("x.fp < y.fp")
        .where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    many = (
        members.where(F.col("n") > JOINED)
        .withColumn("blocks", blocks)
        .withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "key", "fp", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        fps, own = block["fp"].to_numpy(), block["own"].to_numpy()
        lo, hi = int(block["lo"].iat[0]), int(block["hi"].iat[0])
        found = _linked(fps, None, radius) if lo == hi else _linked(fps[own == lo], fps[own == hi], radius)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    forests = many.groupBy("t", "key", "lo", "hi").applyInPandas(compare, "a long, b long")
    return pairs.unionByName(forests)


def _roots(distinct: DataFrame, radius: int) -> DataFrame:
    """``distinct(fp, ...)`` with the component of each fingerprint as ``root``."""
    found = components(links(distinct.select("fp"), radius))
    return distinct.join(found, distinct.fp == found.node, "left").select(
        *distinct.columns, F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): documents linked by fingerprints at ``radius`` or fewer differing
    bits, directly or through others; component_id is the smallest doc_id of the component.

    A text that is null, empty or blank has fingerprint 0, which is linked like any other. Fewer
    words than a shingle make one shingle. Repeated rows stay; a row without doc_id gets the
    component of its text. A component without any doc_id has none. Only distinct fingerprints
    are compared, so copies cost one row.
    """
    prints = stored(fingerprints(docs, words).drop("mark"), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = _roots(distinct, radius)
    ids = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # copies share one fingerprint; its rows are spread by the skew rule of the join
    return prints.join(roots.join(ids, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def keep_first(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near-duplicate rows of ``docs``: that of the smallest doc_id.

    Each row is judged by its own text, so unlike texts under one doc_id are in groups of their own and all
    stay. A row without doc_id stays only where its group has no doc_id at all. Between rows of one group and doc_id
    a hash of the whole row decides; equal rows count as one.
    """
    mark, id_name, mark_name = F.xxhash64(*all_columns(docs)), unused(docs, "__id"), unused(docs, "__mark")
    prints = stored(fingerprints(docs, words, mark), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    roots = _roots(stored(prints.groupBy("fp").agg(first), "distinct"), radius)
    kept = roots.groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.coalesce("first.doc_id", F.lit(0)).alias(id_name), F.col("first.mark").alias(mark_name))
    rows = docs.withColumns({id_name: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), mark_name: mark})
    names = [id_name, mark_name]
    return rows.join(kept, names, "left_semi").dropDuplicates(names).select(*all_columns(docs))
