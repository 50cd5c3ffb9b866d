"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

A file holds up to SEGMENT ids of whole documents in doc_id order and describes itself:

    magic, n_docs, n_ids, n_ranked  |  ids by falling frequency (u32)  |  doc_ids (i64), doc_id known (u8)
    ids in each document (u64)  |  control bytes: two bits an id, its bytes less one  |  data bytes

The id written is the rank of a token in its file, so frequent tokens take one byte. Control bytes
stand apart from the data; a table of 256 rows turns each into four lengths, and the data is
gathered in a few numpy steps without a loop over ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetquarry.llm.blobs import read_blob, write_blob
from fleetquarry.llm.common import ragged, slices, stored
from fleetquarry.llm.pieces import PieceEncoder
from fleetquarry.session import shared_dir

MAGIC = b"FRVB0001"
SEGMENT = 4_000_000
BATCH_BYTES = 4 << 20
#: Pieces encoded as one text.
JOINED = 500

# bytes of each of the four values of a control byte
_SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(ids: np.ndarray, sizes: np.ndarray, doc_ids: list[int | None]) -> list[bytes]:
    """The parts of one file; ``sizes`` are the ids in each document."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    ranked = np.lexsort((np.arange(len(counts)), -counts))[: np.count_nonzero(counts)].astype(np.uint32)
    rank = np.zeros(len(counts), np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    values = np.zeros(-(-len(ids) // 4) * 4, "<u4")
    values[: len(ids)] = rank[ids]
    width = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = ((width - 1).reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < width[:, None]]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return [
        MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(ranked)),
        ranked.astype("<u4").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        known.tobytes(),
        sizes.astype("<u8").tobytes(),
        control.tobytes(),
        data.tobytes(),
    ]


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[int | None]]:
    """ids, ids in each document and doc_ids of one file."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, n_ranked = struct.unpack_from("<QQQ", blob, 8)
    at = 32

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(blob, kind, count, at)
        at += out.nbytes
        return out

    ranked, doc_ids, known = take("<u4", n_ranked), take("<i8", docs), take("u1", docs)
    sizes, control = take("<u8", docs).astype(np.int64), take("u1", -(-n // 4))
    data = np.concatenate([take("u1", len(blob) - at), np.zeros(4, np.uint8)])
    width = _SIZES[control].ravel()
    starts = np.cumsum(width) - width
    values = np.zeros(len(width), np.uint32)
    for byte in range(4):
        has = width > byte
        values[has] |= data[starts[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranked[values[:n]], sizes, [int(d) if k else None for d, k in zip(doc_ids, known)]


@lru_cache(2)
def _encoder(path: str) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    begins = np.zeros(tokenizer.get_vocab_size(), bool)  # tokens that begin with a blank
    for token, i in tokenizer.get_vocab().items():
        begins[i] = token.startswith("\u0120")

    # a blank, and something without blanks that neither begins nor ends with white space
    is_word = re.compile(r" \S(?:[^ ]*\S)?").fullmatch

    def plain(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        starts, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        flat, held = [np.zeros(0, np.uint32)], 0
        words, rest = [], []
        for i, text in enumerate(texts):
            (words if is_word(text) else rest).append(i)
        # a blank and a word each: encoded many at a time, and the ids parted where a token begins with a blank
        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        lines = ["".join([texts[i] for i in group]) for group in groups]
        for group, line, ids in zip(groups, lines, plain(lines)):
            first = np.flatnonzero(begins[ids])
            if len(first) != len(group) or any(s in line for s in special):
                rest += group
                continue
            starts[group], sizes[group] = held + first, np.diff(first, append=len(ids))
            flat.append(ids)
            held += len(ids)
        for i, ids in zip(rest, plain([texts[i] for i in rest])):
            starts[i], sizes[i] = held, len(ids)
            flat.append(ids)
            held += len(ids)
        return np.concatenate(flat)[ragged(starts, sizes)], sizes

    return PieceEncoder(encode, whole=special)


def write_token_files(docs: DataFrame, root: str, path: str, end_id: int) -> DataFrame:
    """Writes ``docs(doc_id, text)`` as token files under ``root``; returns the manifest
    (part, segment, file, n_ids), files in doc_id order (part, then segment; null ids first).

    Range partitioning and a sort within partitions give the order; equal ids keep their texts' order.
    Each document ends with ``end_id``. A file's name depends on its place alone, so a retry
    writes the same file again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, segment = _encoder(path), TaskContext.get().partitionId(), 0
        ids, sizes, doc_ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, held
            name = f"{root}/part-{part:06d}-{segment:06d}.ids"
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            write_blob(name, pack(flat, np.concatenate(sizes), doc_ids))
            row = [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([name]), pa.array([len(flat)])]
            ids.clear(), sizes.clear(), doc_ids.clear()
            segment, held = segment + 1, 0
            return pa.RecordBatch.from_arrays(row, ["part", "segment", "file", "n_ids"])

        for batch in slices(batches, "text", BATCH_BYTES):
            own, ends = encode(batch.column("text"))
            own = np.insert(own, ends[1:], end_id)
            ids.append(own)
            sizes.append(np.diff(ends) + 1)
            doc_ids.extend(batch.column("doc_id").to_pylist())
            held += len(own)
            if held >= SEGMENT:
                yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part int, segment int, file string, n_ids long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``manifest``.

    start counts the ids of all documents before it. The offsets of files come from two running
    sums: over the parts (as many as tasks wrote), and over the segments of each.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("own"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.join(parts, "part").select(
        "file", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, sizes, doc_ids = unpack(read_blob(name))
                ends = np.cumsum(sizes)
                starts = ends - sizes
                flat = ids.astype("<u4")
                sums = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts + base), pa.array(sizes), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = files.repartition(max(1, manifest.count()))  # a file a task; a fixed number is not coalesced
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Writes token files to the shared folder and reads them back (see the two functions).

    Null and empty texts hold the end id alone; an empty table writes no file and gives no row.
    """
    root = shared_dir(docs.sparkSession, "token-files")
    return read_token_files(stored(write_token_files(docs, root, path, end_id), "manifest"))
