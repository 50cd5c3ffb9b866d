"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Each vocabulary entry becomes a piece of printable characters, one for each byte, scored by its
negative rank; the normaliser is the identity. Sentencepiece then merges the best scored pair
first, leftmost on ties, as rank merging does. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetquarry.llm.common import enter, ragged, slices
from fleetquarry.llm.pieces import PieceEncoder

BATCH_BYTES = 2 << 20
#: Pieces that a task remembers; it shares its memory with the stages before it in a worker.
REMEMBERED = 100_000


@lru_cache(1)
def byte_letters() -> str:
    """256 printable characters, one for each byte: itself where printable, else from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in own else next(spare)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(entry) for entry, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def _field(number: int, kind: int, value: bytes) -> bytes:
    """One protocol buffer field; kind 0: value is a varint, 2: bytes with their length, 5: four bytes."""
    return _varint(number << 3 | kind) + (_varint(len(value)) if kind == 2 else b"") + value


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def sentencepiece_model(entries: list[bytes]) -> bytes:
    """The serialised model; piece 0 is the unknown piece, piece r+1 the entry of rank r."""
    # fixed values of the public sentencepiece schema: ModelProto.pieces 1, trainer_spec 2, normalizer_spec 3;
    # piece: text 1, score 2, type 3 (unknown 2); trainer: model_type 3 (bpe 2), vocab_size 4;
    # normalizer: name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5
    letters = byte_letters()
    out = [_field(1, 2, _field(1, 2, b"<unk>") + _field(2, 5, struct.pack("<f", 0)) + _field(3, 0, _varint(2)))]
    for rank, entry in enumerate(entries):
        text = "".join(letters[b] for b in entry).encode()
        out.append(_field(1, 2, _field(1, 2, text) + _field(2, 5, struct.pack("<f", -rank))))
    out.append(_field(2, 2, _field(3, 0, _varint(2)) + _field(4, 0, _varint(len(entries) + 1))))
    off = _varint(0)
    out.append(_field(3, 2, _field(1, 2, b"identity") + _field(3, 0, off) + _field(4, 0, off) + _field(5, 0, off)))
    return b"".join(out)


class Codec:
    """Encodes and decodes by the ranks of a file."""

    def __init__(self, path: str, pattern: str):
        entries = read_ranks(path)
        self._whole = {entry: rank for rank, entry in enumerate(entries)}
        self._pattern = regex.compile(pattern)
        self._letters = {b: c for b, c in enumerate(byte_letters())}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(entries))
        self._bytes = np.frombuffer(b"".join(entries), np.uint8)
        self._sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self._starts = np.cumsum(self._sizes) - self._sizes
        self.encode = PieceEncoder(self._pieces, REMEMBERED, keep=False)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of each text: its pre-tokens, whole entries first, the rest by sentencepiece."""
        whole, find = self._whole, self._pattern.findall
        tokens = [[t.encode() for t in find(text)] for text in texts]
        rest = list(dict.fromkeys(t for row in tokens for t in row if t not in whole))
        names = [t.decode("latin-1").translate(self._letters) for t in rest]
        merged = {t: [i - 1 for i in ids] for t, ids in zip(rest, self._model.encode(names, num_threads=1))}
        rows = [[i for t in row for i in (merged[t] if t in merged else (whole[t],))] for row in tokens]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter((i for row in rows for i in row), np.uint32, int(sizes.sum())), sizes

    def decode(self, ids: np.ndarray) -> bytes:
        return self._bytes[ragged(self._starts[ids], self._sizes[ids])].tobytes()


@lru_cache(2)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, ids, for every row of ``docs``.

    The ids of each whole text, digested as little-endian unsigned 32-bit numbers, and the bytes
    they decode to. Null and empty texts have no tokens. Rows repeat as given. ``path`` is
    read where tasks run: the vocabulary is part of the installation, as the library is.
    """
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("byte_bpe", _codec)
        codec = _codec(path, pattern)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids, ends = codec.encode(batch.column("text"))
            sha, plain = [], []
            for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
                sha.append(hashlib.sha256(ids[s:e].astype("<u4").tobytes()).hexdigest())
                plain.append(hashlib.sha256(codec.decode(ids[s:e])).hexdigest())
            columns = [batch.column("doc_id"), pa.array(np.diff(ends)), pa.array(sha), pa.array(plain)]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in kind.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)
