"""Encoding whole texts by their distinct blank-separated pieces.

Byte-level pre-tokenisers never join a character that is no white space to white space after
it. So a text may be cut before each blank, its pieces encoded alone, and the ids joined.
Pieces repeat a lot; each distinct one of a batch is encoded once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fleetquarry.llm.common import ragged

#: Entries after which a task sorts out its memory of pieces, and the longest piece it keeps.
REMEMBERED = 500_000
LONGEST = 100

#: From texts to all their ids in one array, and how many each has.
Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room for ``size`` entries and as many again."""
    return array if len(array) >= size else np.concatenate([array, np.zeros(2 * size - len(array), array.dtype)])


class PieceEncoder:
    """ids of whole texts; remembers the ids of pieces from batch to batch."""

    def __init__(self, encode: Encoder, remembered: int = REMEMBERED, whole: Sequence[str] = (), keep: bool = True):
        """Texts that hold a string of ``whole`` are not cut. Without ``keep`` nothing outlives a sorting out, which
        takes less memory and encodes more."""
        self._encode, self._remembered, self._whole, self._keep = encode, remembered, whole, keep
        self._slot, self._slots, self._used = {}, 0, 0
        self._flat, self._seen = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.uint8)
        self._starts, self._sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _forget(self) -> None:
        """Keeps the pieces that more than one batch had since the last time, or none if they are too many."""
        used = self._seen[: self._slots] > 1 if self._slots else np.zeros(0, bool)
        if not self._keep or 2 * used.sum() > self._remembered:
            used[:] = False
        place = np.cumsum(used) - 1
        self._slot = {p: int(place[s]) for p, s in self._slot.items() if used[s]}
        sizes = self._sizes[: len(used)][used]
        flat = self._flat[ragged(self._starts[: len(used)][used], sizes)]
        self._used, self._slots = len(flat), len(sizes)
        self._flat = _grown(flat, 1 << 16)
        self._starts = _grown(np.cumsum(sizes) - sizes, 1 << 14)
        self._sizes = _grown(sizes, 1 << 14)
        self._seen = np.zeros(len(self._sizes), np.uint8)

    def _slots_of(self, pieces: list[str]) -> np.ndarray:
        slot, at = self._slot, self._slots
        out = np.fromiter(map(slot.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(out < 0).tolist()
        if missing:
            new = list(dict.fromkeys([pieces[i] for i in missing]))
            ids, sizes = self._encode(new)
            total, n = len(ids), len(new)
            self._flat = _grown(self._flat, self._used + total)
            for name in ("_starts", "_sizes", "_seen"):
                setattr(self, name, _grown(getattr(self, name), at + n))
            self._flat[self._used : self._used + total] = ids
            self._starts[at : at + n] = self._used + np.cumsum(sizes) - sizes
            self._sizes[at : at + n] = sizes
            self._used, self._slots = self._used + total, at + n
            slot.update(zip(new, range(at, at + n)))
            out[missing] = [slot[pieces[i]] for i in missing]
            for p in new:
                if len(p) > LONGEST:
                    del slot[p]
        self._seen[out] = np.minimum(self._seen[out] + 1, 2)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and len+1 offsets of the texts in them. Null counts as empty."""
        if self._slots > self._remembered or self._used > 16 * self._remembered:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # between two blanks the cut would part a run of white space; such texts stay whole
        odd = pc.match_substring(texts, "  ").to_numpy(zero_copy_only=False)
        for part in self._whole:
            odd = odd | pc.match_substring(texts, part).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        values = lists.flatten()
        first = np.zeros(len(values), bool)
        first[firsts] = True
        slots = np.empty(len(values), np.int64)
        heads = values.take(pa.array(firsts)).to_pylist()
        for i in np.flatnonzero(odd):
            heads[i] = texts[i].as_py()
        slots[first] = self._slots_of(heads)
        rest = values.filter(pa.array(~first)).dictionary_encode()
        if len(rest):
            known = self._slots_of([" " + p for p in rest.dictionary.to_pylist()])
            slots[~first] = known[rest.indices.to_numpy()]
        sizes = self._sizes[slots]
        ids = self._flat[ragged(self._starts[slots], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.concatenate([firsts, [len(values)]])]
