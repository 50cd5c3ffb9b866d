"""Suffix arrays of byte strings by induced sorting, in numpy.

The steps are those of Nong, Zhang and Chan (2009): classify suffixes, sort the leftmost-smaller
(LMS) substrings by one induction, name them, sort the reduced string, induce the whole array. An
induction goes over the buckets of first symbols; all suffixes that a bucket holds are handled
at once, in waves, where a loop over single suffixes would be too slow here.
"""

from __future__ import annotations

import numpy as np

#: A reduced string is sorted by induction again while it has this many suffixes for each symbol.
DENSE = 64


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the last one is not (L)."""
    n = len(text)
    step = np.ones(n, np.int8)
    step[:-1] = np.sign(text[:-1].astype(np.int64) - text[1:])
    # equal symbols take the type of the next unequal pair
    at = np.where(step != 0, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] < 0


def _spread(waiting: list[list[np.ndarray]], rows: np.ndarray, symbols: np.ndarray) -> None:
    """Appends ``rows`` to the lists of their symbols, in their order."""
    order = np.argsort(symbols, kind="stable")
    rows, symbols = rows[order], symbols[order]
    cuts = np.flatnonzero(np.diff(symbols)) + 1
    for own, part in zip(symbols[np.concatenate([[0], cuts])], np.split(rows, cuts)):
        waiting[own].append(part)


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array that follows from the order ``lms`` of the LMS suffixes.

    First the L suffixes, buckets upwards: each comes before its own symbol's S suffixes, in
    the order in which the suffixes after them stand. Then the S suffixes, buckets downwards.
    """
    n = len(text)
    none = lms[:0]
    large: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    if len(lms):
        _spread(seeds, lms, text[lms])
    # the empty suffix is the least of all; before it stands the last suffix
    large[text[n - 1]].append(np.array([n - 1], lms.dtype))
    for symbol in range(symbols):
        whole, wave = [], large[symbol]
        while wave:
            wave = np.concatenate(wave)
            whole.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            large[symbol] = []
            if len(before):
                _spread(large, before, text[before])
            wave = large[symbol]
        large[symbol] = [np.concatenate(whole) if whole else none]
        if seeds[symbol]:
            before = np.concatenate(seeds[symbol]) - 1
            before = before[(before >= 0) & ~small[before]]
            if len(before):
                _spread(large, before, text[before])
    little: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    parts = []
    for symbol in range(symbols - 1, -1, -1):
        whole, wave = [], little[symbol]
        while wave:
            wave = np.concatenate(wave)
            whole.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            little[symbol] = []
            if len(before):
                _spread(little, before, text[before])
            wave = little[symbol]
        own = large[symbol][0]
        if len(own):
            back = own[::-1]
            before = back[back > 0] - 1
            before = before[small[before]]
            if len(before):
                _spread(little, before, text[before])
        parts.append(np.concatenate([*whole, own[::-1]]))
    return np.concatenate(parts)[::-1] if parts else none


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names (from 0) of the LMS substrings in the order ``ordered``; equal ones share a name."""
    n = len(text)
    ends = np.append(lms[1:], n - 1)  # a substring reaches to the next LMS position
    length = np.zeros(n, np.int64)
    length[lms] = ends - lms + 1
    length[lms[-1]] = n - lms[-1] + 1  # the last has the end of the text, which equals nothing
    same = length[ordered[1:]] == length[ordered[:-1]]
    same &= (ordered[1:] != lms[-1]) & (ordered[:-1] != lms[-1])
    left, offset = np.flatnonzero(same), 0
    while len(left):
        a, b = ordered[left] + offset, ordered[left + 1] + offset
        equal = text[a] == text[b]
        same[left[~equal]] = False
        offset += 1
        left = left[equal & (length[ordered[left]] > offset)]
    return np.concatenate([[0], np.cumsum(~same)])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffixes of a string whose alphabet is nearly as large as itself: ranks of doubled length. A round sorts
    only the suffixes that still share a rank, which is the place where their group begins."""
    n = len(names)
    rank, order, at, step = names.astype(np.int64), np.arange(n), np.arange(n), 1
    while len(at):
        rows = order[at]
        after = np.zeros(len(rows), np.int64)
        inside = rows + step < n
        after[inside] = rank[rows[inside] + step] + 1
        key = rank[rows] * (n + 1) + after
        by = np.argsort(key)
        rows, key = rows[by], key[by]
        fresh = np.ones(len(key) + 1, bool)
        fresh[1:-1] = key[1:] != key[:-1]
        order[at] = rows
        rank[rows] = at[np.maximum.accumulate(np.where(fresh[:-1], np.arange(len(key)), 0))]
        at = at[~(fresh[:-1] & fresh[1:])]
        step *= 2
    return order


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers from 0 to ``symbols`` - 1), smallest first."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    small = classify(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) == 0:
        return _induce(text, small, lms, symbols)
    starts = np.zeros(n, bool)
    starts[lms] = True
    rough = _induce(text, small, lms, symbols)
    ordered = rough[starts[rough]]
    named = _names(text, lms, ordered)
    reduced = np.empty(n, np.int64)
    reduced[ordered] = named
    reduced = reduced[lms]
    count = int(named[-1]) + 1
    if count == len(lms):
        order = ordered
    elif len(lms) >= DENSE * count:
        order = lms[suffix_array(reduced, count)]
    else:
        order = lms[_by_doubling(reduced)]
    return _induce(text, small, order, symbols)


def _words(text: np.ndarray) -> tuple[np.ndarray, int, int]:
    """For each place as many symbols from there on as 63 bits hold, the first one highest, 0 behind the end; the bits of
    a symbol and the symbols of a word."""
    bits = (int(text.max()) + 1).bit_length()
    per = max(63 // bits, 1)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(per, np.int64)])
    words = np.zeros(len(text), np.int64)
    for i in range(per):
        words <<= bits
        words |= padded[i : i + len(text)]
    return words, bits, per


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """For each place in the suffix array but the first, the length of the prefix that it shares with
    the suffix before it, counted up to ``most``.

    Computed in text order (permuted), by words of several symbols; the highest bit in which two words differ tells the symbol.
    """
    n = len(suffixes)
    if n < 2:
        return np.zeros(0, np.int64)
    words, bits, per = _words(text)
    words = np.concatenate([words, np.zeros(most + per, np.int64)])
    before = np.full(len(text), -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    value = np.zeros(len(text), np.int64)
    left = np.flatnonzero(before >= 0)
    other = before[left]
    lowest = np.int64(1) << (bits * np.arange(per))
    for length in range(0, most, per):
        apart = words[left + length] ^ words[other + length]
        value[left] += per - np.searchsorted(lowest, apart, "right")
        same = apart == 0
        left, other = left[same], other[same]
    return np.minimum(value, most)[suffixes[1:]]
