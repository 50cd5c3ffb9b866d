"""Suffix trees of word sequences by Ukkonen's method, and longest common extensions in constant time."""

from __future__ import annotations

from array import array

import numpy as np


class SuffixTree:
    """The tree of ``symbols`` (ints from 0), closed by a terminator that is smaller than all of them.

    ``rank`` tells each suffix's place in sorted order. ``extension(i, j)`` are the lengths of the longest
    common prefixes of the suffixes at i and j: the string depths of their lowest common ancestors, range
    minima over an Euler tour of the tree.
    """

    def __init__(self, symbols: list[int]):
        # every symbol moves up by one, so that 0 is the terminator
        text = [s + 1 for s in symbols] + [0]
        self.size = len(symbols)
        self._tour(*_ukkonen(text))

    def _tour(self, text: list[int], edges: dict[int, int], starts: array, stops: array) -> None:
        width, n = max(text) + 1, len(text)
        keys = np.fromiter(edges, np.int64, len(edges))
        # children of a node stand together, smallest symbol first
        order = np.argsort(keys)
        child = np.fromiter(edges.values(), np.int64, len(edges))[order]
        first = np.searchsorted(keys[order] // width, np.arange(len(starts) + 1)).tolist()
        child, lengths = child.tolist(), (np.array(stops) - np.array(starts)).tolist()
        depths, seen, suffixes = array("i"), array("q", bytes(8 * n)), array("q")
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            depths.append(depth)
            if node < 0:  # back at an inner node between two of its children
                continue
            lo, hi = first[node], first[node + 1]
            if lo == hi:
                seen[n - depth] = len(depths) - 1
                suffixes.append(n - depth)
                continue
            for k in range(hi - 1, lo - 1, -1):
                stack.append((-1, depth))
                stack.append((child[k], depth + lengths[child[k]]))
        self._seen = np.array(seen)
        self.rank = np.empty(n, np.int64)
        self.rank[np.array(suffixes)] = np.arange(n)
        level = np.array(depths)
        self._minima = [level]
        while 2 << (len(self._minima) - 1) <= len(level):
            half, last = 1 << (len(self._minima) - 1), self._minima[-1]
            self._minima.append(np.minimum(last[:-half], last[half:]))

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different positions up to ``size`` (the terminator)."""
        a, b = self._seen[i], self._seen[j]
        lo, span = np.minimum(a, b), np.abs(a - b) + 1
        power = np.frexp(span)[1] - 1
        out = np.empty(len(lo), np.int64)
        for p in np.unique(power):
            at = np.flatnonzero(power == p)
            level = self._minima[p]
            out[at] = np.minimum(level[lo[at]], level[lo[at] + span[at] - (1 << int(p))])
        return out


def _ukkonen(text: list[int]) -> tuple[list[int], dict[int, int], array, array]:
    """Edges (node * alphabet + first symbol -> node) and each node's edge label as a range of ``text``.

    ``text`` ends with a symbol that is nowhere else. Node 0 is the root. One phase a symbol: ``pending``
    suffixes are not in the tree yet; the longest of them ends at ``length`` symbols below ``node``.
    """
    n, width = len(text), max(text) + 1
    edges: dict[int, int] = {}
    starts, stops, links = array("q", [0]), array("q", [0]), array("q", [0])
    node = length = pending = 0
    for i in range(n):
        symbol, waiting = text[i], 0
        pending += 1
        while pending:
            key = node * width + text[i - length]
            child = edges.get(key)
            if child is None:
                edges[key] = len(starts)
                starts.append(i), stops.append(n), links.append(0)
                if waiting:
                    links[waiting], waiting = node, 0
            else:
                start = starts[child]
                span = stops[child] - start
                if length >= span:
                    node, length = child, length - span
                    continue
                below = text[start + length]
                if below == symbol:
                    if waiting:
                        links[waiting] = node
                    length += 1
                    break
                inner = len(starts)
                starts.append(start), stops.append(start + length), links.append(0)
                edges[key] = inner
                starts[child] = start + length
                edges[inner * width + below] = child
                edges[inner * width + symbol] = inner + 1
                starts.append(i), stops.append(n), links.append(0)
                if waiting:
                    links[waiting] = inner
                waiting = inner
            pending -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
    return text, edges, starts, stops
