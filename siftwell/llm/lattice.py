"""The composition of many short tapes with a piece transducer at once, and their least-weight paths, in numpy.

Positions are the bytes of all tapes laid end to end with a gap of one byte between two. Arcs are found by stepping a byte trie from every position together; positions
are then relaxed in order, the k-th of every tape in one step. Within a step no two arcs end at the same position of a tape.
"""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = -1


class Table:
    """Whole numbers from 0 on to whole numbers, by open addressing; arrays go in and out."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self._room(len(keys))
        self.put(keys, values)

    def _room(self, n: int) -> None:
        bits = max(4, (3 * n).bit_length())
        self.size, self.shift, self.used = 1 << bits, np.uint64(64 - bits), 0
        self.keys, self.values = np.full(self.size, _EMPTY, np.int64), np.zeros(self.size, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that aren't there yet."""
        if 2 * (self.used + len(keys)) > self.size:
            old = self.keys != _EMPTY
            keys, values = np.r_[self.keys[old], keys], np.r_[self.values[old], values]
            self._room(len(keys))
        self.used += len(keys)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == _EMPTY]
            self.keys[at[free]] = keys[free]
            won = free[self.keys[at[free]] == keys[free]]
            self.values[at[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & (self.size - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for what isn't there."""
        at = self._home(keys)
        have = self.keys[at]
        out = np.where(have == keys, self.values[at], -1)
        left = np.flatnonzero((have != keys) & (have != _EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & (self.size - 1)
            have = self.keys[at[left]]
            same = have == keys[left]
            out[left[same]] = self.values[at[left[same]]]
            left = left[~same & (have != _EMPTY)]
        return out


class ByteTrie:
    """Byte strings to labels. Nodes are numbered; node 0 is the root."""

    def __init__(self, strings: list[bytes], labels: list[int]):
        nodes: dict[int, int] = {}
        label_of = [-1]
        for text, label in zip(strings, labels, strict=True):
            node = 0
            for byte in text:
                below = nodes.get(node << 8 | byte)
                if below is None:
                    below = nodes[node << 8 | byte] = len(label_of)
                    label_of.append(-1)
                node = below
            label_of[node] = label
        self.table = Table(np.fromiter(nodes.keys(), np.int64, len(nodes)), np.fromiter(nodes.values(), np.int64, len(nodes)))
        self.label_of = np.array(label_of, np.int32)
        self.roots = np.array([nodes.get(b, -1) for b in range(256)], np.int32)

    def arcs(self, text: np.ndarray, begin: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """begin, end and label of every string that begins at one of the positions and ends at or before its ``until``."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        node, depth = self.roots[text[begin]], 1
        while True:
            on = node >= 0
            begin, until, node = begin[on], until[on], node[on]
            if not len(begin):
                break
            label = self.label_of[node]
            hit = label >= 0
            found.append((begin[hit], begin[hit] + depth, label[hit]))
            more = begin + depth < until
            begin, until, node = begin[more], until[more], node[more]
            node = self.table.get((node.astype(np.int64) << 8) | text[begin + depth])
            depth += 1
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def relax(begin: np.ndarray, end: np.ndarray, label: np.ndarray, place: np.ndarray, heads: np.ndarray, size: int, weigh, start: int) -> tuple[np.ndarray, np.ndarray]:
    """label and begin of the last arc on the least-weight path to each position; label is ``start`` where there is none.

    place: of each arc's begin within its tape, under 256; heads: first positions of tapes; weigh(labels before, labels): weights,
    never negative.
    """
    order = np.argsort(place.astype(np.uint8), kind="stable")
    begin, end, label, place = begin[order], end[order], label[order], place[order]
    cost = np.full(size, np.inf, np.float32)
    last, back = np.full(size, start, np.int32), np.zeros(size, np.int32)
    cost[heads] = 0.0
    border = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else np.zeros(1, np.int64)
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        one, two, what = begin[a:b], end[a:b], label[a:b]
        left = np.flatnonzero(cost[two] > cost[one])
        one, two, what = one[left], two[left], what[left]
        weight = cost[one] + weigh(last[one], what)
        better = np.flatnonzero(weight < cost[two])
        two = two[better]
        cost[two], last[two], back[two] = weight[better], what[better], one[better]
    return last, back
