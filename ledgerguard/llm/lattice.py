"""Piece lattices of many words at once, on byte arrays.

A word's lattice has a node before, between and after its bytes and an edge for every
vocabulary piece found in it.  All words of a batch are walked through the vocabulary's trie
together; the forward and backward passes go over (end offset, piece length) groups, in each
of which every word has at most one edge, so the steps are plain array operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Trie:
    """Vocabulary trie with its transitions in one open-addressing table."""

    def __init__(self, pieces: list[bytes]):
        children: dict[int, int] = {}
        piece_at = [-1]
        self.longest = max(map(len, pieces), default=0)
        for i, p in enumerate(pieces):
            node = 0
            for b in p:
                step = node << 8 | b
                nxt = children.get(step)
                if nxt is None:
                    nxt = children[step] = len(piece_at)
                    piece_at.append(-1)
                node = nxt
            piece_at[node] = i
        self.piece_at = np.array(piece_at, dtype=np.int32)
        self.bits = max(4, (4 * max(1, len(children))).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, dtype=np.int64)
        self.next = np.zeros(size, dtype=np.int32)
        steps = np.fromiter(children, dtype=np.int64, count=len(children))
        nodes = np.fromiter(children.values(), dtype=np.int32, count=len(children))
        slot = self._slot(steps)
        while len(steps):
            free = self.keys[slot] == -1
            at, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[at], self.next[at] = steps[put], nodes[put]
            left = np.ones(len(steps), dtype=bool)
            left[put] = False
            steps, nodes, slot = steps[left], nodes[left], (slot[left] + 1) & (size - 1)

    def _slot(self, steps: np.ndarray) -> np.ndarray:
        return ((steps.astype(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next nodes, -1 where there is none."""
        want = node.astype(np.int64) << 8 | byte
        slot = self._slot(want)
        out = np.full(len(want), -1, dtype=np.int32)
        open_ = np.arange(len(want))
        while len(open_):
            found = self.keys[slot[open_]]
            hit = found == want[open_]
            out[open_[hit]] = self.next[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
        return out


class Lattice:
    """Edges (start node, length, piece) of all words, grouped by (end offset, length).

    ``data``: the words' bytes in a row; ``starts``: their starts and the end.  Node
    ``starts[w] + w + j`` lies before byte j of word w.  ``extra``: more edges
    (byte position, length, piece), such as those of characters without a piece.
    """

    def __init__(self, trie: Trie, data: np.ndarray, starts: np.ndarray, extra=None):
        n = len(data)
        self.words = len(starts) - 1
        sizes = np.diff(starts)
        word = np.repeat(np.arange(self.words, dtype=np.int32), sizes)
        room = np.repeat(starts[1:], sizes) - np.arange(n)      # bytes left in the word
        offset = np.arange(n) - np.repeat(starts[:-1], sizes)
        pos, node = np.arange(n), np.zeros(n, dtype=np.int32)
        found = []
        for length in range(1, trie.longest + 1):
            ok = room[pos] >= length
            pos, node = pos[ok], node[ok]
            if not len(pos):
                break
            node = trie.step(node, data[pos + length - 1])
            ok = node >= 0
            pos, node = pos[ok], node[ok]
            piece = trie.piece_at[node]
            hit = piece >= 0
            found.append((pos[hit], np.full(int(hit.sum()), length, dtype=np.int64), piece[hit]))
        if extra is not None:
            found.append(extra(found, data, room))
        at, size, piece = (np.concatenate(x) if found else np.empty(0, np.int64) for x in zip(*found, strict=True)) \
            if found else (np.empty(0, np.int64),) * 3
        end = offset[at] + size
        width = int(size.max(initial=0)) + 1
        group = end * width + size
        order = np.argsort(group, kind="stable")
        self.start = (at + word[at])[order]
        self.size, self.piece = size[order], piece[order].astype(np.int64)
        self.end = self.start + self.size
        self.word = word[at][order]
        group = group[order]
        cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        self.groups = list(zip(cut.tolist(), np.r_[cut[1:], len(group)].tolist(), strict=True)) if len(cut) else []
        self.first = starts[:-1] + np.arange(self.words)
        self.last = starts[1:] + np.arange(self.words)
        self.nodes = n + self.words

    def forward_sum(self, logp: np.ndarray) -> np.ndarray:
        """log of the summed probabilities of all segmentations up to each node; ``logp``:
        (pieces, models) log probabilities."""
        alpha = np.full((self.nodes, logp.shape[1]), -np.inf)
        alpha[self.first] = 0.0
        for a, b in self.groups:
            end = self.end[a:b]
            alpha[end] = np.logaddexp(alpha[end], alpha[self.start[a:b]] + logp[self.piece[a:b]])
        return alpha

    def backward_sum(self, logp: np.ndarray) -> np.ndarray:
        beta = np.full((self.nodes, logp.shape[1]), -np.inf)
        beta[self.last] = 0.0
        for a, b in reversed(self.groups):
            start = self.start[a:b]
            beta[start] = np.logaddexp(beta[start], beta[self.end[a:b]] + logp[self.piece[a:b]])
        return beta

    def forward_best(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best score up to each node and the edge it ends with (-1 at starts); of equal
        scores the shorter last edge."""
        best = np.full(self.nodes, -np.inf)
        best[self.first] = 0.0
        by = np.full(self.nodes, -1, dtype=np.int64)
        for a, b in self.groups:
            end = self.end[a:b]
            got = best[self.start[a:b]] + score[a:b]
            up = got > best[end]
            best[end[up]] = got[up]
            by[end[up]] = np.arange(a, b)[up]
        return best, by

    def backward_best(self, score: np.ndarray) -> np.ndarray:
        best = np.full(self.nodes, -np.inf)
        best[self.last] = 0.0
        for a, b in reversed(self.groups):
            start = self.start[a:b]
            best[start] = np.maximum(best[start], best[self.end[a:b]] + score[a:b])
        return best


def flat_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes in a row, starts and the end) of a binary array without nulls."""
    wide = np.int64 if words.type in (pa.large_binary(), pa.large_string()) else np.int32
    starts = np.frombuffer(words.buffers()[1], dtype=wide)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]] if data else np.empty(0, np.uint8)
    return flat, starts - starts[0]
