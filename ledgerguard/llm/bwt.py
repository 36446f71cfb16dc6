"""Suffix order, Burrows-Wheeler transform and length-bounded prefix classes of one block.

``prefix_classes`` labels every position of a symbol array so that two positions get one
label exactly if the next ``length`` symbols are equal.  It follows the breadth-first
computation of common prefixes from the transform: level by level, each boundary of length
l found in suffix order is extended backwards by one symbol, which gives the boundaries of
length l + 1; the search stops at ``length``, so longer common prefixes are never resolved.
"""

from __future__ import annotations

import numpy as np

SYMBOL_BITS = 9   # a byte plus one, or 0 for the separator
FIRST = 7         # symbols in one 63-bit key
FEWER = 20        # a search among the new boundaries costs about as much as so many steps of a running sum


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s``, read as a ring, ordered by their next ``depth`` symbols or a few
    more (ties in any order), by prefix doubling (or more at a time, where ranks are short)."""
    n = len(s)
    padded = np.resize(s, n + FIRST).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(FIRST):
        key = (key << np.uint64(SYMBOL_BITS)) | padded[k:n + k]
    done = FIRST
    while True:
        order = np.argsort(key)
        if done >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]]).astype(np.uint64)
        bits = int(n).bit_length()
        times = max(2, 63 // bits)             # as many ranks as fit a key
        key = rank
        for j in range(1, times):
            key = (key << np.uint64(bits)) | np.roll(rank, -(done * j % n))
        done *= times


def prefix_boundaries(s: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Boolean array over ``order``: True where a suffix and the one before it share fewer
    than ``length`` symbols."""
    n = len(s)
    before = s[order - 1]                      # the transform (position 0 wraps to the end)
    last = np.argsort(before, kind="stable")   # of c-th rank in the transform: where it stands
    counts = np.bincount(before, minlength=1 << SYMBOL_BITS)
    first = np.r_[0, np.cumsum(counts)]        # start of each symbol's block
    found = np.zeros(n + 1, dtype=bool)
    found[first[:-1][counts > 0]] = True       # level 0: first symbols differ
    found[n] = True
    fresh = np.flatnonzero(found[:n])
    onto = np.empty(n, dtype=np.int64)         # the suffix one symbol longer than a row's
    onto[last] = np.arange(n)
    unset = np.flatnonzero(~found[:n])
    lo, hi = last[unset - 1], last[unset]      # the suffixes one symbol shorter
    apart = hi - lo > 1                        # others are next to each other: only the boundary between them counts
    unset, lo, hi, since = unset[apart], lo[apart], hi[apart], 0
    for _ in range(1, length):
        if not len(fresh):
            break
        new = onto[fresh]                      # right above a boundary: it is theirs, one symbol on
        new = new[~found[new]]
        found[new] = True
        if len(unset):
            if len(unset) * FEWER < n:
                fresh = np.sort(fresh)
                more = unset[np.searchsorted(fresh, hi, side="right") != np.searchsorted(fresh, lo, side="right")]
            else:
                seen = np.zeros(n + 1, dtype=np.int32)
                seen[1:][fresh] = 1
                np.cumsum(seen, out=seen)
                more = unset[seen[hi + 1] != seen[lo + 1]]     # a boundary between them
            more = more[~found[more]]
            found[more] = True
            new = np.concatenate([new, more])
            since += len(new)
            if since * 4 > len(unset):
                still = ~found[unset]
                unset, lo, hi, since = unset[still], lo[still], hi[still], 0
        fresh = new
    return found[:n]


def prefix_classes(s: np.ndarray, length: int) -> np.ndarray:
    """A class number for every position of ``s`` (uint16 symbols, 0 the separator)."""
    if not len(s):
        return np.empty(0, dtype=np.int64)
    order = suffix_order(s, length + 1)
    out = np.empty(len(s), dtype=np.int64)
    out[order] = np.cumsum(prefix_boundaries(s, order, length))
    return out
