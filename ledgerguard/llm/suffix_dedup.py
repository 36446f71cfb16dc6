"""Removal of byte strings that also start in an earlier document.

A byte goes if it is covered by a string of ``length`` bytes that also starts in a document
with a smaller key.  The corpus is compared piecewise, exactly, in four shuffled steps:

1. *Announce*.  Every window of ``length`` bytes owns one anchor: the ``gram`` bytes inside it
   with the smallest hash (leftmost on ties), so equal windows own equal anchors.  Each slice
   of the documents announces its distinct anchors with their documents (7 bytes each).
2. *Answer*.  Per anchor bucket: which anchors occur in more than one document, and which in
   more than ``crowd`` (*crowded*).
3. *Contexts*.  The bytes around each shared anchor (its run of windows, at most
   2 x length - gram bytes) go to the anchor's bucket, each distinct context once per slice,
   with its smallest key.  There they are merged; anchors with several different contexts are
   compared through a Burrows-Wheeler transform of the contexts, extended breadth-first up to
   ``length`` symbols (:mod:`ledgerguard.llm.bwt`), which gives the smallest key of every window.
4. *Removal*.  Each slice takes the windows that have a smaller key elsewhere off its own texts.

Copies cost one entry per slice however many there are.  A crowded anchor is no key: each of its
windows is one by itself (128 bits of hash), dealt by that hash, and a minimum per window is all
there is to know.  So what meets under one key is at most ``crowd`` contexts, or one entry per
slice, whatever phrase a third of all documents share in whatever surroundings.  The slices are
one exchange of the documents, used three times.  A very long text is one text of its slice.
Contexts are Python objects of several times their size, so a slice's and a bucket's are taken up
in ``PARTS`` parts, one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerguard.llm.bwt import prefix_classes
from ledgerguard.llm.common import binary_column, bounded_batches, give_back, shuffle_partitions, without

NO_KEY = np.iinfo(np.int64).max   # documents without a key come after all others
PIECE = 256 << 10                 # bytes hashed at once: arrays that stay in the CPU's cache
BLOCK = 1 << 17                   # symbols of one transform, unless one anchor has more: its arrays stay near the CPU
OCCURRENCES = 1 << 16             # contexts that are Python objects at once in the removal
PARTS = 8                         # parts of a slice's or a bucket's contexts that are Python objects one after the other
_BYTE = np.random.default_rng(50).integers(0, 1 << 32, 256, dtype=np.uint32)
_STEP = 0x9E3779B1


def _gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """32-bit hash of the ``gram`` bytes from every position (by doubling)."""
    have, power, size = {1: _BYTE.take(buf)}, {1: _STEP}, 1
    while size * 2 <= gram:
        have[2 * size] = have[size][:-size] * np.uint32(power[size]) + have[size][size:]
        power[2 * size] = power[size] * power[size] & 0xFFFFFFFF
        size *= 2
    out, done = have[size], size
    for b in sorted(have, reverse=True):
        if done + b <= gram:
            out = out[:len(buf) - done - b + 1] * np.uint32(power[b]) + have[b][done:]
            done += b
    out = out ^ (out >> np.uint32(15))
    out *= np.uint32(0x85EBCA6B)
    return out ^ (out >> np.uint32(13))


def owned_runs(buf: np.ndarray, ends: np.ndarray, length: int, gram: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, one past the last window, document) of each run of windows with
    one anchor; ``ends`` are the documents' ends in ``buf`` and no window crosses them."""
    none = np.empty(0, dtype=np.int64)
    if len(buf) < length:
        return none, none, none, none
    # the hash and, in the low bits, how far in the window its gram starts: the least is the leftmost smallest hash
    span, size = length - gram + 1, 1
    bits = (span - 1).bit_length()
    x = _gram_hashes(buf, gram) >> np.uint32(bits) << np.uint32(bits)
    while size * 2 <= span:
        x = np.minimum(x[:-size], x[size:] + np.uint32(size))
        size *= 2
    if span > size:
        x = np.minimum(x[:size - span], x[span - size:] + np.uint32(span - size))
    x &= np.uint32((1 << bits) - 1)
    anchor = x.view(np.int32)
    anchor += np.arange(len(x), dtype=np.int32)
    for end in ends.tolist():   # windows that would cross a document's end
        anchor[max(0, end - length + 1):end] = -1
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    stop = np.r_[first[1:], len(anchor)]
    ok = anchor[first] >= 0
    first, stop = first[ok], stop[ok]
    doc = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(first, ends), prepend=0))
    return anchor[first].astype(np.int64), first, stop, doc


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one number (zeros after the end)."""
    padded = np.r_[buf, np.zeros(8, np.uint8)]
    return np.ndarray(len(buf) + 1, dtype="<u8", buffer=padded, strides=(1,))


def _word(words: np.ndarray, at: np.ndarray, k: int, size: int) -> np.ndarray:
    """Bytes ``k`` to at most ``k + 8`` of the ``size`` bytes from each place."""
    word = words[at + k]
    return word if size - k >= 8 else word & np.uint64((1 << 8 * (size - k)) - 1)


def _anchor_ids(buf: np.ndarray, at: np.ndarray, gram: int) -> np.ndarray:
    """48-bit hash of the ``gram`` bytes at each anchor (equal hashes of different bytes only
    cost a comparison)."""
    words = _words(buf)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(0, gram, 8):
        word = _word(words, at, k, gram)
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k + 1))
    return out >> np.uint64(16)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, document ends) of runs of about PIECE bytes of whole texts."""
    wide = np.int64 if texts.type == pa.large_binary() else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PIECE, side="right")) - 1)
        b = min(b, len(texts))
        yield a, data[offsets[a]:offsets[b]], offsets[a + 1:b + 1] - offsets[a]
        a = b


def _blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array of ``values`` cut at the element positions ``cuts`` (with both ends)."""
    flat = np.ascontiguousarray(values)
    offsets = (cuts * flat.itemsize).astype(np.int64)
    got = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1,
                                           [None, pa.py_buffer(offsets), pa.py_buffer(flat.view(np.uint8))])
    return got.cast(pa.binary())


def _six(values: np.ndarray) -> np.ndarray:
    """48-bit numbers as six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).view("V6").ravel()


def _from_six(column: pa.ChunkedArray) -> np.ndarray:
    raw = _joined(column, np.uint8).reshape(-1, 6)
    return np.ascontiguousarray(np.pad(raw, ((0, 0), (0, 2)))).view("<u8").ravel()


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


ANNOUNCED = "bucket int, g int, ids binary, many binary"
SHARED = "g int, ids binary, crowded binary"
# a row holds contexts or windows (of crowded anchors); the other columns are empty
CONTEXTS = ("bucket int, g int, ids binary, lows binary, highs binary, sizes binary, bytes binary, "
            "w_keys binary, w_ids binary, w_lows binary, w_highs binary")
MARKS = "g int, ids binary, digests binary, starts binary, stops binary, lows binary, w_keys binary, w_ids binary, w_lows binary"


def _rows(names: str, **columns: pa.Array) -> pa.Table:
    """A table of these columns; the others of ``names`` hold empty bytes."""
    n = len(next(iter(columns.values())))
    order = [c.split()[0] for c in names.split(", ")]
    return pa.table({c: columns.get(c, pa.array([b""] * n, pa.binary())) for c in order})


def _announce(text_at: int, g_at: int, buckets: int, length: int, gram: int):
    def announce(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = binary_column(batch, text_at)
            groups = batch.column(g_at).to_numpy()
            ids, gs, docs = [], [], []
            for a, buf, ends in _pieces(texts):
                at, _, _, doc = owned_runs(buf, ends, length, gram)
                ids.append(_anchor_ids(buf, at, gram))
                gs.append(groups[a + doc])
                docs.append(a + doc)
            h, g, d = np.concatenate(ids), np.concatenate(gs), np.concatenate(docs)
            if not len(h):
                continue
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            place = bucket * (int(g.max()) + 1) + g
            order = np.lexsort((d, h, place))
            h, d, place = h[order], d[order], place[order]
            start = np.r_[True, (h[1:] != h[:-1]) | (place[1:] != place[:-1])]
            first = np.flatnonzero(start)
            docs_of = np.add.reduceat((start | np.r_[True, d[1:] != d[:-1]]).astype(np.int64), first)
            many = np.minimum(docs_of, 255).astype(np.uint8)      # more than enough to tell a crowd over the slices
            h, place = h[first], place[first]
            cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            cuts = np.r_[cut, len(h)]
            width = int(g.max()) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array((place[cut] // width).astype(np.int32)), pa.array((place[cut] % width).astype(np.int32)),
                 _blobs(_six(h), cuts), _blobs(many, cuts)], names=["bucket", "g", "ids", "many"])
            give_back()
    return announce


def _answer(crowd: int):
    def answer(table: pa.Table) -> pa.Table:
        give_back()
        h, many = _from_six(table.column("ids")), _joined(table.column("many"), np.uint8)
        sizes = np.array([len(x) for x in table.column("many").to_pylist()], dtype=np.int64)
        g = np.repeat(table.column("g").to_numpy(), sizes)
        order = np.argsort(h)
        h, many, g = h[order], many[order], g[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        count = np.diff(np.r_[first, len(h)])
        found = np.add.reduceat(many.astype(np.int64), first) if len(h) else first
        known = np.repeat(found > 1, count)
        crowded = np.repeat(found > crowd, count).astype(np.uint8)
        h, g, crowded = h[known], g[known], crowded[known]
        order = np.lexsort((h, g))
        h, g, crowded = h[order], g[order], crowded[order]
        keep = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])] if len(h) else np.empty(0, bool)
        h, g, crowded = h[keep], g[keep], crowded[keep]
        cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(h) else np.empty(0, np.int64)
        cuts = np.r_[cut, len(h)]
        return pa.table({"g": pa.array(g[cut].astype(np.int32), pa.int32()), "ids": _blobs(_six(h), cuts),
                         "crowded": _blobs(crowded, cuts)})
    return answer


def _runs(texts: pa.Array, wanted: np.ndarray, length: int, gram: int):
    """Per piece of the texts (first document, bytes, document ends) and the runs of windows whose
    anchor is in ``wanted`` (sorted): first window, one past the last, document, anchor id."""
    if not len(wanted):
        return
    for a, buf, ends in _pieces(texts):
        at, first, stop, doc = owned_runs(buf, ends, length, gram)
        own = _anchor_ids(buf, at, gram)
        spot = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
        hit = np.flatnonzero(wanted[spot] == own)
        yield a, buf, ends, first[hit], stop[hit], doc[hit], own[hit]


def _occurrences(texts: pa.Array, shared: np.ndarray, length: int, gram: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, anchor id, bytes of context) of every run of windows whose anchor is
    in ``shared`` (sorted)."""
    docs, places, ids, sizes = [], [], [], []
    for a, _, ends, first, stop, doc, own in _runs(texts, shared, length, gram):
        docs.append(a + doc)
        places.append(first - np.r_[0, ends[:-1]][doc])
        ids.append(own)
        sizes.append(stop + length - 1 - first)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs, places, ids, sizes))


def _cut_out(texts: pa.Array, docs: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """The bytes at these places."""
    if not len(docs):
        return []
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:]
    raw, at = texts.buffers()[2].to_pybytes(), offsets[docs] + places
    return [raw[i:j] for i, j in zip(at.tolist(), (at + sizes).tolist(), strict=True)]


def _window_hashes(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """(windows, 2): 128 bits of hash of the ``length`` bytes from each place."""
    words = _words(buf)
    out = np.zeros((len(at), 2), dtype=np.uint64)
    for k in range(0, length, 8):
        word = _word(words, at, k, length)
        for c, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            out[:, c] = _mix(out[:, c] * np.uint64(odd) + (word ^ np.uint64(odd >> 7)) + np.uint64(k + 1 + c))
    return out


def _crowded_windows(texts: pa.Array, crowded: np.ndarray, length: int, gram: int
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, anchor id, hashes) of every window of a crowded anchor."""
    docs, places, ids, hashes = [], [], [], []
    for a, buf, ends, first, stop, doc, own in _runs(texts, crowded, length, gram):
        n = stop - first
        at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        doc = np.repeat(doc, n)
        docs.append(a + doc)
        places.append(at - np.r_[0, ends[:-1]][doc])
        ids.append(np.repeat(own, n))
        hashes.append(_window_hashes(buf, at, length))
    if not docs:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), np.empty((0, 2), np.uint64)
    return tuple(np.concatenate(x) for x in (docs, places, ids, hashes))


def _cuts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values, and the same with the end."""
    cut = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, np.int64)
    return cut, np.r_[cut, len(x)]


def _same_window(hashes: np.ndarray) -> np.ndarray:
    """First places of equal windows in sorted order."""
    return np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]).any(axis=1)]) if len(hashes) else np.empty(0, np.int64)


def _context_rows(g: int, ctx: list[bytes], h: np.ndarray, low: np.ndarray, bucket: np.ndarray) -> pa.Table:
    """A row for each bucket: the distinct contexts of slice ``g`` with anchor, smallest key and how far
    the largest is from it (``low`` ascends)."""
    last = dict(zip(ctx, range(len(ctx)), strict=True))
    first = dict(zip(reversed(ctx), range(len(ctx) - 1, -1, -1), strict=True))
    distinct = list(last)
    head = np.fromiter(map(first.__getitem__, distinct), dtype=np.int64, count=len(distinct))
    tail = np.fromiter(last.values(), dtype=np.int64, count=len(distinct))
    ids, lows, highs, bucket = h[head], low[head], low[tail], bucket[head]
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut, cuts = _cuts(bucket)
    sizes = np.fromiter(map(len, distinct), dtype=np.uint16, count=len(distinct))[order]
    flat = np.frombuffer(b"".join([distinct[i] for i in order.tolist()]), dtype=np.uint8)
    at = np.r_[0, np.cumsum(sizes, dtype=np.int64)][cuts]
    packed = [pa.compress(flat[a:b].tobytes(), codec="zstd", asbytes=True)
              for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return _rows(CONTEXTS, bucket=pa.array(bucket[cut].astype(np.int32), pa.int32()),
                 g=pa.array(np.full(len(cut), g, np.int32), pa.int32()), ids=_blobs(_six(ids[order]), cuts),
                 lows=_blobs(lows[order].astype(np.int64), cuts),
                 highs=_blobs((highs[order] - lows[order]).astype(np.int64), cuts),   # mostly zeros
                 sizes=_blobs(sizes, cuts), bytes=pa.array(packed, pa.binary()))


def _contexts(buckets: int, length: int, gram: int, key: str, text: str):
    def contexts(_, docs: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        if not answers.num_rows or not docs.num_rows:
            return _rows(CONTEXTS, bucket=pa.array([], pa.int32()), g=pa.array([], pa.int32()))
        g = answers.column("g")[0].as_py()
        shared, crowded = _from_six(answers.column("ids")), _joined(answers.column("crowded"), np.uint8)
        low = docs.column(key).cast(pa.int64()).fill_null(NO_KEY).to_numpy()
        by_key = np.argsort(low, kind="stable")       # ascending: first and last seen are low and high
        texts = _texts(docs, text).take(pa.array(by_key))
        sorted_low = low[by_key]
        doc, place, h, size = _occurrences(texts, np.sort(shared[crowded == 0]), length, gram)
        bucket = (h.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)
        part = bucket * PARTS // buckets              # a bucket is in one part
        out = [_rows(CONTEXTS, bucket=pa.array([], pa.int32()), g=pa.array([], pa.int32()))]
        for p in range(PARTS):
            mine = np.flatnonzero(part == p)
            if len(mine):
                out.append(_context_rows(g, _cut_out(texts, doc[mine], place[mine], size[mine]), h[mine].astype(np.uint64),
                                         sorted_low[doc[mine]], bucket[mine]))
        out = pa.concat_tables(out)
        doc, _, own, hashes = _crowded_windows(texts, np.sort(shared[crowded == 1]), length, gram)
        if not len(doc):
            return out
        bucket = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, hashes[:, 1], hashes[:, 0], bucket))
        doc, own, hashes, bucket = doc[order], own[order], hashes[order], bucket[order]
        first = _same_window(hashes)
        lows, highs = sorted_low[doc[first]], sorted_low[doc[np.r_[first[1:], len(doc)] - 1]]
        cut, cuts = _cuts(bucket[first])
        return pa.concat_tables([out, _rows(
            CONTEXTS, bucket=pa.array(bucket[first][cut].astype(np.int32), pa.int32()),
            g=pa.array(np.full(len(cut), g, np.int32), pa.int32()), w_keys=_blobs(hashes[first].view("V16").ravel(), cuts),
            w_ids=_blobs(_six(own[first]), cuts), w_lows=_blobs(lows.astype(np.int64), cuts),
            w_highs=_blobs((highs - lows).astype(np.int64), cuts))])
    return contexts


def _texts(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name).combine_chunks()
    col = col if isinstance(col, pa.Array) else pa.concat_arrays(col.chunks)
    return col.cast(pa.large_binary()).fill_null(b"")


def window_lows(flat: np.ndarray, starts: np.ndarray, keys: np.ndarray, lows: np.ndarray, length: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Smallest key of every window of ``length`` bytes of the (distinct) contexts
    ``flat[starts[i]:starts[i + 1]]``, and the contexts' starts in that array.  Contexts of one
    class key are compared with each other; a lone one has only its own key."""
    sizes = np.diff(starts)
    windows = sizes - length + 1
    at = np.r_[0, np.cumsum(windows)]
    out = np.repeat(lows, windows)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(keys) else np.empty(0, np.int64)
    count = np.diff(np.r_[first, len(keys)])
    members = order[np.repeat(count > 1, count)]          # classes in a row
    class_end = np.cumsum(count[count > 1])
    symbols = np.cumsum(sizes[members] + 1)
    begin = 0
    while begin < len(members):
        # whole classes up to about BLOCK symbols
        before = symbols[begin - 1] if begin else 0
        target = np.searchsorted(symbols, before + BLOCK)
        end = int(class_end[min(np.searchsorted(class_end, target), len(class_end) - 1)])
        block = members[begin:end]
        size = sizes[block] + 1                           # one separator after each
        head = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(head, size)
        s = np.zeros(len(inside), dtype=np.uint16)
        text = inside < np.repeat(size - 1, size)
        s[text] = flat[(np.repeat(starts[block], size) + inside)[text]].astype(np.uint16) + 1
        classes = prefix_classes(s, length)
        n = windows[block]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        cls, low = classes[np.repeat(head, n) + within], np.repeat(lows[block], n)
        by = np.argsort(cls, kind="stable")
        start = np.flatnonzero(np.r_[True, np.diff(cls[by]) != 0])
        least = np.empty(len(by), dtype=np.int64)
        least[by] = np.repeat(np.minimum.reduceat(low[by], start), np.diff(np.r_[start, len(by)]))
        out[np.repeat(at[block], n) + within] = least
        begin = end
    return out, at


def _window_marks(table: pa.Table) -> pa.Table:
    """For each slice, its windows of crowded anchors that have a smaller key elsewhere."""
    hashes = _joined(table.column("w_keys"), np.uint64).reshape(-1, 2)
    lows = _joined(table.column("w_lows"), np.int64)
    highs = lows + _joined(table.column("w_highs"), np.int64)
    own = _from_six(table.column("w_ids"))
    per = np.array([len(x) // 8 for x in table.column("w_lows").to_pylist()], dtype=np.int64)
    g = np.repeat(table.column("g").to_numpy(), per)
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    hashes, lows, highs, own, g = hashes[order], lows[order], highs[order], own[order], g[order]
    first = _same_window(hashes)
    least = np.repeat(np.minimum.reduceat(lows, first), np.diff(np.r_[first, len(lows)])) if len(lows) else lows
    ok = np.flatnonzero(least < highs)
    ok = ok[np.argsort(g[ok], kind="stable")]
    cut, cuts = _cuts(g[ok])
    return _rows(MARKS, g=pa.array(g[ok][cut].astype(np.int32), pa.int32()), w_keys=_blobs(hashes[ok].view("V16").ravel(), cuts),
                 w_ids=_blobs(_six(own[ok]), cuts), w_lows=_blobs(least[ok], cuts))


def _smaller_elsewhere(entries: list[bytes], ids: np.ndarray, lows: np.ndarray, highs: np.ndarray, g: np.ndarray, length: int
                       ) -> tuple[np.ndarray, ...]:
    """(slice, anchor, digest of the context, first window, one past the last, smallest key) of the
    stretches of windows with a key below their slice's largest."""
    number = {c: i for i, c in enumerate(dict.fromkeys(entries))}
    which = np.fromiter(map(number.__getitem__, entries), dtype=np.int64, count=len(entries))
    n = len(number)
    low = np.full(n, NO_KEY, dtype=np.int64)
    np.minimum.at(low, which, lows)
    class_key = np.zeros(n, dtype=np.uint64)
    class_key[which] = ids
    starts = np.r_[0, np.cumsum(np.fromiter(map(len, number), dtype=np.int64, count=n))]
    least, at = window_lows(np.frombuffer(b"".join(number), dtype=np.uint8), starts, class_key, low, length)
    # stretches of windows with one smallest key, per distinct context
    change = np.r_[True, least[1:] != least[:-1]] if len(least) else np.empty(0, bool)
    change[at[:-1]] = True
    run = np.flatnonzero(change)
    run_stop = np.r_[run[1:], len(least)]
    first_run = np.searchsorted(run, at)
    runs = np.diff(first_run)[which]                  # of each entry
    entry = np.repeat(np.arange(len(which)), runs)
    r = np.repeat(first_run[which], runs) + np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    ok = least[run[r]] < highs[entry]
    entry, r = entry[ok], r[ok]
    digest = np.fromiter(map(xxhash.xxh64_intdigest, number), dtype=np.uint64, count=n)
    base = at[which[entry]]
    return (g[entry], ids[entry], digest[which[entry]], (run[r] - base).astype(np.uint16),
            (run_stop[r] - base).astype(np.uint16), least[run[r]])


def _classes(length: int):
    def classes(table: pa.Table) -> pa.Table:
        give_back()
        windows = np.array([len(x) > 0 for x in table.column("w_lows").to_pylist()])
        return pa.concat_tables([_context_marks(table.filter(pa.array(~windows))), _window_marks(table.filter(pa.array(windows)))])

    def _context_marks(table: pa.Table) -> pa.Table:
        ids = _from_six(table.column("ids"))
        lows = _joined(table.column("lows"), np.int64)
        highs = lows + _joined(table.column("highs"), np.int64)
        sizes = _joined(table.column("sizes"), np.uint16).astype(np.int64)
        counts = [np.frombuffer(x, dtype=np.uint16) for x in table.column("sizes").to_pylist()]
        per = np.array([len(x) for x in counts], dtype=np.int64)
        g = np.repeat(table.column("g").to_numpy(), per)
        raw = b"".join(pa.decompress(x, decompressed_size=int(n.sum(dtype=np.int64)), codec="zstd", asbytes=True)
                       for x, n in zip(table.column("bytes").to_pylist(), counts, strict=True))
        ends = np.cumsum(sizes)
        part = ((ids >> np.uint64(8)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(PARTS)
        found = []                                        # an anchor's contexts are in one part
        for p in range(PARTS):
            mine = np.flatnonzero(part == p)
            entries = [raw[a:b] for a, b in zip((ends - sizes)[mine].tolist(), ends[mine].tolist(), strict=True)]
            found.append(_smaller_elsewhere(entries, ids[mine], lows[mine], highs[mine], g[mine], length))
        del raw
        gs, ids, digests, starts, stops, least = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(gs, kind="stable")
        cut, cuts = _cuts(gs[order])
        return _rows(MARKS, g=pa.array(gs[order][cut].astype(np.int32), pa.int32()), ids=_blobs(_six(ids[order]), cuts),
                     digests=_blobs(digests[order], cuts), starts=_blobs(starts[order], cuts), stops=_blobs(stops[order], cuts),
                     lows=_blobs(least[order], cuts))
    return classes


def _crowded_spans(texts: pa.Array, keys: np.ndarray, marks: pa.Table, length: int, gram: int):
    """(document, start, end) of stretches of windows of crowded anchors with a smaller key elsewhere."""
    hashes = _joined(marks.column("w_keys"), np.uint64).reshape(-1, 2)
    lows, own = _joined(marks.column("w_lows"), np.int64), _from_six(marks.column("w_ids"))
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    hashes, lows = hashes[order], lows[order]
    doc, place, _, mine = _crowded_windows(texts, np.unique(own), length, gram)
    if not len(doc) or not len(lows):
        return
    at = np.searchsorted(hashes[:, 0], mine[:, 0])
    least = np.full(len(doc), NO_KEY)
    # windows whose first 64 bits agree lie in a row; the other 64 decide
    for k in range(int(np.diff(np.r_[_cuts(hashes[:, 0])[1]]).max())):
        spot = np.minimum(at + k, len(lows) - 1)
        same = (hashes[spot] == mine).all(axis=1)
        least[same] = lows[spot[same]]
    hit = np.flatnonzero(least < keys[doc])
    hit = hit[np.lexsort((place[hit], doc[hit]))]
    doc, place = doc[hit], place[hit]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + 1)]) if len(doc) else hit
    last = np.r_[first[1:], len(doc)] - 1 if len(doc) else hit
    yield from zip(doc[first].tolist(), place[first].tolist(), (place[last] + length).tolist(), strict=True)


def _remove(length: int, gram: int, key: str, text: str, keep: list[str], with_text: bool):
    def remove(_, docs: pa.Table, marks: pa.Table) -> pa.Table:
        give_back()
        texts = _texts(docs, text)
        keys = docs.column(key).cast(pa.int64()).fill_null(NO_KEY).to_pylist()
        spans: dict[int, list[tuple[int, int]]] = {}
        if marks.num_rows and docs.num_rows:
            ids = _from_six(marks.column("ids"))
            found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            for h, d, s, e, m in zip(ids.tolist(), *(_joined(marks.column(c), t).tolist() for c, t in (
                    ("digests", np.uint64), ("starts", np.uint16), ("stops", np.uint16), ("lows", np.int64))),
                    strict=True):
                found.setdefault((h, d), []).append((s, e, m))
            doc, where, own, size = _occurrences(texts, np.unique(ids), length, gram)
            for i in range(0, len(doc), OCCURRENCES):
                some = [x[i:i + OCCURRENCES] for x in (doc, where, own, size)]
                ctx = _cut_out(texts, some[0], some[1], some[3])
                for d, w, h, c in zip(*(x.tolist() for x in some[:3]), ctx, strict=True):
                    for s, e, m in found.get((h, xxhash.xxh64_intdigest(c)), ()):
                        if m < keys[d]:
                            spans.setdefault(d, []).append((w + s, w + e + length - 1))
            del found
            for d, a, b in _crowded_spans(texts, np.array(keys, dtype=np.int64), marks, length, gram):
                spans.setdefault(d, []).append((a, b))
        size, gone, cuts, sha, kept_text = [], [], [], [], []
        for d, raw in enumerate(texts.to_pylist()):
            merged: list[list[int]] = []
            for a, b in sorted(spans.get(d, ())):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            left = b"".join([*kept, raw[at:]])
            size.append(len(raw))
            gone.append(len(raw) - len(left))
            cuts.append(len(merged))
            sha.append(hashlib.sha256(left).hexdigest())
            if with_text:
                kept_text.append(left.decode("utf-8", "ignore") if merged else None)
        out = {c: docs.column(c) for c in keep}
        if with_text:
            out["kept_text"] = pa.array(kept_text, pa.string())
        return pa.table(out | {"n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                               "n_spans": pa.array(cuts, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})
    return remove


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, gram: int = 16,
                   crowd: int = 1000, with_text: bool = False) -> DataFrame:
    """``docs`` rows (without the text unless ``with_text``) with n_bytes, n_removed, n_spans,
    kept_sha256, and with ``with_text`` the text and ``kept_text`` (null where nothing was
    removed; a character of which only some bytes are left is dropped).

    Null text counts as empty; rows without a key come after all others and are not compared
    among themselves; rows with equal keys are not earlier than each other, so repeated rows
    keep equal results; texts shorter than ``length`` bytes lose nothing; an empty table gives
    no rows.  Input columns named like an output column are replaced.
    """
    docs = without(docs, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "__g")
    spark = docs.sparkSession
    bounded_batches(spark)
    n = shuffle_partitions(spark)
    slices = (docs.withColumn("__g", F.pmod(F.xxhash64(key, text), F.lit(2 * n)).cast("int"))
              .repartition(n, "__g"))
    at = slices.columns.index
    announced = slices.mapInArrow(_announce(at(text), at("__g"), n, length, gram), ANNOUNCED)
    shared = announced.groupBy("bucket").applyInArrow(_answer(crowd), SHARED)
    contexts = (slices.groupBy("__g").cogroup(shared.groupBy("g"))
                .applyInArrow(_contexts(n, length, gram, key, text), CONTEXTS))
    marks = contexts.groupBy("bucket").applyInArrow(_classes(length), MARKS)
    keep = [c for c in docs.columns if with_text or c != text]
    fields = [docs.schema[c] for c in keep]
    if with_text:
        fields.append(T.StructField("kept_text", T.StringType()))
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    fields.append(T.StructField("kept_sha256", T.StringType()))
    return (slices.groupBy("__g").cogroup(marks.groupBy("g"))
            .applyInArrow(_remove(length, gram, key, text, keep, with_text), T.StructType(fields)))
