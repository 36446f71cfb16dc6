"""N-best segmentations of whole texts into SentencePiece pieces, and decoding.

A text is a chain of words (a run of blanks and what follows it; no piece crosses the start
of such a run, which is checked when the model is loaded), so its lattice is a chain of word
lattices and scores add up.

1. *Forward*: each distinct word of a batch gets its Viterbi scores and best path, and the
   loss of its second-best path (best path through any edge off the best one).
2. *Choice*: a text's N best paths can leave the best path only in the N - 1 places with the
   smallest losses (leaving it anywhere else is beaten by N better paths).
3. *Backward*: A-star from the end of the chain of those places; the forward Viterbi score of
   a node is the exact cost of the rest, so paths come out best first and every popped node
   lies on one of the N best.

Scores are the model's own; a character without a piece is written as its byte pieces in one
edge that scores ``unknown`` below the worst piece.  Pieces are never trained here.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerguard.llm.common import binary_column, bounded_batches, pieces_by_bytes, without
from ledgerguard.llm.lattice import Lattice, Trie, flat_bytes

MARK = "▁".encode()   # the library's sign for a blank
_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    def __init__(self, path: str, unknown: float = 10.0):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, pieces, scores = [], [], []
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.piece_bytes: dict[int, bytes] = {}
        for i in range(library.get_piece_size()):
            if library.is_byte(i):
                b = int(library.id_to_piece(i)[3:5], 16)
                self.byte_ids[b] = i
                self.piece_bytes[i] = bytes([b])
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                raw = library.id_to_piece(i).replace("▁", " ").encode()
                if b" " in raw.lstrip(b" "):
                    raise ValueError("a piece goes over the start of a word")
                self.ids.append(i)
                pieces.append(raw)
                scores.append(library.get_score(i))
                self.piece_bytes[i] = raw
        if (self.byte_ids < 0).any():
            raise ValueError("the model needs byte pieces")
        self.id_of = np.array(self.ids, dtype=np.int64)
        self.score = np.r_[np.array(scores, dtype=np.float64), min(scores) - unknown]   # the last: byte pieces
        self.bytes_piece = len(scores)
        self.trie = Trie(pieces)

    def _byte_edges(self, found, data: np.ndarray, room: np.ndarray):
        """Edges of whole characters that are not a piece."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        first = data[lead]
        size = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
        size = np.minimum(size, room[lead])
        has = np.zeros(len(data) + 1, dtype=np.int64)
        for at, length, _ in found:       # bit k: there is a piece of k bytes
            short = length <= 4
            np.bitwise_or.at(has, at[short], 1 << length[short])
        lone = (has[lead] >> size) & 1 == 0
        return lead[lone], size[lone], np.full(int(lone.sum()), self.bytes_piece, dtype=np.int64)

    def lattice(self, data: np.ndarray, starts: np.ndarray) -> Lattice:
        return Lattice(self.trie, data, starts, self._byte_edges)


def model(path: str) -> PieceModel:
    """One model per worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts with blanks as blanks, number of words per text); every text that is
    not empty gets one blank in front."""
    rows = [b" " + t.replace(MARK, b" ") if t else b"" for t in texts.to_pylist()]
    ends = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)))
    raw = b"".join(rows)
    data = np.frombuffer(raw, dtype=np.uint8)
    blank = data == 0x20
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    begins = np.r_[0, ends[:-1]]
    start[begins[begins < len(data)]] = True
    cuts = np.r_[np.flatnonzero(start), len(data)]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
    return words, np.diff(np.searchsorted(cuts[:-1], np.r_[0, ends]))


class WordPaths:
    """Best paths and second-best losses of a batch's distinct words."""

    def __init__(self, pieces: PieceModel, words: pa.Array):
        self.model = pieces
        self.data, self.starts = flat_bytes(words)
        self.lattice = lat = pieces.lattice(self.data, self.starts)
        self.edge_score = pieces.score[lat.piece]
        self.best, by = lat.forward_best(self.edge_score)
        rest = lat.backward_best(self.edge_score)
        self.total = self.best[lat.last]
        # the best path of every word, walked back together
        on = np.zeros(len(lat.piece), dtype=bool)
        at, live = lat.last.copy(), np.arange(lat.words)
        steps = []
        while len(live):
            edge = by[at[live]]
            more = edge >= 0
            live, edge = live[more], edge[more]
            on[edge] = True
            steps.append(edge)
            at[live] = lat.start[edge]
        edges = np.concatenate(steps) if steps else np.empty(0, np.int64)
        order = np.lexsort((lat.start[edges], lat.word[edges]))
        self.path = edges[order]
        self.path_at = np.searchsorted(lat.word[self.path], np.arange(lat.words + 1))
        through = self.best[lat.start] + self.edge_score + rest[lat.end]
        second = np.full(lat.words, -np.inf)
        off = np.flatnonzero(~on)
        np.maximum.at(second, lat.word[off], through[off])
        self.loss = self.total - second          # infinite if there is one path only
        self.into: dict[int, list[tuple[int, float, int]]] = {}
        self.indexed: set[int] = set()
        # ids of the best paths, word by word
        self.word_ids, self.id_at = self._ids(self.path, lat.word[self.path])

    def _ids(self, edges: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lat, pieces = self.lattice, self.model
        raw = lat.piece[edges] == pieces.bytes_piece
        size = np.where(raw, lat.size[edges], 1)
        ends = np.cumsum(size)
        out = np.empty(int(size.sum()), dtype=np.int64)
        out[(ends - size)[~raw]] = pieces.id_of[lat.piece[edges[~raw]]]
        if raw.any():
            n = size[raw]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            byte = np.repeat((lat.start[edges] - word)[raw], n) + within
            out[np.repeat((ends - size)[raw], n) + within] = pieces.byte_ids[self.data[byte]]
        return out, np.r_[0, ends][np.searchsorted(word, np.arange(lat.words + 1))]

    def index(self, words: np.ndarray) -> None:
        """Edges by end node of the words that are searched backwards."""
        lat = self.lattice
        need = np.zeros(lat.words, dtype=bool)
        need[words] = True
        for e in np.flatnonzero(need[lat.word]).tolist():
            self.into.setdefault(int(lat.end[e]), []).append((int(lat.start[e]), float(self.edge_score[e]), e))

    def n_best(self, chain: list[int], n: int) -> list[tuple[float, list[list[int]]]]:
        """The n best paths through a chain of words: (score against the best, edges per word)."""
        lat = self.lattice
        first, last = lat.first, lat.last
        heads = [int(first[w]) for w in chain]
        before = np.r_[0.0, np.cumsum([self.total[w] for w in chain])].tolist()
        top = before[-1]
        tick = count()
        # (-(score so far + best rest), order, place in the chain, node, score so far, edges back to front)
        queue = [(-top, next(tick), len(chain) - 1, int(last[chain[-1]]), 0.0, None)] if chain else []
        found = []
        if not chain:
            return [(0.0, [])]
        while queue and len(found) < n:
            negative, _, place, node, score, path = heapq.heappop(queue)
            while node == heads[place] and place > 0:
                place -= 1
                node = int(last[chain[place]])
            if node == heads[place]:
                edges: list[list[int]] = [[] for _ in chain]
                while path is not None:
                    where, e, path = path
                    edges[where].append(e)
                found.append((-negative - top, edges))
                continue
            for start, own, e in self.into.get(node, ()):
                now = score + own
                heapq.heappush(queue, (-(now + before[place] + float(self.best[start])), next(tick), place, start, now,
                                       (place, e, path)))
        return found

    def edge_ids(self, edges: list[int]) -> list[int]:
        """Piece ids of a word's path (edges front to back)."""
        lat, pieces, out = self.lattice, self.model, []
        for e in edges:
            p = int(lat.piece[e])
            if p == pieces.bytes_piece:
                at = int(lat.start[e] - lat.word[e])
                out += pieces.byte_ids[self.data[at:at + int(lat.size[e])]].tolist()
            else:
                out.append(int(pieces.id_of[p]))
        return out


def decode_ids(pieces: PieceModel, ids) -> str:
    """The text of piece ids (without the blank put in front)."""
    raw = b"".join(map(pieces.piece_bytes.__getitem__, ids))
    return raw[1:].decode() if raw[:1] == b" " else raw.decode()


def encode_texts(pieces: PieceModel, texts: pa.Array, n: int) -> Iterator[tuple[np.ndarray, float, list]]:
    """Per text: (best ids, best score, alternatives as (score against the best, {place: ids})), best first; the
    first alternative is the best path itself."""
    words, per = split_words(texts)
    coded = words.dictionary_encode()
    paths = WordPaths(pieces, coded.dictionary)
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(per)
    chosen = []
    for a, b in zip((ends - per).tolist(), ends.tolist(), strict=True):
        loss = paths.loss[number[a:b]]
        k = min(n - 1, b - a)
        if 0 < k < b - a:
            limit = np.partition(loss, k - 1)[k - 1]
            at = np.r_[np.flatnonzero(loss < limit), np.flatnonzero(loss == limit)][:k]
            at.sort()
        else:
            at = np.arange(k)
        chosen.append(a + at[np.isfinite(loss[at])])
    if chosen:
        paths.index(np.unique(number[np.concatenate(chosen)]))
    size = np.diff(paths.id_at)[number]
    stop = np.cumsum(size)
    ids = paths.word_ids[np.arange(int(size.sum())) + np.repeat(paths.id_at[number] - (stop - size), size)]
    bounds = np.r_[0, stop]
    known: dict[tuple[int, ...], list] = {}
    for a, b, at in zip((ends - per).tolist(), ends.tolist(), chosen, strict=True):
        chain = tuple(number[at].tolist())
        if chain not in known:
            known[chain] = paths.n_best(list(chain), n)
        found = [(loss, {int(p): paths.edge_ids(edges) for p, edges in zip(at - a, ways, strict=True)})
                 for loss, ways in known[chain]]
        yield ids[bounds[a]:bounds[b]], float(paths.total[number[a:b]].sum()), found, size[a:b]


def encode_nbest(docs: DataFrame, model_path: str, n: int = 4, text: str = "text", keep: list[str] | None = None,
                 with_ids: bool = False) -> DataFrame:
    """``keep`` columns with n_pieces, ids_crc32 (of the best ids as little-endian unsigned
    32-bit numbers), best_score, nbest_scores, nbest_pieces (arrays, best first, as many as
    there are paths up to ``n``), round_trip (decoding the best ids gives the text), and
    ``nbest_ids`` if asked for.

    Null and empty texts have one path without pieces.  A blank sign in a text counts as a
    blank, so such a text comes back with blanks (round_trip is then against that text).
    Paths of equal score keep the order in which the search meets them.  A very long text is
    encoded whole.  An empty table gives no rows; input columns named like an output column are replaced.
    """
    names = ["n_pieces", "ids_crc32", "best_score", "nbest_scores", "nbest_pieces", "round_trip", "nbest_ids"]
    docs = without(docs, *names)
    bounded_batches(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c != text and c not in names]
    slim = docs.select(*keep, F.col(text).alias("__text"))
    fields = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("best_score", T.DoubleType()), T.StructField("nbest_scores", T.ArrayType(T.DoubleType())),
              T.StructField("nbest_pieces", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    if with_ids:
        fields.append(T.StructField("nbest_ids", T.ArrayType(T.ArrayType(T.IntegerType()))))
    schema = T.StructType([*(slim.schema[c] for c in keep), *fields])
    at = len(keep)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(model_path)
        for batch in pieces_by_bytes(batches, at, 3 << 20):
            texts = binary_column(batch, at)
            rows = []
            for raw, (ids, score, found, size) in zip(texts.to_pylist(), encode_texts(pieces, texts, n), strict=True):
                counts = [len(ids) + sum(len(p) - int(size[w]) for w, p in ways.items()) for _, ways in found]
                back = b"".join(map(pieces.piece_bytes.__getitem__, ids.tolist()))
                same = back == (b" " + raw.replace(MARK, b" ") if raw else b"")
                row = [len(ids), zlib.crc32(ids.astype("<u4").tobytes()), score, [score + x for x, _ in found], counts,
                       same]
                if with_ids:
                    cuts = np.r_[0, np.cumsum(size)]
                    row.append([[i for w in range(len(size)) for i in
                                 (ways[w] if w in ways else ids[cuts[w]:cuts[w + 1]].tolist())] for _, ways in found])
                rows.append(row)
            cols = [pa.array(c, _arrow(f.dataType)) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *cols], names=schema.names)

    return slim.mapInArrow(encode, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return simple[kind.simpleString()]
