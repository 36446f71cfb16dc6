"""Byte-level BPE over columns of texts: cut into pre-tokens, encode each distinct one once.

The library's byte-level splitter cuts a text into pre-tokens that are encoded one by one, so
the ids of a text are the ids of its pre-tokens in order.  A batch of texts is cut with numpy
(the pattern's rules on character classes, which are asked from the library), the pre-tokens
are dictionary-encoded by Arrow, and the ``tokenizers`` library encodes the distinct ones.
"""

from __future__ import annotations

import os
from itertools import chain, islice
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, DIGIT, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
_CLASS = np.full(0x110000, UNKNOWN, dtype=np.uint8)
_ASCII = np.full(256, UNKNOWN, dtype=np.uint8)   # of ASCII bytes; other bytes get their character's
#: fixed values: letters that end a contraction after an apostrophe
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_LOADED: dict[str, "PretokenEncoder"] = {}
CACHE = 500_000   # pre-tokens remembered by a worker


def _class_of(points: np.ndarray) -> None:
    """Ask the library for the classes of code points not seen before."""
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for c in points.tolist():
        ch = chr(c)
        for kind, probe in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")):
            if len(split(probe + ch)) == 1:
                _CLASS[c] = kind
                break
        else:
            _CLASS[c] = SPACE


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Character class of every byte of UTF-8 text; the bytes of one character share it."""
    if _ASCII[0] == UNKNOWN:
        _class_of(np.arange(128))
        _ASCII[:128] = _CLASS[:128]
    kind = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.r_[data, np.zeros(3, np.uint8)].astype(np.uint32)
        size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        point = np.where(size == 2, padded[lead] & 0x1F, np.where(size == 3, padded[lead] & 0x0F, padded[lead] & 0x07))
        for k in (1, 2, 3):
            point = np.where(size > k, (point << 6) | (padded[lead + k] & 0x3F), point)
        got = _CLASS[point]
        if (got == UNKNOWN).any():
            _class_of(np.unique(point[got == UNKNOWN]))
            got = _CLASS[point]
        kind[lead] = got
        for k in (1, 2, 3):
            more = size > k
            kind[lead[more] + k] = got[more]
    return kind


def pretoken_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """True where a pre-token starts.  ``data``: the UTF-8 bytes of all texts in a row."""
    n = len(data)
    kind = byte_classes(data)
    begins = np.zeros(n + 1, dtype=bool)
    begins[text_starts[text_starts < n]] = True
    begins[n] = True
    inside = ~begins[1:n]                             # byte i + 1 is in the text of byte i
    run = begins[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = (data[:-1] == 0x20) & inside
    start = run & ~(~space & after_blank)             # one blank goes with what follows
    # the last white-space character before something else stands alone or goes with it
    ends = np.flatnonzero(space[:-1] & ~space[1:] & inside)
    back = ends.copy()
    for _ in range(3):
        back = np.where((data[back] & 0xC0) == 0x80, back - 1, back)
    start[back] = True
    quote = np.flatnonzero((data == 0x27) & run & ~after_blank)
    if len(quote):
        padded = np.r_[data, np.zeros(2, np.uint8)]
        for end in _ENDINGS:
            k = len(end)
            ok = np.ones(len(quote), dtype=bool)
            for j, ch in enumerate(end):
                at = quote + 1 + j
                ok &= (padded[at] == ord(ch)) & ~begins[np.minimum(at, n)]
            hit = quote[ok]
            start[hit + 1] = False
            more = hit + 1 + k
            more = more[more < n]
            start[more] |= kind[more] == LETTER
    return start


def _byte_letters() -> dict[int, str]:
    """The character by which the library writes each byte, asked from the library."""
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    probes = [*range(0x800), *((k << 12) | 0x800 for k in range(13)), *((k << 12) for k in (14, 15)), 0xD000,
              *(k << 18 if k else 0x10000 for k in range(5))]
    letters: dict[int, str] = {}
    for ch in map(chr, probes):
        letters |= dict(zip(ch.encode(), "".join(t for t, _ in split(ch)), strict=True))
    return letters


class PretokenEncoder:
    """Encodes with the byte-level BPE tokenizer of a ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        if not isinstance(self.library.pre_tokenizer, pre_tokenizers.ByteLevel) or self.library.normalizer or \
                not isinstance(self.library.model, models.BPE):
            raise ValueError("a byte-level BPE tokenizer without a normalizer is needed")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.vocabulary = self.library.get_vocab_size()
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as packed unsigned 32-bit numbers."""
        known, tokens, letters = self.known, self.library.model.tokenize, self.letters
        got, new = [], {}
        for w in words:
            ids = known.get(w)
            if ids is None:
                found = [t.id for t in tokens(w.decode("latin-1").translate(letters))]
                new[w] = ids = pack(f"<{len(found)}I", *found)
            got.append(ids)
        if len(known) < CACHE:     # the first words seen stay: frequent ones come early
            known.update(islice(new.items(), CACHE - len(known)))
        return got

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pre-token number of each place, places per text, ids per number, all ids by number)
        of a binary array of UTF-8 texts without nulls."""
        wide = np.int64 if texts.type == pa.large_binary() else np.int32
        starts = np.frombuffer(texts.buffers()[1], dtype=wide)[texts.offset:texts.offset + len(texts) + 1
                                                              ].astype(np.int64)
        data = texts.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]] if data else np.empty(0, np.uint8)
        starts = starts - starts[0]
        at = np.flatnonzero(pretoken_starts(data, starts[:-1])) if len(data) else np.empty(0, np.int64)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(np.r_[at, len(data)]), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        ids = self._encode(coded.dictionary.to_pylist())
        per = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        places = np.diff(np.searchsorted(at, starts))
        return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), places, per,
                np.frombuffer(b"".join(ids), dtype="<u4"))

    def _plain(self, texts: pa.Array) -> bool:
        return not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, number of ids of each text)."""
        if not self._plain(texts):   # a special token's string is cut out before the splitter
            got = [e.ids for e in self.library.encode_batch_fast([t.decode() for t in texts.to_pylist()],
                                                                 add_special_tokens=False)]
            counts = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            return np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(counts.sum())), counts
        number, places, per, flat = self.words(texts)
        size = per[number]
        ends = np.cumsum(size)
        first = np.cumsum(per) - per
        at = np.arange(int(size.sum())) + np.repeat(first[number] - (ends - size), size)
        return flat[at], np.diff(np.r_[0, ends][np.r_[0, np.cumsum(places)]])

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        if not self._plain(texts):
            return self.encode(texts)[1]
        number, places, per, _ = self.words(texts)
        return np.diff(np.r_[0, np.cumsum(per[number])][np.r_[0, np.cumsum(places)]])


def encoder(path: str) -> PretokenEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = PretokenEncoder(path)
    return _LOADED[path]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
