"""Language identification by segmentation-marginalised unigram models.

Each language has a probability for every piece of a fixed public byte-level vocabulary.  A
word (white space between words counts as one blank before it) has the summed probability of
*all* its segmentations into pieces, from a forward pass; a text the product over its words.

* Training: word counts of a hash sample of the labelled rows (documented bounds: about
  ``per_language`` documents of each of the ``max_languages`` most frequent languages), then
  expectation maximisation per language: forward and backward passes give the expected count of
  every piece over all segmentations.  Words are cut at the same white space as in scoring.
* Scoring: a batch's words are dictionary-encoded, each distinct word gets its forward
  score under all languages once, and texts add up their words' scores.

The models are languages x vocabulary numbers, which bounds the broadcast.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerguard.llm.common import bounded_batches, give_back, pieces_by_bytes, without
from ledgerguard.llm.lattice import Lattice, Trie, flat_bytes

UNKNOWN = "und"
WORD_BLOCK = 10_000
#: white space as Arrow's and Python's splitting know it
WHITE_SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
_TRIES: dict[str, tuple[Trie, list[bytes]]] = {}


def byte_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 bytes and rank per line)."""
    with open(path, "rb") as f:
        return sorted(base64.b64decode(line.split()[0]) for line in f if line.strip())


def vocabulary_trie(path: str) -> tuple[Trie, list[bytes]]:
    """One trie of the whole vocabulary per worker process."""
    if path not in _TRIES:
        pieces = byte_pieces(path)
        _TRIES[path] = (Trie(pieces), pieces)
    return _TRIES[path]


def _with_blank(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, starts = flat_bytes(words)
    sizes = np.diff(starts)
    out = np.full(len(flat) + len(sizes), 0x20, dtype=np.uint8)
    out[np.arange(len(flat)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)] = flat
    return out, starts + np.arange(len(starts))


def held_out(key: str) -> Column:
    """Documents that models never learn from: crc32 of the key as text divisible by 5 (or no key)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_pieces(words: pa.Array, counts: np.ndarray, trie: Trie, pieces: int, rounds: int, smooth: float,
               block: int = WORD_BLOCK) -> np.ndarray:
    """Log probabilities of the pieces by expectation maximisation over word counts, a block of
    words at a time (the edges of a block stay in memory)."""
    logp = np.full((pieces, 1), -np.log(pieces))
    for _ in range(rounds):
        expected = np.full(pieces, smooth)
        for a in range(0, len(words), block):
            lattice = Lattice(trie, *_with_blank(words.slice(a, block)))
            alpha, beta = lattice.forward_sum(logp), lattice.backward_sum(logp)
            total = alpha[lattice.last][:, 0]
            share = np.exp(alpha[lattice.start, 0] + logp[lattice.piece, 0] + beta[lattice.end, 0] - total[lattice.word])
            expected += np.bincount(lattice.piece, weights=share * counts[a:a + block][lattice.word], minlength=pieces)
            give_back()
        logp = np.log(expected / expected.sum())[:, None]
    return logp[:, 0]


def train(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = 1500, max_words: int = 150_000, max_languages: int = 200, rounds: int = 4, smooth: float = 0.02
          ) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities (pieces, languages)).

    Learns only from rows with a text, a language and a key whose crc32 is not divisible by 5.
    Bounds of the sample: the ``max_languages`` most frequent values of ``lang`` are learned; a
    hash threshold takes about ``per_language`` documents of each (all, if there are fewer) and
    the ``max_words`` most frequent words of each.
    """
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(key))
    common = usable.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(max_languages)
    sizes = {r[0]: r[1] for r in common.collect()}
    if not sizes:
        return [], np.zeros((0, 0))
    share = docs.sparkSession.createDataFrame([(k, min(1.0, per_language / n)) for k, n in sorted(sizes.items())],
                                              "__lang string, __share double")
    unit = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = usable.join(F.broadcast(share), F.col(lang) == F.col("__lang")).where(unit < F.col("__share"))
    words = (sample.select("__lang", F.explode(F.split(F.col(text), WHITE_SPACE)).alias("w")).where("w <> ''")
             .groupBy("__lang", "w").count())
    rank = Window.partitionBy("__lang").orderBy(F.desc("count"), "w")
    words = words.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= max_words)

    def fit(group: pa.Table) -> pa.Table:
        trie, pieces = vocabulary_trie(vocabulary)
        group = group.sort_by("w")
        word = group.column("w").combine_chunks().cast(pa.large_binary())
        logp = fit_pieces(word, group.column("count").to_numpy(), trie, len(pieces), rounds, smooth)
        return pa.table({"lang": group.column("__lang").slice(0, 1), "logp": pa.array([logp.tolist()])})

    rows = words.drop("r").groupBy("__lang").applyInArrow(fit, "lang string, logp array<double>").collect()
    models = sorted((r["lang"], r["logp"]) for r in rows)   # languages x vocabulary numbers
    return [m[0] for m in models], np.array([m[1] for m in models]).T


class Scorer:
    def __init__(self, vocabulary: str, langs: list[str], logp: np.ndarray):
        self.trie, _ = vocabulary_trie(vocabulary)
        self.langs, self.logp = langs, np.ascontiguousarray(logp)

    def word_scores(self, words: pa.Array, block: int = WORD_BLOCK) -> np.ndarray:
        """Forward scores, a block of words at a time (the edges of a block stay in memory)."""
        out = [np.empty((0, self.logp.shape[1]))]
        for a in range(0, len(words), block):
            lattice = Lattice(self.trie, *_with_blank(words.slice(a, block)))
            out.append(lattice.forward_sum(self.logp)[lattice.last])
        return np.concatenate(out)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, posterior) of each text of a string array without nulls."""
        split = pc.utf8_split_whitespace(texts)
        words = split.flatten()
        counts = np.diff(split.offsets.to_numpy())
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        number = coded.indices.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(texts)), counts)
        letters = pc.match_substring_regex(distinct, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        lettered = np.zeros(len(texts), dtype=bool)
        lettered[doc[letters[number]]] = True
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores = self.word_scores(distinct.cast(pa.large_binary()))
        total = np.stack([np.bincount(doc, weights=scores[number, k], minlength=len(texts))
                          for k in range(len(self.langs))], axis=1)
        best = total.argmax(axis=1)
        posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)],
                np.where(lettered, posterior, 0.0))


def identify(docs: DataFrame, vocabulary: str, text: str = "text", model: tuple[list[str], np.ndarray] | None = None,
             keep_text: bool = True, **training) -> DataFrame:
    """``docs`` rows with lang_pred and score (posterior of the language, 0 to 1).

    ``und`` and score 0 for a null text, a text without a letter, or if there is nothing to
    learn from.  Ties go to the first language in order.  A very long text is scored whole.  Only the text is an input of a
    prediction.  Repeated rows get equal results; an empty table gives no rows.  Input
    columns named like an output column are replaced.
    """
    bounded_batches(docs.sparkSession)
    langs, logp = model or train(docs, vocabulary, text=text, **training)
    docs = without(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast((langs, logp.astype(np.float64)))
    at = docs.columns.index(text)
    keep = [i for i, c in enumerate(docs.columns) if keep_text or i != at]
    schema = T.StructType([*(docs.schema[i] for i in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(vocabulary, *shared.value)
        for batch in pieces_by_bytes(batches, at, 4 << 20):
            col = batch.column(at).fill_null("")
            lang, score = scorer.predict(col)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(lang, pa.string()),
                                              pa.array(score, pa.float64())], names=schema.names)

    return docs.mapInArrow(predict, schema)
