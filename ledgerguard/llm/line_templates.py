"""Line deduplication by a log-template tree.

Lines go down a tree of fixed depth: first by their number of tokens, then by their leading
tokens (a token with a digit is a variable field, ``<*>``).  A line has up to two templates:

* by share: a token is a constant if it stands at its position in at least half of the leaf's
  documents, whole recurring lines included; if that leaves constants in less than
  ``similarity`` of the positions, in a quarter, an eighth and so on (a leaf may hold several
  templates).  So a field of many values stays variable however often each of them occurs, and
  the template is the same in a small and in a large table;
* by count: the masked tokens as they are if they recur as a whole in ``min_docs`` documents,
  else with the tokens that recur at their position in ``min_docs`` documents of the leaf's
  other lines as constants.

Other tokens are generalised to ``<*>``.  A template found in at least ``min_docs`` documents,
with constants in at least ``similarity`` of its positions, recurs: its first occurrence
(smallest key, then line number) stays unless it is a later one of its line's other template,
and all later ones are dropped.  A dropped line always has an earlier one of its template, so
no passage leaves the corpus altogether.  A line with constants in fewer of its positions is
its own template if it recurs with its digits, token by token, in ``min_docs`` documents.

The order of arrival plays no part, unlike in an online template miner: each step is a count
over all documents.  Slices of the documents send the hashes they hold with their document
counts (summed per slice, so a line in a third of all documents is one row a slice) and get
back the ones that recur.  The slices are one exchange of the documents, used three times: to
count leaves and lines, to hand out the *candidates* (lines of a recurring leaf, or that recur
themselves), and to drop.  Constants and templates are counted over the candidates, one
exchange too, so texts are cut into tokens twice, and lines that can have no template are not
met again.  A very long text is lines like any other's; a very long line is one line.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerguard.llm.common import bounded_batches, give_back, shuffle_partitions, without

WILD = "<*>"
_DIGIT = re.compile(r"\d")
NO_KEY = np.iinfo(np.int64).max
LEAF, LINE, CONSTANT, TEMPLATE, EXACT, RAW = range(6)
_MASK, _STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15
_ASK = "kind int, key long, g int, docs long, loose long, doc long, line int"


def masked_tokens(line: str) -> list[str]:
    tokens = line.split()
    if _DIGIT.search(line):
        return [WILD if _DIGIT.search(t) else t for t in tokens]
    return tokens


def _hash(kind: int, *parts: str) -> int:
    h = xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass"), kind)
    return h - (1 << 64) if h >> 63 else h


def leaf_of(tokens: list[str], depth: int) -> int:
    return _hash(LEAF, str(len(tokens)), *tokens[:depth])


def _constant(leaf: int, at: int, token: str) -> int:
    h = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"), (leaf + at * _STEP) & _MASK)
    return h - (1 << 64) if h >> 63 else h


class _Heard:
    """What a slice has heard of the hashes it holds: those that recur, with their documents."""

    def __init__(self, heard: pa.Table | None, depth: int, similarity: float):
        self.depth, self.similarity = depth, similarity
        #: documents of each recurring leaf, line and constant; ``loose``: constants that recur outside recurring lines
        self.known: list[dict[int, int]] = [{}, {}, {}]
        self.loose: set[int] = set()
        self.exact: set[int] = set()
        self.first: dict[int, tuple[int, int]] = {}
        if heard is not None and heard.num_rows:
            kind, keys = heard.column("kind").to_numpy(), heard.column("key").to_numpy()
            docs_of = heard.column("docs").to_numpy()
            self.known = [dict(zip(keys[kind == k].tolist(), docs_of[kind == k].tolist(), strict=True))
                          for k in (LEAF, LINE, CONSTANT)]
            self.exact = set(keys[kind == EXACT].tolist())
            self.loose = set(keys[(kind == CONSTANT) & heard.column("loose").to_numpy(zero_copy_only=False)].tolist())
            at = kind == TEMPLATE
            self.first = dict(zip(keys[at].tolist(), zip(heard.column("doc").to_numpy()[at].tolist(),
                                                         heard.column("line").to_numpy()[at].tolist(), strict=True),
                                  strict=True))

    def exact_of(self, line: str, tokens: list[str]) -> int | None:
        """Hash of the whole line, if its masked tokens are too few constants for a template."""
        few = WILD in tokens and sum(t != WILD for t in tokens) < self.similarity * len(tokens)
        return _hash(EXACT, *line.split()) if few else None

    def steady(self, leaf: int, line: int) -> bool:
        """The line stands in half of its leaf's documents: its tokens all have that share."""
        return 2 * self.known[LINE].get(line, 0) >= self.known[LEAF][leaf]

    def templates(self, tokens: list[str], exact: int | None) -> set[int]:
        """Keys of the line's templates; none if it cannot recur."""
        if exact is not None:       # no template can have enough constants
            return {exact} & self.exact
        leaf = leaf_of(tokens, self.depth)
        size = self.known[LEAF].get(leaf)
        if size is None:
            return set()
        need = max(math.ceil(self.similarity * len(tokens)), 1)
        line = _hash(LINE, *tokens)
        if self.steady(leaf, line):
            return {_hash(TEMPLATE, str(leaf), *tokens)} if sum(t != WILD for t in tokens) >= need else set()
        at = [None if t == WILD else _constant(leaf, i, t) for i, t in enumerate(tokens)]
        docs = [self.known[CONSTANT].get(c, 0) for c in at]
        found = []
        least = sorted(docs, reverse=True)[need - 1]
        if least:
            halvings = 1
            while least << halvings < size:
                halvings += 1
            found.append([t if n << halvings >= size else WILD for t, n in zip(tokens, docs, strict=True)])
        if line in self.known[LINE]:
            found.append(tokens)
        else:
            found.append([t if c in self.loose else WILD for t, c in zip(tokens, at, strict=True)])
        return {_hash(TEMPLATE, str(leaf), *x) for x in found if sum(t != WILD for t in x) >= need}


def _rows(g: int, kind_counts, firsts=None, loose=None, wanted=None) -> pa.Table:
    """``wanted``: the keys the slice has to hear of, None for all."""
    items = [(kind, key, n) for kind, counts in kind_counts for key, n in counts.items()]
    first = [firsts[k] if firsts else (None, None) for _, k, _ in items]
    return pa.table({"kind": pa.array([i[0] for i in items], pa.int32()),
                     "key": pa.array([i[1] for i in items], pa.int64()),
                     "g": pa.array([g if wanted is None or i[1] in wanted else None for i in items], pa.int32()),
                     "docs": pa.array([i[2] for i in items], pa.int64()),
                     "loose": pa.array([loose[i[1]] if loose else 0 for i in items], pa.int64()),
                     "doc": pa.array([f[0] for f in first], pa.int64()),
                     "line": pa.array([f[1] for f in first], pa.int32())})


def _doc_lines(docs: pa.Table, key: str, text: str):
    """(document, line number, line, masked tokens) of every line with a token."""
    keys = docs.column(key).cast(pa.int64()).fill_null(NO_KEY).to_pylist()
    for raw, doc in zip(docs.column(text).to_pylist(), keys, strict=True):
        for n, line in enumerate((raw or "").split("\n")):
            tokens = masked_tokens(line)
            if tokens:
                yield doc, n, line, tokens


def _candidate_lines(candidates: pa.Table):
    columns = (candidates.column(c).to_pylist() for c in ("doc", "line", "words"))
    for doc, n, line in zip(*columns, strict=True):
        yield doc, n, line, masked_tokens(line)


def _ask_lines(make, key: str, text: str):
    def ask(g: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        part = make(None)
        seen: set[tuple[int, int, int]] = set()
        for doc, _, line, tokens in _doc_lines(docs, key, text):
            seen.add((LEAF, leaf_of(tokens, part.depth), doc))
            seen.add((LINE, _hash(LINE, *tokens), doc))
            exact = part.exact_of(line, tokens)
            if exact is not None:
                seen.add((EXACT, exact, doc))
        counts = {LEAF: Counter(), LINE: Counter(), EXACT: Counter()}
        for kind, h, _ in seen:
            counts[kind][h] += 1
        return _rows(g[0].as_py(), counts.items())
    return ask


def _find_candidates(make, key: str, text: str):
    """The lines of a slice that may have a template, each (document, line number, line) once."""
    def find(_, docs: pa.Table, heard: pa.Table) -> pa.Table:
        part = make(heard)
        found: set[tuple[int, int, str]] = set()
        for doc, n, line, tokens in _doc_lines(docs, key, text) if heard.num_rows else ():
            if leaf_of(tokens, part.depth) in part.known[LEAF]:
                found.add((doc, n, line))
            elif part.exact:
                exact = part.exact_of(line, tokens)
                if exact is not None and exact in part.exact:
                    found.add((doc, n, line))
        g = heard.column("g")[0].as_py() if heard.num_rows else 0
        return pa.table({"g": pa.array([g] * len(found), pa.int32()), "doc": pa.array([f[0] for f in found], pa.int64()),
                         "line": pa.array([f[1] for f in found], pa.int32()), "words": pa.array([f[2] for f in found], pa.string())})
    return find


def _ask_constants(make):
    def ask(_, candidates: pa.Table, heard: pa.Table) -> pa.Table:
        part = make(heard)
        seen: set[tuple[int, int]] = set()
        loose: set[tuple[int, int]] = set()
        wanted: set[int] = set()
        of_line: dict[int, list[int]] = {}      # constants of recurring lines
        for doc, _, _, tokens in _candidate_lines(candidates):
            leaf = leaf_of(tokens, part.depth)
            if leaf not in part.known[LEAF]:
                continue
            line = _hash(LINE, *tokens)
            found = of_line.get(line)
            if found is None:
                found = [_constant(leaf, i, t) for i, t in enumerate(tokens) if t != WILD]
                if not part.steady(leaf, line):
                    wanted.update(found)
                if line in part.known[LINE]:
                    of_line[line] = found
            (seen if line in part.known[LINE] else loose).update([(c, doc) for c in found])
        g = heard.column("g")[0].as_py() if heard.num_rows else 0
        own = Counter(h for h, _ in loose)
        loose |= seen
        return _rows(g, [(CONSTANT, Counter(h for h, _ in loose))], loose=own, wanted=wanted)
    return ask


def _ask_templates(make):
    def ask(_, candidates: pa.Table, heard: pa.Table) -> pa.Table:
        part = make(heard)
        seen: set[tuple[int, int]] = set()
        first: dict[int, tuple[int, int]] = {}
        for doc, n, line, tokens in _candidate_lines(candidates):
            for t in part.templates(tokens, part.exact_of(line, tokens)):
                seen.add((t, doc))
                first[t] = min(first.get(t, (doc, n)), (doc, n))
        g = heard.column("g")[0].as_py() if heard.num_rows else 0
        return _rows(g, [(TEMPLATE, Counter(h for h, _ in seen))], first)
    return ask


def _find_gone(make):
    """The candidates that go: a hash of the line tells lines of rows with one key apart."""
    def find(_, candidates: pa.Table, heard: pa.Table) -> pa.Table:
        part = make(heard)
        gone = [(doc, n, _hash(RAW, line)) for doc, n, line, tokens in _candidate_lines(candidates) if part.first
                and any(part.first.get(t, (doc, n)) != (doc, n) for t in part.templates(tokens, part.exact_of(line, tokens)))]
        g = heard.column("g")[0].as_py() if heard.num_rows else 0
        return pa.table({"g": pa.array([g] * len(gone), pa.int32()), "doc": pa.array([x[0] for x in gone], pa.int64()),
                         "line": pa.array([x[1] for x in gone], pa.int32()), "raw": pa.array([x[2] for x in gone], pa.int64())})
    return find


def _drop(key: str, keep: list[str], text: str, with_text: bool):
    def drop(_, docs: pa.Table, gone: pa.Table) -> pa.Table:
        give_back()
        lost: dict[int, dict[int, set[int]]] = {}
        for doc, n, raw in zip(*(gone.column(c).to_pylist() for c in ("doc", "line", "raw")), strict=True):
            lost.setdefault(doc, {}).setdefault(n, set()).add(raw)
        total, dropped, sha, kept = [], [], [], []
        keys = docs.column(key).cast(pa.int64()).fill_null(NO_KEY).to_pylist()
        for raw, doc in zip(docs.column(text).to_pylist(), keys, strict=True):
            out = lost.get(doc)
            if out:
                lines = (raw or "").split("\n")
                left = [x for n, x in enumerate(lines) if n not in out or _hash(RAW, x) not in out[n]]
                total.append(len(lines))
                dropped.append(len(lines) - len(left))
                raw = "\n".join(left) if len(left) < len(lines) else raw
            else:
                total.append((raw or "").count("\n") + 1)
                dropped.append(0)
            sha.append(hashlib.sha256((raw or "").encode("utf-8", "surrogatepass")).hexdigest())
            kept.append(raw)
        cols = {c: pa.array(kept, pa.string()) if c == text and with_text else docs.column(c) for c in keep}
        return pa.table(cols | {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()),
                                "kept_sha256": pa.array(sha, pa.string())})
    return drop


def drop_recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 3, min_docs: int = 5,
                         similarity: float = 0.7, with_text: bool = True) -> DataFrame:
    """``docs`` rows (the text without its dropped lines, or no text unless ``with_text``) with
    n_lines, n_dropped and kept_sha256.

    Lines end at newlines; tokens at white space; lines without a token are kept.  A null text
    is one empty line and stays null; rows with one key count as one document and repeated
    rows get equal results; rows without a key count as one document a slice and come last; a text
    of which all lines go is left empty.  An empty table gives no rows.  Input columns named
    like an output column are replaced.
    """
    docs = without(docs, "n_lines", "n_dropped", "kept_sha256", "__g")
    spark = docs.sparkSession
    bounded_batches(spark)
    n = shuffle_partitions(spark)
    spread = F.when(F.col(key).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key))
    slices = docs.withColumn("__g", F.pmod(spread, F.lit(4 * n)).cast("int")).repartition(n, "__g")

    def make(heard: pa.Table | None) -> _Heard:
        give_back()
        return _Heard(heard, depth, similarity)

    def recurring(asked: DataFrame) -> DataFrame:
        """(g, kind, key, documents, first place) for every slice that holds a recurring hash."""
        got = asked.groupBy("kind", "key").agg(F.sum("docs").alias("docs"), F.sum("loose").alias("loose"),
                                               F.collect_set("g").alias("gs"),
                                               F.min(F.struct("doc", "line")).alias("first"))
        return got.where(F.col("docs") >= min_docs).select(
            F.explode("gs").alias("g"), "kind", "key", "docs", (F.col("loose") >= min_docs).alias("loose"),
            F.col("first.doc").alias("doc"), F.col("first.line").alias("line"))

    by_slice = slices.groupBy("__g")
    lines = recurring(by_slice.applyInArrow(_ask_lines(make, key, text), _ASK))
    candidates = by_slice.cogroup(lines.groupBy("g")).applyInArrow(
        _find_candidates(make, key, text), "g int, doc long, line int, words string").groupBy("g")
    constants = recurring(candidates.cogroup(lines.groupBy("g")).applyInArrow(_ask_constants(make), _ASK))
    heard = lines.unionByName(constants)
    templates = recurring(candidates.cogroup(heard.groupBy("g")).applyInArrow(_ask_templates(make), _ASK))
    gone = candidates.cogroup(heard.unionByName(templates).groupBy("g")).applyInArrow(
        _find_gone(make), "g int, doc long, line int, raw long")
    keep = [c for c in docs.columns if with_text or c != text]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    return by_slice.cogroup(gone.groupBy("g")).applyInArrow(_drop(key, keep, text, with_text), schema)
