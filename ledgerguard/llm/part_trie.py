"""Vector code compression: product codes learned and given over a trie of distinct parts.

Vectors of whole-number components are cut into equal parts; a part position's codebook has up
to ``entries`` entries, and a vector's code is the number of each part's nearest entry.

* *Distinct parts*: equal parts of a position are counted first (partial counts before the
  shuffle, so a part that a third of all vectors share is one row per task), then sorted by
  (position, components) and stored once.
* *Trie*: in that order the parts are the leaves of a lexicographic trie.  A depth-first walk
  keeps, for the path it is on, the distances of the prefix to all entries, summed over the
  components so far; a component that differs from the leaf before starts a new node, which adds
  its own squared differences to its parent's sums.  Leaves with a common prefix share all work
  above the branch.  The walk takes blocks of leaves at a time (numpy), carrying the open path.
* *Leaves* take the arg-min of their sums (ties to the lower number); rounds add up parts times
  their counts per entry, one row per (task, position, entry).  A used entry moves to the mean,
  rounded down; an unused one stays.
* *Codes*: the vectors are read once more; each task walks the trie of its own batch's distinct
  parts, so no part is ever joined back to its vectors.

All sums are exact 64-bit integers.  The driver holds the codebooks (positions x entries x
components numbers).  Defined cases: a null vector, or one with null or non-finite components,
takes no part, nor does one of another length than most (of equally frequent lengths the
shorter) or of a length that the number of parts does not divide; a null id is coded, but never
starts a codebook; repeated rows count and are coded each; fewer vectors than ``entries`` start
shorter codebooks; an empty table gives no rows; columns with clashing names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerguard.llm.common import attach_totals, drop_stored, finite_vectors, store, store_at, whole_components

LEAVES = 2048        # of one step of the walk


class PartTrie:
    """A depth-first walk over sorted (position, part) leaves against (positions, entries,
    width) codebooks."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.path: list[np.ndarray] | None = None     # the open path's sums per depth, (1, entries)
        self.last: tuple[int, np.ndarray] | None = None
        self.nodes = 0

    def walk(self, place: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every leaf, in the order given."""
        found = [self._block(place[i:i + LEAVES], parts[i:i + LEAVES]) for i in range(0, len(parts), LEAVES)]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _block(self, place: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width = parts.shape
        differs = np.ones((n, width + 1), dtype=bool)     # from the leaf before: position, then each component
        differs[1:, 0] = place[1:] != place[:-1]
        differs[1:, 1:] = parts[1:] != parts[:-1]
        if self.last is not None:
            differs[0, 0] = place[0] != self.last[0]
            differs[0, 1:] = parts[0] != self.last[1]
        branches = np.logical_or.accumulate(differs, axis=1)[:, 1:]   # a new node at this depth
        above, at = None, np.zeros(n, dtype=np.int64)
        path = []
        for depth in range(width):
            new = np.flatnonzero(branches[:, depth])
            own = parts[new, depth][:, None] - self.books[place[new], :, depth]
            own *= own
            if above is not None:
                own += above[at[new]]
            carried = self.path[depth] if self.path is not None else np.zeros((1, self.books.shape[1]), dtype=np.int64)
            above = np.concatenate([carried, own])
            at = np.cumsum(branches[:, depth])                         # node 0 is the carried path's
            path.append(above[-1:])
            self.nodes += len(new)
        self.path, self.last = path, (int(place[-1]), parts[-1].copy())
        entry = above.argmin(axis=1)[at]                               # once a node; the first of equals
        return entry, above[at, entry]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.ListArray:
    n, d = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(values.reshape(-1), pa.int64()))


def _round_task(books: np.ndarray):
    """Sums and counts per (position, entry) of one task's leaves."""
    places, entries, width = books.shape
    kind = pa.schema([("place", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64())), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((places * entries, width), dtype=np.int64), np.zeros(places * entries, dtype=np.int64)
        trie = PartTrie(books)
        for b in batches:
            if not b.num_rows:
                continue
            place, weight = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "n"))
            parts = _matrix(b.column("part"), width)
            slot = place * entries + trie.walk(place, parts)[0]
            np.add.at(sums, slot, parts * weight[:, None])
            np.add.at(counts, slot, weight)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used // entries, pa.int32()), pa.array(used % entries, pa.int32()),
                                              _lists(sums[used]), pa.array(counts[used])], schema=kind)
    return run


def _code_task(books: np.ndarray):
    """(id, label, code, error) of vectors, by the trie of each batch's distinct parts."""
    places, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), places * width).reshape(b.num_rows * places, width)
            place = np.tile(np.arange(places), b.num_rows)
            order = np.lexsort((*x.T[::-1], place))
            entry, gap = PartTrie(books).walk(place[order], x[order])
            codes, errors = np.empty(len(order), dtype=np.uint8), np.empty(len(order), dtype=np.int64)
            codes[order], errors[order] = entry, gap
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([text[i:i + 2 * places] for i in range(0, len(text), 2 * places)]),
                 pa.array(errors.reshape(b.num_rows, places).sum(axis=1))], names=["id", "label", "code", "error"])
    return run


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """(place, part, n): the distinct parts of every position and how many vectors have them, in
    the trie's order."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("x", p * width + 1, width))
    each = rows.select(F.posexplode(cut).alias("place", "part"))
    counted = each.groupBy("place", "part").agg(F.count("*").alias("n"))
    return counted.repartitionByRange("place", "part").sortWithinPartitions("place", "part")


def start_books(rows: DataFrame, parts: int, width: int, entries: int) -> np.ndarray:
    """(positions, entries, width): the parts of the vectors with the smallest ids."""
    first = rows.where("id is not null").orderBy("id", "x").select("x").limit(entries).collect()
    return np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()


def compress_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                     parts: int = 16, entries: int = 64, rounds: int = 2, steps: int = 256) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    found = finite_vectors(vectors, key, vector, F.col(label).alias("label"))
    common = found.groupBy(F.size("v").alias("d")).count().where(F.col("d") > 0).orderBy(F.desc("count"), "d").limit(1).collect()
    size = common[0]["d"] if common else 0
    rows = whole_components(found.where(F.size("v") == (size if size % parts == 0 else -1)), steps)
    rows = rows.select("id", "label", "x")
    width = size // parts
    books = start_books(rows, parts, width, entries) if size and size % parts == 0 else np.zeros((parts, 0, 0))
    if not books.size:
        kind = vectors.schema[label].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long, label_error long, "
                                         "codebooks_sha256 string").withColumnRenamed("vec_id", key)
    leaves, at = store_at(distinct_parts(rows, parts, width), "vector-parts")
    for _ in range(rounds):
        sums = leaves.mapInArrow(_round_task(books), "place int, entry int, sums array<long>, n long")
        totals = (sums.select("place", "entry", "n", F.posexplode("sums").alias("i", "s")).groupBy("place", "entry", "i")
                  .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())
        moved = books.copy()                           # positions x entries x width totals at most
        for t in totals:
            moved[t["place"], t["entry"], t["i"]] = int(t["s"]) // t["n"]
        books = moved
    drop_stored(spark, at)
    kind = vectors.schema[label].dataType.simpleString()
    coded = store(rows.mapInArrow(_code_task(books), f"id long, label {kind}, code string, error long"), "vector-codes")
    per = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    out = attach_totals(coded, "label", per, "id")
    return out.select(F.col("id").alias(key), "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
