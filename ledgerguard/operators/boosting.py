"""Gradient-boosted trees for the learned score (M2, M3, M8) as Spark passes over binned rows.

All calibration folds are trained side by side: one pass over the rows gives, for every fold
and every open leaf of its current tree, the gradient, curvature and row counts per feature
and bin, so a boosting round is at most as many passes as its trees have levels, however many
folds there are.

* Bins are cut once, at quantiles of the labelled rows; a row is one byte per feature.  Rows
  lie in blocks of ``BLOCK_ROWS``, ordered by a hash of their id, kept by Spark with each fold's
  margins.  A block is an RDD element: a round's passes need no new plan, and planning each of
  the 1,000 and more passes of a training would cost more than the pass itself.
* Features of few bins share a column of codes (``Layout``): a pass counts each code once and takes
  the sums per feature from that.  Of two sibling leaves only the smaller is counted; the other is
  their parent's sums less these.
* A pass adds sums up by ranges of features, looks for splits there and returns one candidate per
  leaf and range, so what reaches the driver does not grow with bins or rows. 
* Up to ``FOLD_BLOCKS`` blocks of rows
  and ``FOLD_CELLS`` codes there is nothing to add up: each fold's rows have a task, which goes on with the
  next levels and rounds itself, ``ROUNDS_A_JOB`` to a job, and keeps its rows by leaf (``Leaves``), so
  that a level reads only the leaves it divides and counts, a row's codes lying side by side (by column,
  several features together, for the root and for dividing leaves); steps and sums are the same. From
  2 x ``PART_ROWS`` rows on the task forks processes for parts of the rows, one for each core that the
  folds leave idle (``Parts``); what they send is a level's sums.
* A row's leaf is found without walking: per feature and bin a tree has one bit mask of the leaves
  still possible, and their conjunction is the leaf (``Masks``; trees of up to 64 leaves).
* Margins move once a round, in the first pass of the next round, and are checkpointed to the
  shared folder every ``CHECKPOINT_ROUNDS`` rounds; a lost executor costs the rounds since then.

A leaf's value is the regularised Newton step -G / (H + l2), as in second-order boosting; a split
needs ``min_leaf`` rows on both sides.  Trees grow level by level to ``max_depth`` or
``max_leaves``: where fewer leaves are left than could be split, the largest gains go first.
"""

from __future__ import annotations

import multiprocessing
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ledgerguard.session import ensure_checkpoint_dir

BLOCK_ROWS = 1_000_000
#: blocks may be this small where there are cores for more of them
LEAST_BLOCK_ROWS = 50_000
#: blocks of rows, and codes (rows x columns, two bytes each), up to which a fold is one task's
FOLD_BLOCKS = 24
FOLD_CELLS = 300_000_000
#: a fold of twice as many rows or more is in parts, on the cores that have no fold
PART_ROWS = 200_000
#: ranges of features whose sums are added up and searched apart
RANGES = 4
#: rows taken up at once: their codes and weights stay in the CPU's cache, and no large array is made anew
ROWS_AT_ONCE = 32768
#: features share a column of codes up to so many codes
SHARED_CODES = 512
#: and up to so many where the sums are of all rows of a fold
WHOLE_CODES = 8192
CHECKPOINT_ROUNDS = 50
ROUNDS_A_JOB = 50
#: deepest tree where only the number of leaves is limited
ANY_DEPTH = 16
MIN_CURVATURE = 1e-3


@dataclass
class Tree:
    """Node k sends a row left if its ``feature`` is at most ``cut``; feature -1 is a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut_bin: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut_bin: int, cut: float, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        kids = (len(self.feature), len(self.feature) + 1)
        self.feature[node], self.cut_bin[node], self.cut[node], self.gain[node] = feature, cut_bin, cut, gain
        self.left[node], self.right[node] = kids
        for v in values:
            for column, x in ((self.feature, -1), (self.cut_bin, 0), (self.cut, 0.0), (self.left, 0), (self.right, 0),
                              (self.value, v), (self.gain, 0.0)):
                column.append(x)
        return kids

    def leaf_of(self, x: np.ndarray, cuts: Sequence[float]) -> np.ndarray:
        """Leaf number of every row of ``x`` (bins with ``cut_bin``, values with ``cut``)."""
        at = np.zeros(len(x), dtype=np.int32)
        if len(self.feature) == 1:
            return at
        feature, limit = np.array(self.feature), np.array(cuts)
        left, right = np.array(self.left, dtype=np.int32), np.array(self.right, dtype=np.int32)
        rows = np.arange(len(x))
        while rows.size:
            node = at[rows]
            inner = feature[node] >= 0
            rows, node = rows[inner], node[inner]
            at[rows] = np.where(x[rows, feature[node]] <= limit[node], left[node], right[node])
        return at

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(x, self.cut)]

    def features(self) -> set[int]:
        return {f for f in self.feature if f >= 0}


class Masks:
    """A tree's leaves by bit masks.  ``places[node]`` is the bin of a node's cut and ``sizes`` the
    number of bins per feature: ``tables[f][bin]`` has the bits of the leaves that a row with this
    bin can still reach, and over all features exactly the row's leaf is left."""

    def __init__(self, tree: Tree, places: Sequence[int], sizes: Sequence[int]) -> None:
        self.nodes: list[int] = []                       # leaves in order, bit k is nodes[k]
        spans: dict[int, tuple[int, int]] = {}

        def number(node: int) -> tuple[int, int]:
            start = len(self.nodes)
            if tree.feature[node] < 0:
                self.nodes.append(node)
            else:
                number(tree.left[node])
                number(tree.right[node])
            spans[node] = (start, len(self.nodes))
            return spans[node]

        number(0)
        self.bits = np.uint16 if len(self.nodes) <= 16 else np.uint64
        whole = (1 << len(self.nodes)) - 1
        self.tables: dict[int, np.ndarray] = {}
        for node, f in enumerate(tree.feature):
            if f < 0:
                continue
            table = self.tables.setdefault(f, np.full(sizes[f], whole, dtype=np.uint64))
            for kid, part in ((tree.right[node], slice(0, places[node] + 1)), (tree.left[node], slice(places[node] + 1, None))):
                lo, hi = spans[kid]
                table[part] &= np.uint64(whole & ~((1 << hi) - (1 << lo)))
        self.tables = {f: t.astype(self.bits) for f, t in sorted(self.tables.items())}
        self.values = np.array([tree.value[n] for n in self.nodes])

    @staticmethod
    def fits(tree: Tree) -> bool:
        return len(tree.feature) < 128                   # up to 64 leaves

    @staticmethod
    def place(bits: np.ndarray) -> np.ndarray:
        """Number of the one bit that is set."""
        if bits.dtype == np.uint16:
            return _BIT_OF[bits]
        return (bits.astype(np.float64).view(np.int64) >> 52) - 1023


_BIT_OF = np.zeros(1 << 16, dtype=np.int64)
_BIT_OF[1 << np.arange(16)] = np.arange(16)


class Walk:
    """Margins of several models on values: a chunk of rows is put into bins once for all trees."""

    CHUNK = 8192

    def __init__(self, models: Sequence[BoostedTrees]) -> None:
        self.models = models
        nodes = [(f, c) for m in models for t in m.trees for f, c in zip(t.feature, t.cut, strict=True) if f >= 0]
        self.cuts = {f: np.unique([c for g, c in nodes if g == f]) for f in {f for f, _ in nodes}}
        at = {f: {c: i for i, c in enumerate(cuts.tolist())} for f, cuts in self.cuts.items()}
        sizes = {f: len(c) + 1 for f, c in self.cuts.items()}
        self.masks = [[Masks(t, [at[f][c] if f >= 0 else 0 for f, c in zip(t.feature, t.cut, strict=True)], sizes)
                       if Masks.fits(t) else None for t in m.trees] for m in models]

    def chunks(self, n: int) -> list[slice]:
        return [slice(i, i + self.CHUNK) for i in range(0, n, self.CHUNK)]

    def bins(self, x: np.ndarray) -> dict[int, np.ndarray]:
        return {f: np.searchsorted(c, x[:, f], side="left") for f, c in self.cuts.items()}

    @staticmethod
    def _all(found: list[np.ndarray], n: int) -> np.ndarray:
        bits = found[0]
        for b in found[1:]:
            bits = bits & b
        return bits

    def margins(self, x: np.ndarray) -> list[np.ndarray]:
        """Each model's margin of every row."""
        out = [np.full(len(x), m.base) for m in self.models]
        for rows in self.chunks(len(x)):
            own = x[rows]
            bins = self.bins(own)
            for m, masks, whole in zip(self.models, self.masks, out, strict=True):
                part = whole[rows]
                for tree, mask in zip(m.trees, masks, strict=True):
                    if mask is None:
                        part += tree.margin(own)
                    elif not mask.tables:
                        part += mask.values[0]
                    else:
                        part += mask.values[Masks.place(self._all([t[bins[f]] for f, t in mask.tables.items()], len(own)))]
        return out

    def replaced(self, own: np.ndarray, other: np.ndarray) -> Iterator[list[np.ndarray]]:
        """For each feature in turn, each model's margins with that feature's values from ``other``:
        only the trees that split on it, and of these only that feature's masks, are looked up again."""
        width = own.shape[1]
        base = self.margins(own)
        moved = {f: [m.copy() for m in base] for f in self.cuts}
        for rows in self.chunks(len(own)):
            x, y = own[rows], other[rows]
            bins, else_ = self.bins(x), self.bins(y)
            for k, (m, masks) in enumerate(zip(self.models, self.masks, strict=True)):
                for tree, mask in zip(m.trees, masks, strict=True):
                    if mask is None:
                        before = tree.margin(x)
                        for f in tree.features():
                            z = x.copy()
                            z[:, f] = y[:, f]
                            moved[f][k][rows] += tree.margin(z) - before
                        continue
                    if not mask.tables:
                        continue
                    fs, found = list(mask.tables), [t[bins[f]] for f, t in mask.tables.items()]
                    after = found[:]                     # of this feature and the later ones
                    for i in range(len(fs) - 2, -1, -1):
                        after[i] = found[i] & after[i + 1]
                    before, upto = mask.values[Masks.place(after[0])], None
                    for i, f in enumerate(fs):
                        bits = mask.tables[f][else_[f]]
                        if i + 1 < len(fs):
                            bits = bits & after[i + 1]
                        if upto is not None:
                            bits = bits & upto
                        moved[f][k][rows] += mask.values[Masks.place(bits)] - before
                        upto = found[i] if upto is None else upto & found[i]
        for f in range(width):
            yield moved.get(f, base)


@dataclass
class BoostedTrees:
    base: float
    trees: list[Tree]
    n_features: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        return Walk([self]).margins(x)[0]

    def importance(self) -> np.ndarray:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(self.n_features)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return total / total.sum() if total.sum() > 0 else total


def bounded_rows(df: DataFrame, id_col: str, max_rows: int, seed: int) -> DataFrame:
    """``df``, or about ``max_rows`` of its rows with the smallest seeded hash of their id.
    No query trains on these: ``model.train_scorer`` takes all rows."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit("rows")), F.lit(1 << 32)) < int(max_rows / n * (1 << 32)))


def bin_edges(df: DataFrame, cols: Sequence[str], bins: int = 255) -> list[np.ndarray]:
    """Per column the inner edges (values that occur) of at most ``bins`` bins; a value's bin is
    the number of edges below it."""
    cuts = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).approxQuantile(
        [f"c{i}" for i in range(len(cols))], [k / bins for k in range(1, bins)], 1.0 / (8 * bins))
    return [np.unique(c) for c in cuts]


@dataclass
class Layout:
    """Bins of the features, and the columns of codes they share.  Features of one bin cannot split
    and have no column."""

    edges: list[np.ndarray]
    shared: int = 0                                      # codes a column may have where features share it

    def __post_init__(self) -> None:
        self.sizes = [len(e) + 1 for e in self.edges]
        self.live = [f for f, n in enumerate(self.sizes) if n > 1]
        self.offsets = np.concatenate([[0], np.cumsum([self.sizes[f] for f in self.live])]).astype(int)
        self.columns: list[list[int]] = []
        codes = 0
        for f in sorted(self.live, key=lambda f: (self.sizes[f], f)):
            if self.columns and codes * self.sizes[f] <= (self.shared or SHARED_CODES):
                self.columns[-1].append(f)
                codes *= self.sizes[f]
            else:
                self.columns.append([f])
                codes = self.sizes[f]
        self.codes = [int(np.prod([self.sizes[f] for f in fs])) for fs in self.columns]
        # ranges of live features with about the same number of bins
        n = max(1, min(RANGES, len(self.live)))
        first = np.searchsorted(self.offsets, [self.offsets[-1] * i / n for i in range(n)]).tolist()
        self.ranges = [r for r in zip(first, [*first[1:], len(self.live)], strict=True) if r[0] < r[1]]

    def pack(self, bins: list[np.ndarray]) -> np.ndarray:
        """Codes (columns x rows) from the bins per feature."""
        out = np.zeros((len(self.columns), len(bins[0])), dtype=np.uint16)
        for column, fs in zip(out, self.columns, strict=True):
            stride = 1
            for f in fs:
                column += bins[f].astype(np.uint16) * np.uint16(stride)
                stride *= self.sizes[f]
        return out

    def wider(self, x: np.ndarray) -> tuple[Layout, np.ndarray]:
        """The layout with up to ``WHOLE_CODES`` codes to a column, and its codes (columns x rows) from
        this layout's by row: sums over all rows are then of fewer columns."""
        wide = Layout(self.edges, WHOLE_CODES)
        at = {f: (c, int(np.prod([self.sizes[g] for g in fs[:fs.index(f)]]))) for c, fs in enumerate(self.columns) for f in fs}
        out = np.zeros((len(wide.columns), len(x)), dtype=np.uint16)
        for i in range(0, len(x), ROWS_AT_ONCE):
            some = slice(i, i + ROWS_AT_ONCE)
            codes = x[some].T.copy()
            for column, fs in zip(out[:, some], wide.columns, strict=True):
                stride = 1
                for f in fs:
                    c, own = at[f]
                    column += codes[c] // np.uint16(own) % np.uint16(self.sizes[f]) * np.uint16(stride)
                    stride *= self.sizes[f]
        return wide, out

    def leaves(self, tree: Tree, codes: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(leaf nodes, place in them of every row's leaf)."""
        masks = Masks(tree, tree.cut_bin, self.sizes)
        bits = None
        for fs, n, column in zip(self.columns, self.codes, codes, strict=True):
            table, at = None, np.arange(n)
            for f in fs:
                if f in masks.tables:
                    own = masks.tables[f][at % self.sizes[f]]
                    table = own if table is None else table & own
                at = at // self.sizes[f]
            if table is not None:
                found = table[column]
                bits = found if bits is None else np.bitwise_and(bits, found, out=bits)
        return masks.nodes, np.zeros(codes.shape[1], dtype=np.int64) if bits is None else Masks.place(bits)

    def per_feature(self, c: int, counted: np.ndarray, out: np.ndarray) -> None:
        """Sums per code of column ``c`` (leaves x codes) into ``out`` (leaves x bins)."""
        fs = self.columns[c]
        cube = counted.reshape(len(counted), *[self.sizes[f] for f in reversed(fs)])
        for i, f in enumerate(fs):
            axis = len(fs) - i
            start = self.offsets[self.live.index(f)]
            out[:, start:start + self.sizes[f]] = cube.sum(axis=tuple(a for a in range(1, len(fs) + 1) if a != axis))


def _blocks(df: DataFrame, cols: Sequence[str], label: str, fold: Column, id_col: str, layout: Layout, n_blocks: int) -> RDD:
    """(codes, labels, folds) of the rows in blocks, dealt by the hash of the id."""
    rows = df.select(F.xxhash64(F.col(id_col)).alias("at"), F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"), fold.alias("f"),
                     *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    rows = rows.repartition(n_blocks, "at").sortWithinPartitions("at", "id")
    edges = layout.edges

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, labels, folds = [], [], []
        for b in batches:
            columns = [b.column(f"c{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(edges))]
            if any(np.isnan(c).any() for c in columns):
                raise ValueError("a feature is null or NaN")
            codes.append(layout.pack([np.searchsorted(e, c, side="left") for c, e in zip(columns, edges, strict=True)]))
            labels.append(b.column("y").to_numpy(zero_copy_only=False).astype(np.int8))
            folds.append(b.column("f").to_numpy(zero_copy_only=False).astype(np.int8))
        if codes:
            whole = (np.concatenate(codes, axis=1), np.concatenate(labels), np.concatenate(folds))
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in whole], names=["x", "y", "f"])

    width = len(layout.columns)
    packed = rows.mapInArrow(pack, "x binary, y binary, f binary")
    return packed.rdd.map(lambda r: (np.frombuffer(r["x"], dtype=np.uint16).reshape(width, -1),
                                     np.frombuffer(r["y"], dtype=np.int8), np.frombuffer(r["f"], dtype=np.int8)))


def _leaf_sums(trees: list[Tree], wanted: list[list[int]], layout: Layout):
    """Sums over a partition's blocks: (3, leaves ``wanted`` of all folds, bins of all features)."""
    def run(blocks) -> Iterator[np.ndarray]:
        out = np.zeros((3, sum(map(len, wanted)), int(layout.offsets[-1])))
        for _, x, y, used, margins in blocks:
            start = 0
            for f, (tree, own) in enumerate(zip(trees, wanted, strict=True)):
                if not own:
                    continue
                nodes, leaf = layout.leaves(tree, x)
                place = np.full(len(tree.feature), -1)
                place[own] = np.arange(len(own))
                at = place[nodes][leaf]
                rows = np.flatnonzero(used[f] & (at >= 0))
                at = at[rows]
                p = 1.0 / (1.0 + np.exp(-margins[f][rows]))
                g, h = p - y[rows], p * (1 - p)
                part = np.empty((3, len(own), out.shape[2]))
                for c, n in enumerate(layout.codes):
                    cell = at * n
                    cell += x[c][rows]
                    for into, w in zip(part, (g, h, None), strict=True):
                        layout.per_feature(c, np.bincount(cell, w, len(own) * n).reshape(-1, n), into)
                out[:, start:start + len(own)] += part
                start += len(own)
        yield out
    return run


def _best_splits(sums: np.ndarray, offsets: np.ndarray, min_leaf: int, l2: float):
    """Per leaf (gain, feature, bin, (G, H, rows) left, (G, H, rows) right) of its best split, or None."""
    feature = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    run = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((3, sums.shape[1], 1)), run], axis=2)[:, :, offsets[:-1]]
    whole = run[:, :, offsets[1:] - 1] - before                       # per leaf and feature
    left = run - before[:, :, feature]
    right = whole[:, :, feature] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2)
                - (whole[0] ** 2 / (whole[1] + l2))[:, feature])
    fits = (np.minimum(left[2], right[2]) >= min_leaf) & (np.minimum(left[1], right[1]) >= MIN_CURVATURE)
    gain = np.where(fits, gain, -1.0)
    # the first of equal gains: sums of other blocks or orders differ in their last places
    top = gain.max(axis=1, keepdims=True)
    at = (gain >= top - 1e-9 * np.abs(top)).argmax(axis=1)
    out = []
    for leaf, b in enumerate(at.tolist()):
        g = float(gain[leaf, b])
        out.append(None if g <= 1e-12 else (g, int(feature[b]), b - int(offsets[feature[b]]),
                                            left[:, leaf, b], right[:, leaf, b]))
    return out


def _moved(layout: Layout, *rounds: dict[int, Tree]):
    """A block after the trees (by model) of these rounds."""
    values = [{f: np.array(t.value) for f, t in trees.items()} for trees in rounds]

    def run(block):
        models, x, y, used, margins = block
        margins = margins.copy()
        for trees, steps in zip(rounds, values, strict=True):
            for m, f in zip(margins, models, strict=True):
                nodes, leaf = layout.leaves(trees[f], x)
                m += steps[f][nodes][leaf]
        return models, x, y, used, margins
    return run


@dataclass
class Level:
    """Open leaves of all folds: those ``counted``, and those that are a leaf of the level before
    less their counted sibling (places in the open leaves, the level before and the counted)."""

    counted: list[list[int]]
    size: int
    direct: list[tuple[int, int]]
    rest: list[tuple[int, int, int]]

    def sums(self, counted: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        out = np.empty((3, self.size, counted.shape[2]))
        if self.direct:
            to, at = map(list, zip(*self.direct, strict=True))
            out[:, to] = counted[:, at]
        if self.rest:
            to, parent, sibling = map(list, zip(*self.rest, strict=True))
            out[:, to] = before[:, parent] - counted[:, sibling]
        return out


@dataclass
class Growth:
    """How trees grow."""

    layout: Layout
    max_depth: int | None
    max_leaves: int
    step_size: float
    min_leaf: int
    l2: float

    def search(self, sums: np.ndarray, features: tuple[int, int]):
        """Best split per leaf within a range of live features, whose sums these are."""
        offsets = self.layout.offsets[features[0]:features[1] + 1]
        found = _best_splits(sums, offsets - offsets[0], self.min_leaf, self.l2)
        return [b and (b[0], self.layout.live[features[0] + b[1]], *b[2:]) for b in found]

    @staticmethod
    def best(found: list[list]) -> list:
        """Per leaf the best of the ranges' candidates; of equal gains the first feature's."""
        out = []
        for candidates in zip(*found, strict=True):
            known = [c for c in candidates if c]
            top = max((c[0] for c in known), default=0.0)
            out.append(min((c for c in known if c[0] >= top - 1e-9 * abs(top)), key=lambda c: c[1], default=None))
        return out

    def round(self, k: int, splits_of) -> list[Tree]:
        """One tree per fold; ``splits_of(trees, level)`` is a pass over the rows: the best split of
        every open leaf, fold by fold."""
        trees, grown, leaves = [Tree() for _ in range(k)], [1] * k, [[0] for _ in range(k)]
        level = Level([[0] for _ in range(k)], k, [(f, f) for f in range(k)], [])
        for _ in range(self.max_depth or ANY_DEPTH):
            best = splits_of(trees, level)
            start = np.cumsum([0, *map(len, leaves)]).tolist()
            level = Level([], 0, [], [])
            n_counted = 0
            for f, tree in enumerate(trees):
                found = sorted(((b, leaf, start[f] + i) for i, (b, leaf) in enumerate(zip(best[start[f]:start[f + 1]], leaves[f], strict=True))
                                if b), key=lambda c: (-c[0][0], c[1]))[:self.max_leaves - grown[f]]
                leaves[f], counted = [], []
                grown[f] += len(found)
                last = grown[f] >= self.max_leaves
                for (gain, feature, b, *sides), leaf, parent in found:
                    steps = tuple(-self.step_size * g / (h + self.l2) for g, h, _ in sides)
                    kids = tree.split(leaf, feature, b, float(self.layout.edges[feature][b]), gain, steps)
                    # a leaf that is too small for two sides stays one
                    open_ = [not last and rows >= 2 * self.min_leaf for _, _, rows in sides]
                    if not any(open_):
                        continue
                    few = 0 if sides[0][2] <= sides[1][2] else 1
                    at = n_counted + len(counted)
                    counted.append(kids[few])
                    for side in (0, 1):
                        if open_[side]:
                            if side == few:
                                level.direct.append((level.size, at))
                            else:
                                level.rest.append((level.size, parent, at))
                            level.size += 1
                            leaves[f].append(kids[side])
                level.counted.append(counted)
                n_counted += len(counted)
            if not level.size:
                break
        return trees


def _by_row(codes: np.ndarray) -> np.ndarray:
    """Codes (columns x rows) row by row, padded to whole eight bytes: a row is then one or few lines of
    the CPU's cache, and picking rows costs about as much as picking a column's codes."""
    out = np.zeros((codes.shape[1], -(-len(codes) // 4) * 4), dtype=np.uint16)
    out[:, :len(codes)] = codes.T
    return out


class Leaves:
    """The rows of a tree's leaves, in their order; ``x`` has their codes by row (``_by_row``) and ``whole``
    the codes of the features' larger groups by column (``Layout.wider``), or nothing."""

    def __init__(self, layout: Layout, x: np.ndarray, whole: tuple[Layout, np.ndarray] | None = None) -> None:
        self.layout, self.x = layout, x
        self.order, self.spare = np.arange(len(x)), np.empty(len(x), dtype=np.intp)
        self.start()
        self.wide, self.whole = whole or (layout, x[:, :len(layout.columns)].T)
        self.place = {}                                  # feature: (its column, stride in the codes)
        for c, fs in enumerate(self.wide.columns):
            stride = 1
            for f in fs:
                self.place[f] = (c, stride)
                stride *= layout.sizes[f]

    def start(self) -> None:
        """All rows in the root, for another tree."""
        self.order[:] = np.arange(len(self.x))
        self.rows: dict[int, np.ndarray] = {0: self.order}    # parts of ``order``

    def follow(self, tree: Tree) -> None:
        """Divide the leaves that were split since."""
        for node in [n for n in self.rows if tree.feature[n] >= 0]:
            rows, f, cut = self.rows.pop(node), tree.feature[node], tree.cut_bin[node]
            c, stride = self.place[f]
            goes, codes = np.arange(self.wide.codes[c]) // stride % self.layout.sizes[f] <= cut, self.whole[c]
            n_left = n_right = 0
            for i in range(0, len(rows), ROWS_AT_ONCE):       # left rows move up in place
                some = rows[i:i + ROWS_AT_ONCE]
                left = goes.take(codes.take(some))
                right, some = some.compress(~left), some.compress(left)
                rows[n_left:n_left + len(some)] = some
                self.spare[n_right:n_right + len(right)] = right
                n_left, n_right = n_left + len(some), n_right + len(right)
            rows[n_left:] = self.spare[:n_right]
            self.rows[tree.left[node]], self.rows[tree.right[node]] = rows[:n_left], rows[n_left:]

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """Codes (columns x rows) of these rows."""
        return self.x.view(np.uint64).take(rows, axis=0).view(np.uint16)[:, :len(self.layout.columns)].T

    def _pieces(self, nodes: list[int]) -> Iterator[tuple[int | np.ndarray, np.ndarray]]:
        """(place in ``nodes``, rows): a large leaf alone, small ones together, with the place of each row."""
        small = [i for i, n in enumerate(nodes) if len(self.rows[n]) < ROWS_AT_ONCE]
        yield from ((i, self.rows[n]) for i, n in enumerate(nodes) if len(self.rows[n]) >= ROWS_AT_ONCE)
        if small:
            yield np.repeat(small, [len(self.rows[nodes[i]]) for i in small]), np.concatenate([self.rows[nodes[i]] for i in small])

    def sums(self, nodes: list[int], weights: Sequence[np.ndarray]) -> np.ndarray:
        """(3, ``nodes``, bins of all features): sums of both weights and rows."""
        if not nodes:
            return np.zeros((3, 0, int(self.layout.offsets[-1])))
        both = np.empty(len(self.x), dtype=np.complex128)
        both.real, both.imag = weights
        return self.sums_of(nodes, both)

    def sums_of(self, nodes: list[int], both: np.ndarray) -> np.ndarray:
        """The same of the weights as the two parts of a complex number."""
        root = nodes == [0] and len(self.rows) == 1
        layout = self.wide if root else self.layout
        added = [np.zeros((len(nodes), n), dtype=np.complex128) for n in layout.codes]
        counts = [np.zeros((len(nodes), n), dtype=np.int64) for n in layout.codes]
        cells, ones = np.empty(ROWS_AT_ONCE, dtype=np.intp), np.ones(ROWS_AT_ONCE, dtype=np.int64)
        for leaf, rows in [(0, None)] if root else self._pieces(nodes):
            for i in range(0, len(self.x) if root else len(rows), ROWS_AT_ONCE):
                some = slice(i, i + ROWS_AT_ONCE)
                codes, steps = (self.whole[:, some], both[some]) if root else (self.columns(rows[some]), both.take(rows[some]))
                cell, one = cells[:len(steps)], ones[:len(steps)]
                for column, n, g, c in zip(codes, layout.codes, added, counts, strict=True):
                    if isinstance(leaf, int):
                        cell[:] = column
                        g, c = g[leaf], c[leaf]
                    else:
                        np.multiply(leaf[some], n, out=cell)
                        cell += column
                        g, c = g.reshape(-1), c.reshape(-1)
                    np.add.at(g, cell, steps)
                    np.add.at(c, cell, one)
        out = np.empty((3, len(nodes), int(self.layout.offsets[-1])))
        for k, (g, c) in enumerate(zip(added, counts, strict=True)):
            for into, own in zip(out, (g.real, g.imag, c), strict=True):
                layout.per_feature(k, own, into)
        return out


class FoldRows:
    """Rows of a fold's model, or a part of them: their leaves, steps (gradient and curvature) and margins."""

    def __init__(self, layout: Layout, x: np.ndarray, y: np.ndarray, margins: np.ndarray) -> None:
        self.leaves, self.y, self.margins = Leaves(layout, x, layout.wider(x)), y, margins.copy()
        self.steps = np.empty(len(y), dtype=np.complex128)

    def start(self) -> None:
        """Another round."""
        self.leaves.start()
        for i in range(0, len(self.y), ROWS_AT_ONCE):
            some = slice(i, i + ROWS_AT_ONCE)
            p = 1.0 / (1.0 + np.exp(-self.margins[some]))
            self.steps.real[some], self.steps.imag[some] = p - self.y[some], p * (1 - p)

    def sums(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        self.leaves.follow(tree)
        return self.leaves.sums_of(nodes, self.steps)

    def end(self, tree: Tree) -> None:
        """The round's tree is grown."""
        self.leaves.follow(tree)
        for node, rows in self.leaves.rows.items():
            for i in range(0, len(rows), ROWS_AT_ONCE):
                self.margins[rows[i:i + ROWS_AT_ONCE]] += tree.value[node]

    def moved(self) -> np.ndarray:
        return self.margins


def _answer(conn, others: list, layout: Layout, *rows: np.ndarray) -> None:
    """A part's process: calls of ``FoldRows`` until the task hangs up."""
    for c in others:                                      # or the task's end would not be noticed
        c.close()
    own = FoldRows(layout, *rows)
    while True:
        try:
            name, args = conn.recv()
        except EOFError:
            return
        try:
            conn.send((getattr(own, name)(*args), None))
        except Exception as e:  # noqa: BLE001
            conn.send((None, f"{type(e).__name__}: {e}"))


class Parts:
    """A fold's rows in ``n`` parts, each but the first with a process forked by the task: there are
    fewer folds than cores, and the cores without a fold would stand idle."""

    def __init__(self, layout: Layout, x: np.ndarray, y: np.ndarray, margins: np.ndarray, n: int) -> None:
        cut = [len(y) * i // n for i in range(n + 1)]
        part = lambda i: (a[cut[i]:cut[i + 1]] for a in (x, y, margins))
        fork = multiprocessing.get_context("fork")
        self.conns, self.processes = [], []
        for i in range(1, n):
            here, there = fork.Pipe()
            self.conns.append(here)
            self.processes.append(fork.Process(target=_answer, args=(there, list(self.conns), layout, *part(i)), daemon=True))
            self.processes[-1].start()
            there.close()
        self.first = FoldRows(layout, *part(0))

    def __enter__(self) -> Parts:
        return self

    def __exit__(self, *_) -> None:
        for c in self.conns:
            c.close()
        for p in self.processes:
            p.join(5)
            if p.is_alive():
                p.terminate()
                p.join()

    def call(self, name: str, *args) -> list:
        """What each part answers, in order."""
        for c in self.conns:
            c.send((name, args))
        out = [getattr(self.first, name)(*args)]
        for c in self.conns:
            answer, error = c.recv()
            if error:
                raise RuntimeError(error)
            out.append(answer)
        return out


def _rounds_of_a_fold(growth: Growth, rounds: int, cores: int = 1):
    """(fold, codes by row, labels, new margins) and the trees of these rounds, from all rows of a fold's model."""
    def run(folds) -> Iterator[tuple]:
        for f, x, y, margins in folds:
            own, sums = [], None
            with Parts(growth.layout, x, y, margins, max(1, min(cores, len(y) // PART_ROWS))) as parts:
                for _ in range(rounds):
                    parts.call("start")

                    def splits_of(trees: list[Tree], level: Level):
                        nonlocal sums
                        sums = level.sums(sum(parts.call("sums", trees[0], level.counted[0])), sums)  # noqa: B023
                        return growth.search(sums, (0, len(growth.layout.live)))

                    own += growth.round(1, splits_of)
                    parts.call("end", own[-1])
                margins = np.concatenate(parts.call("moved"))
            yield (f, x, y, margins), own
    return run


def _train_by_fold(blocks: RDD, growth: Growth, models: list[BoostedTrees], max_iter: int, cores: int) -> None:
    """All rounds of each fold's model by a task of its own on up to ``cores`` cores; ``models`` get their trees."""
    k, base = len(models), [m.base for m in models]

    def deal(no: int, own) -> Iterator[tuple]:
        for codes, labels, folds in own:                  # one block to a partition
            for f in range(k):
                used = folds != f
                yield f, (no, codes[:, used], labels[used])

    def assemble(f: int, dealt) -> Iterator[tuple]:
        own = sorted((r for _, r in dealt), key=lambda r: r[0])
        y = np.concatenate([r[2] for r in own])
        yield f, np.concatenate([_by_row(r[1]) for r in own]), y, np.full(len(y), base[f])

    state = blocks.mapPartitionsWithIndex(deal).partitionBy(k, int).mapPartitionsWithIndex(assemble)
    done, kept = 0, None
    while done < max_iter:
        rounds = min(ROUNDS_A_JOB, max_iter - done)
        grown = state.mapPartitions(_rounds_of_a_fold(growth, rounds, cores)).persist(StorageLevel.MEMORY_AND_DISK)
        if done // CHECKPOINT_ROUNDS != (done + rounds) // CHECKPOINT_ROUNDS:
            grown.checkpoint()
        own = dict(grown.map(lambda b: (b[0][0], b[1])).collect())
        if kept is not None:
            kept.unpersist()
        kept, state, done = grown, grown.map(lambda b: b[0]), done + rounds
        learned = [any(len(own[f][i].feature) > 1 for f in own) for i in range(rounds)]
        for f, trees in own.items():
            models[f].trees += [t for t, some in zip(trees, learned, strict=True) if some]
        if not all(learned):                              # nothing left to learn
            break
    if kept is not None:
        kept.unpersist()


def _splits_of_blocks(growth: Growth, state: RDD, spent: list[RDD]):
    """The same over many blocks: sums are added up and searched by ranges of features.  A level's
    sums stay with Spark until the next level is done; ``spent`` has those that may still be kept."""
    layout = growth.layout
    ranges = layout.ranges

    def splits_of(trees: list[Tree], level: Level):
        count = _leaf_sums(trees, level.counted, layout)

        def parts(blocks):
            sums = next(count(blocks))
            for key, (a, b) in enumerate(ranges):
                yield key, np.ascontiguousarray(sums[:, :, layout.offsets[a]:layout.offsets[b]])

        added = state.mapPartitions(parts).reduceByKey(np.add, len(ranges))
        if level.rest:
            sums = added.zip(spent[-1]).map(lambda p: (p[0][0], level.sums(p[0][1], p[1][1])))
        else:
            sums = added.mapValues(lambda counted: level.sums(counted, None))
        sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
        found = sums.map(lambda p: (p[0], growth.search(p[1], ranges[p[0]]))).collect()
        while spent:
            spent.pop().unpersist()
        spent.append(sums)
        return growth.best([c for _, c in sorted(found, key=lambda p: p[0])])
    return splits_of


def train_folds(df: DataFrame, cols: Sequence[str], label: str, fold: Column, id_col: str, k: int, *, max_depth: int | None,
                max_leaves: int, step_size: float, max_iter: int, min_leaf: int, l2: float, bins: int = 255) -> list[BoostedTrees]:
    """One model per fold, each trained on the rows of the other folds."""
    ensure_checkpoint_dir(df.sparkSession)
    edges = bin_edges(df, cols, bins)
    layout = Layout(edges)
    growth = Growth(layout, max_depth, max_leaves, step_size, min_leaf, l2)
    counts = df.groupBy(fold.alias("f")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("p")).collect()
    n_rows = sum(c["n"] for c in counts)
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    by_fold = n_blocks <= FOLD_BLOCKS and n_rows * len(layout.columns) <= FOLD_CELLS
    cores = df.sparkSession.sparkContext.defaultParallelism      # as many to each core
    n_blocks = max(n_blocks, min(-(-n_blocks // cores) * cores, n_rows // LEAST_BLOCK_ROWS))
    blocks = _blocks(df, cols, label, fold, id_col, layout, n_blocks)
    models = []
    for f in range(k):
        n, p = (sum(c[name] or 0 for c in counts if c["f"] != f) for name in ("n", "p"))
        share = min(max(p / n, 1e-9), 1 - 1e-9) if n else 0.5
        models.append(BoostedTrees(float(np.log(share / (1 - share))), [], len(cols)))
    if not layout.live:
        return models           # no feature has two bins
    if by_fold:
        _train_by_fold(blocks, growth, models, max_iter, -(-cores // k))
        return models
    base = np.array([m.base for m in models])
    # a block: the models it trains, bins, labels, and for each model the rows it uses and their margins
    state = blocks.map(lambda b: (list(range(k)), b[0], b[1], np.stack([b[2] != f for f in range(k)]),
                                  np.repeat(base[:, None], len(b[1]), axis=1))).persist(StorageLevel.MEMORY_AND_DISK)
    done, spent, sums = 0, None, []
    while done < max_iter:
        grown = [dict(enumerate(growth.round(k, _splits_of_blocks(growth, state, sums))))]
        if spent is not None:
            spent.unpersist()
        grown = [trees for trees in grown if any(len(t.feature) > 1 for t in trees.values())]
        if not grown:                                     # nothing left to learn
            break
        for trees in grown:
            for f, t in trees.items():
                models[f].trees.append(t)
        spent, state = state, state.map(_moved(layout, *grown)).persist(StorageLevel.MEMORY_AND_DISK)
        if done // CHECKPOINT_ROUNDS != (done + len(grown)) // CHECKPOINT_ROUNDS:
            state.checkpoint()
        done += len(grown)
    for s in (spent, state, *sums):
        if s is not None:
            s.unpersist()
    return models
