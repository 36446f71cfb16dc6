"""SimHash near-duplicate groups by the generalised pigeonhole principle.

1. *Fingerprint*: 64-bit SimHash of the text's word shingles (lower-cased A-Z, words
   ``[^\\x20\\x09-\\x0D]+``, repeats included); bit set if set in over half of the XXH64 hashes.
2. *Partitions*: the bit co-occurrence table of all distinct fingerprints (64 x 64 sums, so
   bounded) groups correlated bits together.
3. *Thresholds*: if the thresholds t_1..t_m of the m partitions add up to r - m + 1, two
   fingerprints within r bits differ by at most t_i bits in some partition i.  Dynamic
   programming picks m and the (unequal) thresholds with the least estimated work: exact
   key collisions of all fingerprints, scaled to each radius by the bits' agreement rates.
4. *Probe*: a fingerprint files itself under its key of each partition and under every key
   within that partition's threshold.  Crowded buckets are divided again by the same
   principle on the bits not yet used, so no task gets an unbounded bucket.
5. *Verify*: members of a bucket are compared on all 64 bits; a bucket gives a spanning
   forest of its links, never all its pairs.
6. Connected components of the links give the groups.

Only distinct fingerprints are probed, so exact copies of any number cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerguard.llm.common import (binary_column, bounded_batches, cut_lineage, give_back, shuffle_partitions, store,
                                    without)
from ledgerguard.llm.components import connected_components

BITS = 64


def text_fingerprint(raw: bytes, shingle: int = 3) -> int:
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(size + 1) - 1
        starts = ends - size
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                                        ends[shingle - 1:].tolist(), strict=True)]
    values = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(values), 1 << 16):
        block = values[i:i + (1 << 16)]
        ones += np.add.reduce(np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"),
                              axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long column ``name`` (an input column of
    that name is replaced).  A null text counts as empty; empty texts get 0."""
    docs = without(docs, name)
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = binary_column(batch, at).to_pylist()
            fps = np.array([text_fingerprint(x, shingle) for x in raw], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())],
                                             names=[*batch.schema.names, name])
            give_back()

    return docs.mapInArrow(fingerprint, schema)


# ---------------------------------------------------------------- partitions and thresholds

def _bit_sums(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 table of how many have both bits set."""
    def sums(batches):
        both = np.zeros((BITS, BITS), dtype=np.int64)
        n = 0
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(v), 1 << 16):
                bits = np.unpackbits(v[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
            n += len(v)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([*range(BITS * BITS), -1], pa.int32()),
                                              pa.array([*both.ravel().tolist(), n], pa.int64())], names=["k", "n"])

    rows = fps.select("fp").mapInArrow(sums, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    got = {r["k"]: r["n"] for r in rows}
    return got.get(-1, 0), np.array([got.get(k, 0) for k in range(BITS * BITS)], dtype=float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near equal width; each grows by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for g in range(m):
        width = len(left) // (m - g)
        sub = corr[np.ix_(left, left)]
        group = [left[int(sub.max(axis=1).argmax())]]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(rest[int(corr[np.ix_(rest, group)].mean(axis=1).argmax())])
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def allocate(collisions: list[float], agree: list[np.ndarray], n: int, radius: int, probe_cost: float
             ) -> tuple[float, list[int]]:
    """Least estimated work over thresholds >= -1 adding up to radius - m + 1."""
    m = len(collisions)
    total = radius - m + 1
    cost = []
    for same, a in zip(collisions, agree, strict=True):
        dist = np.zeros(radius + 1)
        dist[0] = 1.0
        for q in a:  # distribution of the number of differing bits, up to the radius
            dist[1:] = dist[1:] * q + dist[:-1] * (1 - q)
            dist[0] *= q
        grown = np.cumsum(dist) / max(dist[0], 1e-300)
        probes = np.cumsum([comb(len(a), r) for r in range(radius + 1)])
        cost.append({-1: 0.0} | {t: same * grown[t] + probe_cost * n * probes[t] for t in range(radius + 1)})
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (work, ts) in best.items():
            for t, w in c.items():
                if spent + t <= total + m and (spent + t not in step or work + w < step[spent + t][0]):
                    step[spent + t] = (work + w, [*ts, t])
        best = step
    return best[total]


def _keys(v: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = []
    for g in groups:
        padded = np.zeros((len(v), BITS), dtype=np.uint8)
        padded[:, :len(g)] = bits[:, g]
        out.append(np.packbits(padded, axis=1, bitorder="little").view("<i8").ravel())
    return out


def plan_probes(fps: DataFrame, radius: int = 3, probe_cost: float = 4.0) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed."""
    n, both = _bit_sums(fps)
    p = np.diag(both) / max(n, 1)
    schemes = {m: group_bits(n, both, m) for m in range(2, radius + 2)}
    every = [(m, i, g) for m, groups in schemes.items() for i, g in enumerate(groups)]

    def keyed(batches):
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, keys in enumerate(_keys(v, [g for _, _, g in every])):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k, np.int32)), pa.array(keys)],
                                                 names=["k", "key"])

    same = {r["k"]: float(r["pairs"]) for r in
            fps.select("fp").mapInArrow(keyed, "k int, key long").groupBy("k", "key").count()
            .groupBy("k").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    plans = []
    for m, groups in schemes.items():
        at = [k for k, (mm, _, _) in enumerate(every) if mm == m]
        agree = [np.clip(p[g] ** 2 + (1 - p[g]) ** 2, 1e-6, 1.0) for g in groups]
        work, ts = allocate([same.get(k, 0.0) for k in at], agree, n, radius, probe_cost)
        plans.append((work, m, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0]))
    return min(plans, key=lambda x: x[:2])[2]


# ---------------------------------------------------------------- probe and verify

def _probe(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(bucket, used, fp): ``used`` has the bits that need no further division."""
    def probe(batches):
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, (keys, (bits, t)) in enumerate(zip(_keys(v, [g for g, _ in plan]), plan, strict=True)):
                used = np.int64(np.array([sum(1 << b for b in bits)], dtype=np.uint64).view(np.int64)[0])
                for r in range(t + 1):
                    for flip in combinations(range(len(bits)), r):
                        mask = np.array([sum(1 << b for b in flip)], dtype=np.uint64).view(np.int64)[0]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(v), i, np.int32)), pa.array(keys ^ mask),
                             pa.array(np.full(len(v), used)), pa.array(v)], names=["i", "key", "used", "fp"])

    return (fps.select("fp").mapInArrow(probe, "i int, key long, used long, fp long")
            .select(F.xxhash64("i", "key").alias("bucket"), "used", "fp"))


def _divide(rows: DataFrame, radius: int) -> DataFrame:
    """Buckets cut into radius + 1 smaller ones each, by equal parts of the bits not yet used
    (two members within the radius agree in at least one part)."""
    def divide(batches):
        for batch in batches:
            bucket, used, fp = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            for u in np.unique(used):
                sel = used == u
                free = [b for b in range(BITS) if not (int(u) >> b) & 1]
                for j, part in enumerate(np.array_split(np.array(free), radius + 1)):
                    mask = np.array([sum(1 << int(b) for b in part)], dtype=np.uint64).view(np.int64)[0]
                    k = int(sel.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[sel]), pa.array(np.full(k, j, np.int32)), pa.array(fp[sel] & mask),
                         pa.array(np.full(k, u | mask)), pa.array(fp[sel])],
                        names=["b", "j", "key", "used", "fp"])

    return (rows.mapInArrow(divide, "b long, j int, key long, used long, fp long")
            .select(F.xxhash64("b", "j", "key").alias("bucket"), "used", "fp"))


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Breadth-first spanning forest of the distinct values within ``radius`` bits."""
    left = values.copy()
    out: list[tuple[int, int]] = []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                out.extend((int(x), int(y)) for y in found)
                frontier.extend(found)
                left = left[~near]
    return out


SMALL = 16  # buckets up to this size are compared by shifted columns, larger ones one by one


def _links(rows: DataFrame, radius: int) -> DataFrame:
    """(u, v) links of every bucket; rows are dealt by bucket and read in its order."""
    def emit(bucket: np.ndarray, fp: np.ndarray):
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[first, len(bucket)])
        us, vs = [], []
        small = np.repeat(sizes <= SMALL, sizes)
        for s in range(1, min(SMALL, int(sizes.max(initial=1)))):
            ok = (bucket[s:] == bucket[:-s]) & small[s:]
            ok &= np.bitwise_count((fp[s:] ^ fp[:-s]).view(np.uint64)) <= radius
            ok &= fp[s:] != fp[:-s]
            us.append(fp[s:][ok])
            vs.append(fp[:-s][ok])
        for at, k in zip(first[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            links = spanning_links(np.unique(fp[at:at + k]).view(np.uint64), radius)
            pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            us.append(pairs[:, 0])
            vs.append(pairs[:, 1])
        u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (us, vs))
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    def link(batches):
        held_b, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            b, f = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            if not len(b):
                continue
            b, f = np.r_[held_b, b], np.r_[held_f, f]
            cut = int(np.searchsorted(b, b[-1]))  # the last bucket may go on in the next batch
            held_b, held_f = b[cut:], f[cut:]
            if cut:
                yield emit(b[:cut], f[:cut])
        if len(held_b):
            yield emit(held_b, held_f)

    n = shuffle_partitions(rows.sparkSession)
    return (rows.select("bucket", "fp").repartition(n, "bucket").sortWithinPartitions("bucket", "fp")
            .mapInArrow(link, "u long, v long"))


def fingerprint_links(fps: DataFrame, radius: int = 3, crowd: int = 4096) -> DataFrame:
    """(u, v) links between distinct fingerprints (column ``fp``) at ``radius`` bits or fewer:
    enough of them that components are whole."""
    rows = _probe(fps, plan_probes(fps, radius))
    out = []
    for _ in range(BITS):
        crowded = cut_lineage(rows.groupBy("bucket").agg(F.count("*").alias("n"), F.first("used").alias("u"))
                              .where((F.col("n") > crowd) & (F.bit_count("u") < BITS - 8)).select("bucket"))
        if crowded.isEmpty():
            out.append(_links(rows, radius))
            break
        out.append(_links(rows.join(crowded, "bucket", "left_anti"), radius))
        rows = cut_lineage(_divide(rows.join(crowded, "bucket", "left_semi"), radius).distinct())
    links = out[0]
    for more in out[1:]:
        links = links.unionByName(more)
    return links


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                       radius: int = 3, keep_text: bool = True) -> DataFrame:
    """``docs`` rows (all columns, the text only if ``keep_text``) with ``fp`` (signed long),
    ``component_root`` (smallest fingerprint of the group) and ``component_id`` (smallest key
    of the group).

    Null text counts as empty and empty texts (fingerprint 0) link like any other.  Rows with
    a null key take part in links but never name a group; a group of only such rows gets a
    null id.  Repeated rows stay as they are; an empty table gives an empty table; a very long
    text is hashed whole.  Input columns named like an output column are replaced.
    """
    docs = without(docs, "fp", "component_root", "component_id")
    hashed = with_fingerprint(docs, text, shingle)
    hashed = store(hashed if keep_text else hashed.drop(text), "fingerprints")
    per_fp = cut_lineage(hashed.groupBy("fp").agg(F.min(key).alias("low")))
    roots = connected_components(fingerprint_links(per_fp, radius))
    rooted = cut_lineage(per_fp.join(roots, per_fp["fp"] == roots["node"], "left").select(
        per_fp["fp"].alias("__fp"), "low", F.coalesce("root", per_fp["fp"]).alias("component_root")))
    lows = rooted.groupBy("component_root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "component_root").select("__fp", "component_root", "component_id")
    return hashed.join(named, hashed["fp"] == named["__fp"]).drop("__fp")


def keep_first_of_group(grouped: DataFrame, columns: list[str], key: str = "doc_id") -> DataFrame:
    """One row of each group: the one with the smallest key (of repeated rows with that key,
    the one with the smallest hash of all its columns)."""
    heads = grouped.where(F.col(key).eqNullSafe(F.col("component_id")))
    order = Window.partitionBy("component_root").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    return (heads.withColumn("__n", F.row_number().over(order)).where("__n = 1")
            .select(*[F.col(f"`{c}`") for c in columns]))


def fingerprint_hex(fp):
    """A signed long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
