"""Line templates, SimHash groups, multiset hashes and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerguard.llm import line_templates, multiset_hash, queries, simhash_groups, suffix_dedup
from ledgerguard.llm.bwt import prefix_classes
from ledgerguard.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa".split()


def make_texts(seed=3, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    shared = " ".join(rng.choice(WORDS) for _ in range(40))
    out = []
    for i, t in enumerate(base):
        if i % 4 == 0:
            t = t + "\n" + shared + "\n" + f"page {i} of {n}"
        if i % 7 == 0:
            t = base[0]
        out.append(t)
    return out + ["", None, " \n\n", "x" * 40, "ab" * 3000, base[1], base[1]]


def frame(spark, texts, ids=None, extra=False):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:   # names that operators use or return
        for c in ("fp", "__g", "component_id", "n_bytes", "n_lines", "kept_sha256", "kept_text"):
            df = df.withColumn(c, F.lit("clash"))
    return df


EDGE_IDS = [None, None, 5, 5, 7, 8]
EDGE_TEXTS = ["a b c d " * 20, "a b c d " * 20, "a b c d " * 20, "a b c d " * 20, None, ""]


# ------------------------------------------------------------------ simhash

def brute_simhash(texts):
    out = []
    for t in texts:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    return out


def brute_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_groups(spark):
    texts = make_texts()
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in
           simhash_groups.simhash_components(frame(spark, texts, extra=True)).collect()}
    fps = brute_simhash(texts)
    assert got == {i: (f, c) for i, (f, c) in enumerate(zip(fps, brute_components(fps), strict=True))}


@pytest.mark.parametrize("crowd", [4096, 8])
def test_simhash_links_in_dense_groups(spark, crowd):
    rng = random.Random(1)
    centre = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))) for c in centre for _ in range(60)}
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(200)} | {0})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in
             connected_components(simhash_groups.fingerprint_links(df, 3, crowd)).collect()}
    want = brute_components(fps)
    groups, expected = defaultdict(set), defaultdict(set)
    for f, w in zip(fps, want, strict=True):
        groups[roots.get(f, f)].add(f)
        expected[w].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_threshold_allocation_is_a_generalised_pigeonhole():
    work, ts = simhash_groups.allocate([1e9, 10.0, 10.0], [np.full(21, 0.5)] * 3, 1000, 3, 4.0)
    assert sum(ts) == 3 - 3 + 1 and min(ts) >= -1 and ts[0] == -1 and work > 0


def test_keep_first_with_null_and_repeated_ids(spark):
    docs = frame(spark, EDGE_TEXTS, EDGE_IDS)
    kept = simhash_groups.keep_first_of_group(simhash_groups.simhash_components(docs), docs.columns).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(5, EDGE_TEXTS[0]), (7, "")]
    only_null = frame(spark, EDGE_TEXTS[:2], [None, None])
    assert simhash_groups.keep_first_of_group(simhash_groups.simhash_components(only_null), docs.columns).count() == 1
    assert simhash_groups.simhash_components(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ suffix dedup

def brute_repeats(texts, ids, length):
    low = {}
    raws = [(t or "").encode() for t in texts]
    for d, b in zip(ids, raws, strict=True):
        d = 1 << 62 if d is None else d
        for i in range(len(b) - length + 1):
            low[b[i:i + length]] = min(d, low.get(b[i:i + length], d))
    out = []
    for d, b in zip(ids, raws, strict=True):
        d = 1 << 62 if d is None else d
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if low[b[i:i + length]] < d:
                mark[i:i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        spans = sum(1 for i in range(len(b)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((d, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("crowd", [1000, 1])
def test_suffix_dedup(spark, crowd):
    texts = make_texts(5)
    ids = [(i * 37) % 1009 for i in range(len(texts))]
    got = suffix_dedup.remove_repeats(frame(spark, texts, ids, extra=True), crowd=crowd).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == \
        brute_repeats(texts, ids, 50)


def test_suffix_dedup_edges(spark):
    docs = frame(spark, EDGE_TEXTS, EDGE_IDS)
    got = suffix_dedup.remove_repeats(docs, with_text=True).collect()
    assert sorted((1 << 62 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"],
                   r["kept_sha256"]) for r in got) == brute_repeats(EDGE_TEXTS, EDGE_IDS, 50)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_dedup_of_a_phrase_in_every_document(spark):
    """A phrase of 40 bytes in ever other surroundings (nothing goes), one of 60 (it goes), and a
    very long text; no key meets more than a few rows of a slice."""
    rng = random.Random(6)
    own = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    short, long = "P" + own(38) + "Q", "R" + own(58) + "S"
    texts = [f"{own(60)}{short}{own(60)}" for _ in range(150)] + [f"{own(30)}{long}{own(30)}" for _ in range(150)]
    texts.append(own(200_000) + long + short)
    ids = [(i * 37) % 1009 for i in range(len(texts))]
    for crowd in (10, 1000):
        got = suffix_dedup.remove_repeats(frame(spark, texts, ids), crowd=crowd).collect()
        by = {r["doc_id"]: r["n_removed"] for r in got}
        first = min(ids[150:])
        assert [by[i] for i in ids[:150]] == [0] * 150
        assert all(60 <= by[i] <= 70 for i in ids[150:] if i != first) and by[first] == 0


def test_bounded_prefix_classes():
    rng = np.random.default_rng(0)
    for _ in range(60):
        s = np.r_[rng.integers(0, 4, rng.integers(1, 150)), 0].astype(np.uint16)
        s = np.r_[s, s[:len(s) // 2], 0].astype(np.uint16)
        length = int(rng.integers(1, 12))
        classes = prefix_classes(s, length)
        by_string = defaultdict(set)
        for i in range(len(s) - length + 1):
            by_string[s[i:i + length].tobytes()].add(int(classes[i]))
        assert all(len(c) == 1 for c in by_string.values())
        assert len(set().union(*by_string.values()) if by_string else ()) == len(by_string)


def test_prefix_classes_of_repeats_read_few_rows_a_level(monkeypatch):
    """Rows whose predecessors are neighbours follow the boundary between those: running sums over the whole
    block at the first levels only, and the classes are those of the strings."""
    from ledgerguard.llm import bwt
    rng = np.random.default_rng(1)
    base = rng.integers(1, 60, 400)
    s = np.concatenate([np.r_[np.where(rng.random(400) < 0.002, 70 + i % 30, base), 0] for i in range(60)]).astype(np.uint16)
    summed, plain = [], np.cumsum

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        def cumsum(self, x, *a, **k):
            summed.append(len(x))
            return plain(x, *a, **k)
    monkeypatch.setattr(bwt, "np", Counting())
    classes = bwt.prefix_classes(s, 50)
    assert sum(summed) < 15 * len(s)              # before: at most of the 49 levels
    by_string = defaultdict(set)
    for i in range(len(s) - 49):
        by_string[s[i:i + 50].tobytes()].add(int(classes[i]))
    assert all(len(c) == 1 for c in by_string.values()) and len(set().union(*by_string.values())) == len(by_string)


@pytest.mark.parametrize("length,gram", [(50, 16), (16, 16), (30, 5), (200, 16)])
def test_windows_own_their_leftmost_smallest_gram(length, gram):
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 400, length, length - 1, 0, 900)] + [b"a" * 300]
    buf, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    at, first, stop, doc = suffix_dedup.owned_runs(buf, ends, length, gram)
    starts, covered, owner = ends - [len(t) for t in texts], 0, {}
    for a, i, j, d in zip(*(x.tolist() for x in (at, first, stop, doc)), strict=True):
        assert starts[d] <= i < j and j - 1 + length <= ends[d] and j - 1 <= a <= i + length - gram
        covered += j - i
        for w in range(i, j):                     # equal windows own the gram at one place
            assert owner.setdefault(buf[w:w + length].tobytes(), a - w) == a - w
    assert covered == sum(max(0, len(t) - length + 1) for t in texts)
    ids = suffix_dedup._anchor_ids(buf, at, gram)
    by_gram = defaultdict(set)
    for a, h in zip(at.tolist(), ids.tolist(), strict=True):
        by_gram[buf[a:a + gram].tobytes()].add(h)
    assert all(len(h) == 1 for h in by_gram.values()) and len(set().union(*by_gram.values())) == len(by_gram)


# ------------------------------------------------------------------ line templates

def brute_lines(texts, ids, min_docs=5, similarity=0.7, depth=3):
    """The module's rules over token tuples, all lines at once."""
    rows = []
    for d, (i, t) in enumerate(zip(ids, texts, strict=True)):
        for n, line in enumerate((t or "").split("\n")):
            tokens = tuple("<*>" if re.search(r"\d", x) else x for x in line.split())
            if tokens:
                rows.append((d, i, n, tokens, (len(tokens), tokens[:depth]), tuple(line.split())))
    def docs_of(keyed):
        seen = defaultdict(set)
        for k, i in keyed:
            seen[k].add(i)
        return {k: len(v) for k, v in seen.items() if len(v) >= min_docs}
    solid = lambda t: sum(x != "<*>" for x in t)
    few = lambda t: "<*>" in t and solid(t) < similarity * len(t)
    leaves, whole = docs_of((r[4], r[1]) for r in rows), docs_of((r[3], r[1]) for r in rows)
    exact = docs_of((r[5], r[1]) for r in rows if few(r[3]))
    places = [((r[4], p, x), r[1], r[3] in whole) for r in rows if r[4] in leaves for p, x in enumerate(r[3]) if x != "<*>"]
    constant, loose = docs_of((k, i) for k, i, _ in places), docs_of((k, i) for k, i, w in places if not w)
    templated = []
    for d, i, n, tokens, leaf, raw in rows:
        if few(tokens):
            found = {("exact", raw)} if raw in exact else set()
        elif leaf not in leaves:
            found = set()
        elif 2 * whole.get(tokens, 0) >= leaves[leaf]:
            found = {(leaf, tokens)}
        else:
            share = [constant.get((leaf, p, x), 0) for p, x in enumerate(tokens)]
            found = {(leaf, tokens if tokens in whole else tuple(
                x if (leaf, p, x) in loose else "<*>" for p, x in enumerate(tokens)))}
            for part in (2 ** k for k in range(1, 40)):
                general = tuple(x if c * part >= leaves[leaf] else "<*>" for x, c in zip(tokens, share, strict=True))
                if solid(general) >= similarity * len(tokens):
                    found.add((leaf, general))
                    break
        templated += [(d, i, n, f) for f in found if f[0] == "exact" or solid(f[1]) >= max(similarity * len(tokens), 1)]
    recurs = docs_of((t, i) for _, i, _, t in templated)
    first = {}
    for _, i, n, t in templated:
        first[t] = min(first.get(t, (i, n)), (i, n))
    gone = defaultdict(set)
    for d, i, n, t in templated:
        if t in recurs and first[t] != (i, n):
            gone[d].add(n)
    return {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone[d])
            for d, (i, t) in enumerate(zip(ids, texts, strict=True))}


def sql_lines(texts):
    """(n_lines, n_dropped, kept_sha256) per document by the registered SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    return {r[0]: r[1:] for r in con.execute(queries.ORACLES["op1_line_templates"]).fetchall()}


def check_lines(spark, texts):
    """Operator, brute force and SQL agree; returns the operator's rows."""
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(spark, texts)).collect()}
    assert {i: r["text"] or "" for i, r in got.items()} == brute_lines(texts, list(range(len(texts))))
    assert {i: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for i, r in got.items()} == sql_lines(texts)
    return got


def test_line_templates(spark):
    texts = make_texts(9, 80)
    texts += [f"Daily report by {w} on the state of the {v} harbour wall today" for w in WORDS for v in ("old", "new")]
    ids = list(range(len(texts)))
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(spark, texts, extra=True)).collect()}
    want = brute_lines(texts, ids)
    assert {i: r["text"] or "" for i, r in got.items()} == want
    assert all(r["kept_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in got.values())
    reports = [i for i in ids[-20:] if got[i]["n_dropped"]]
    assert len(reports) >= 18      # the varied fields are generalised; the first of each template stays


@pytest.mark.parametrize("values, copies", [(4, 1), (5, 1), (50, 1), (4, 6)])
def test_line_templates_with_two_fields(spark, values, copies):
    """The template of a leaf does not depend on how often each value of a field occurs."""
    texts = [f"Daily report by person{chr(97 + i % 26)}{chr(97 + i // 26)} on the state of the "
             f"{chr(97 + j % 26)}{chr(97 + j // 26)}port harbour wall today"
             for _ in range(copies) for i in range(values) for j in range(values)]
    got = check_lines(spark, texts)
    assert [i for i, r in got.items() if not r["n_dropped"]] == [0]


def test_line_templates_keep_several_templates_of_a_leaf(spark):
    name = lambda i: chr(97 + i % 26) * 3 + chr(97 + i // 26) * 2
    texts = [f"Daily report by {name(i)} on the state of the harbour wall today" for i in range(60)]
    texts += [f"Daily report by {name(i)} with new prices for all fish sold here" for i in range(15)]
    got = check_lines(spark, texts)
    assert sorted(i for i, r in got.items() if not r["n_dropped"]) == [0, 60]


@pytest.mark.parametrize("seed", range(3))
def test_line_templates_where_share_and_count_differ(spark, seed):
    """Random mixtures of templates, fields, digits and recurring lines in one leaf."""
    rng = random.Random(seed)
    field = lambda n: rng.choice(["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op", "7", "x9"][:n])
    line = lambda: rng.choice([
        lambda: f"to be or {field(4)} to {field(9)} that is it now",
        lambda: f"to be or not to {field(8)} we say {field(2)} {field(9)}",
        lambda: f"to be or {field(10)} {field(10)} {field(10)} that is it",
        lambda: f"no {field(10)} of {field(10)}", lambda: " ".join(field(10) for _ in range(4))])()
    check_lines(spark, ["\n".join(line() for _ in range(rng.randrange(4))) for _ in range(120)])


def test_line_templates_very_long_text_and_line(spark):
    long = "\n".join(f"a line of its own, number {chr(97 + k % 26) * (k % 40)} {k}" for k in range(30_000)) + "\n" + "word " * 100_000
    texts = [long + "\nthe same closing line in all of them"] + ["the same closing line in all of them"] * 6
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(spark, texts)).collect()}
    assert got[0]["n_lines"] == 30_002 and got[0]["text"].endswith("all of them")
    assert all(got[i]["text"] == "" for i in range(1, 7))


def test_line_templates_rows_with_one_key(spark):
    """Rows under one key are one document, but their own lines: only the recurring one goes."""
    rows = [(1, "recurring words stand here\nmine"), (1, "others\nrecurring words stand here"), (1, "recurring words stand here\nyours"),
            *[(i, "recurring words stand here") for i in range(2, 7)]]
    got = line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["text"] for r in got if r["doc_id"] == 1) == [
        "others", "recurring words stand here\nmine", "recurring words stand here\nyours"]
    assert all(r["text"] == "" for r in got if r["doc_id"] > 1)


def test_line_templates_exact_lines_with_digits(spark):
    """A line that recurs with its digits needs no share of constants; others still do."""
    footers = ["Page 1 of 1", "(c) 2024 Acme", "Posted 2024-01-02 10:30"]
    texts = [f"text {w} of its own\n" + "\n".join(footers) + f"\nPage {i} of {i + 7}" for i, w in enumerate(WORDS)]
    got = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(frame(spark, texts)).collect()}
    assert got[0] == texts[0]
    assert all(got[i] == f"text {w} of its own\nPage {i} of {i + 7}" for i, w in enumerate(WORDS) if i)


def test_line_templates_edges(spark):
    docs = frame(spark, EDGE_TEXTS, EDGE_IDS)
    got = line_templates.drop_recurring_lines(docs).collect()
    assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in got)) == sorted(
        (i or 0, t or "") for i, t in zip(EDGE_IDS, EDGE_TEXTS, strict=True))
    assert line_templates.drop_recurring_lines(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ multiset hash

def test_document_fingerprints(spark):
    texts = make_texts(11)
    ids = [(i * 37) % 1009 for i in range(len(texts))]
    rows = {r["doc_id"]: r for r in multiset_hash.document_fingerprints(frame(spark, texts, ids)).collect()}
    order = sorted(zip(ids, texts, strict=True), reverse=True)
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_edited"] <= 1 and 0 <= rows[i]["near_next"] <= 1
        same = rows[i]["fingerprint"] == rows[i]["edited_fingerprint"]
        assert same == (sorted(t.split("\n")) == sorted(edited.split("\n")))
    by_text = defaultdict(set)
    for i, t in zip(ids, texts, strict=True):
        by_text[t or ""].add(rows[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)


def test_paragraph_order_insertion_and_deletion(spark):
    rows = [(1, "one a\ntwo b\nthree c"), (2, "three c\none a\ntwo b"), (3, "one a\nthree c"), (4, "two b")]
    df = spark.createDataFrame(rows, "k int, text string")
    prints = multiset_hash.fingerprints(df, ["k"])
    by = {r["k"]: (r["identity"], r["likeness"], r["runs"]) for r in prints.collect()}
    assert by[1] == by[2] != by[3]
    part = prints.where("k = 4").withColumn("k", F.lit(3))
    added = multiset_hash.combine(prints.where("k = 3"), part, ["k"]).first()
    assert (added["identity"], added["likeness"], added["runs"]) == by[1]
    gone = multiset_hash.combine(prints.where("k = 1"), part.withColumn("k", F.lit(1)), ["k"], -1).first()
    assert (gone["identity"], gone["likeness"], gone["runs"]) == by[3]


def test_fingerprint_likeness_in_any_script(spark):
    """Half of the text kept gives a likeness, whatever letters its words end in."""
    rng = random.Random(4)
    pick = lambda letters, n, sep: sep.join("".join(rng.choice(letters) for _ in range(4)) for _ in range(n))
    texts = [pick("0123456789", 300, " "), pick("ABCDEFGHKL", 300, " "), pick("абвгдежз", 300, " "),
             pick("天地玄黃宇宙洪荒日月盈昃辰宿列張", 300, ""), pick("xyz(){}=+", 300, ""), "Eres " * 600, "天" * 1500]
    # each kept half is followed by half of an unrelated text, which is the next document
    rows = [(2 * i + 1, t) for i, t in enumerate(texts)] + [(2 * i, pick("uvw", 300, " ")) for i in range(len(texts))]
    got = {r["doc_id"]: r for r in multiset_hash.document_fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert min(got[2 * i + 1]["near_edited"] for i in range(len(texts))) > 0.3
    assert max(got[2 * i + 1]["near_next"] for i in range(len(texts))) < 0.5
    runs = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.explode(multiset_hash.word_runs(F.col("t"))).alias("r"))
    assert runs.agg(F.max(F.length("r"))).first()[0] <= 8 * 17


def test_document_fingerprints_edges(spark):
    got = multiset_hash.document_fingerprints(frame(spark, EDGE_TEXTS, EDGE_IDS, extra=True)).collect()
    assert len(got) == len(EDGE_IDS)
    assert {r["doc_id"]: r["near_next"] for r in got if r["doc_id"] == 8} == {8: 1.0}     # next: null, also empty
    assert multiset_hash.document_fingerprints(frame(spark, [], [])).count() == 0
    assert multiset_hash.document_fingerprints(frame(spark, ["a b"], [1])).first()["near_next"] == 1.0


# ------------------------------------------------------------------ very long texts

def test_very_long_texts_are_taken_whole(spark):
    """200,000 characters in words and in one word: fingerprints and groups of the whole texts, equal
    for copies and different for a change at the far end."""
    rng = random.Random(8)
    words = " ".join(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(25_000))
    solid = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    texts = [words, words, words + " end", solid, solid, solid[:-1] + "x"]
    docs = frame(spark, texts)
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in simhash_groups.simhash_components(docs).collect()}
    fps = brute_simhash(texts)
    assert got == {i: (f, c) for i, (f, c) in enumerate(zip(fps, brute_components(fps), strict=True))}
    prints = {r["doc_id"]: r for r in multiset_hash.document_fingerprints(docs).collect()}
    for i, j, k in ((0, 1, 2), (3, 4, 5)):
        assert prints[i]["fingerprint"] == prints[j]["fingerprint"] != prints[k]["fingerprint"]
        assert prints[i]["n_chars"] == len(texts[i])
