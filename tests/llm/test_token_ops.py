"""Pre-tokens, records, rollups, buckets, lattices, language id and n-best pieces."""

import math
import os
import random
import shutil
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from ledgerguard.llm import language_id, length_buckets, nbest_pieces, token_records, token_rollup
from ledgerguard.llm.common import pieces_by_bytes, scratch_path
from ledgerguard.llm.lattice import Lattice, Trie, flat_bytes
from ledgerguard.llm.pretokens import encoder, vocabulary_path

BPE = vocabulary_path("byte_bpe_50k.json")
RANKS = vocabulary_path("byte_bpe_50k.tiktoken")
PIECES = vocabulary_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string"
PARTS = ["a", "b", " ", "  ", "\n", "'", "s", "'ll", "1", "!", "é", "中", " ", "🙂", " don't", "²", "٣", "\t", "\x1c",
         "́", "'re", "x'", "'t", "　", "\xa0", "ing", "the"]


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def utf8(texts):
    return pa.array([t.encode() for t in texts], pa.binary())


def docs_frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ["en", "fr", None][k % 3], ["a", None, "b", "a"][k % 4]) for k, (i, t) in
            enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_pretokens_equal_the_library():
    coder = encoder(BPE)
    texts = odd_texts(1, 5000) + ["", "word " * 20_000, "z" * 50_000]
    ids, counts = coder.encode(utf8(texts))
    want = [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] == coder.count(utf8(texts)).tolist()
    assert ids.tolist() == [i for w in want for i in w]
    special = ["a <|endoftext|> b", "c"]
    ids, _ = coder.encode(utf8(special))
    assert ids.tolist() == [i for e in coder.library.encode_batch(special, add_special_tokens=False) for i in e.ids]


def test_pieces_by_bytes_is_a_partition():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * n for n in (0, 5, 100, 1, 0, 7)], "k": list(range(6))})
    got = list(pieces_by_bytes(iter([batch, batch.slice(0, 0)]), 0, 8))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert max(g.num_rows for g in got) < 6


# ------------------------------------------------------------------ records

def test_token_records_round_trip(spark):
    texts = odd_texts(2, 60) + [None, "", "long " * 30_000]
    ids = [(i * 37) % 1009 for i in range(len(texts))]
    folder = scratch_path(spark, "records-test")
    token_records.write_token_records(docs_frame(spark, texts, ids), folder, BPE)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in
           token_records.read_token_records(spark, folder).collect()}
    want, start, payload = {}, 0, {}
    library = encoder(BPE).library
    for i, t in sorted(zip(ids, texts, strict=True)):
        own = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want[i], payload[i] = (start, len(own), zlib.crc32(own.tobytes())), own
        start += len(own)
    assert got == want
    for file in (r["file"] for r in spark.read.parquet(f"{folder}/manifest").collect()):
        at = token_records.read_index(folder, file)[:, 0]
        shuffled = np.random.default_rng(0).permutation(at)
        for key, own in token_records.read_records_at(folder, file, shuffled):
            assert own.tolist() == payload[key].tolist()


def test_token_records_edges(spark):
    texts, ids = ["b", "a", None, "x", "x"], [None, None, 3, 4, 4]
    folder = scratch_path(spark, "records-test")
    token_records.write_token_records(docs_frame(spark, texts, ids), folder, BPE)
    got = token_records.read_token_records(spark, folder).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == [
        (False, 0, 2), (False, 0, 2), (True, 3, 1), (True, 4, 2), (True, 4, 2)]
    assert sorted(r["start"] for r in got) == [0, 2, 4, 5, 7]
    empty = scratch_path(spark, "records-test")
    token_records.write_token_records(docs_frame(spark, [], []), empty, BPE)
    assert token_records.read_token_records(spark, empty).count() == 0


def test_damaged_records_are_found():
    import io

    good = token_records.frame(token_records.payload_of(7, np.array([1, 2, 3]), 2))
    key, ids = token_records.ids_of(token_records.read_frame(io.BytesIO(good)))
    assert (key, ids.tolist()) == (7, [1, 2, 3])
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            token_records.read_frame(io.BytesIO(bytes(bad)))


# ------------------------------------------------------------------ rollup

def test_rollup_of_documents(spark):
    texts = odd_texts(4, 40) + ["same text"] * 9 + [None, None, ""]
    docs = docs_frame(spark, texts)
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in
           token_rollup.rollup_documents(docs, scratch_path(spark, "rollup-test"), BPE).collect()}
    want = defaultdict(lambda: [0, 0])
    seen = set()
    library = encoder(BPE).library
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        if r["text"] in seen:
            continue
        seen.add(r["text"])
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        for version, k in (("exact", n), ("final", n + 1)):
            want[r["source"], r["lang"], version][0] += 1
            want[r["source"], r["lang"], version][1] += k
    assert got == {k: tuple(v) for k, v in want.items()}
    assert token_rollup.rollup_documents(docs.limit(0), scratch_path(spark, "rollup-test"), BPE).count() == 0


def test_rollup_commits_are_idempotent(spark):
    side = "struct<source:string,lang:string,version:string,n_tokens:bigint>"
    def changes(*rows):
        return spark.createDataFrame(list(rows), f"before {side}, after {side}")
    folder = scratch_path(spark, "rollup-test")
    store = token_rollup.TokenRollup(spark, folder)
    assert store.totals().count() == 0
    a, b = ("s", "en", "v1", 10), ("s", "en", "v1", 12)
    assert store.commit("one", changes((None, a), (None, a), (None, ("t", None, "v1", None)), (None, None)))
    assert not store.commit("one", changes((None, a)))
    assert store.commit("two", changes((a, b)))
    want = {("s", "en", "v1", 2, 22), ("t", None, "v1", 1, 0)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert {tuple(r) for r in store.totals().collect()} == want and store.batches() == ["one", "two"]
    assert not store.commit("two", changes((a, b)))
    # a batch that broke off (no marker) is written again
    assert store.commit("three", changes((b, None), (a, None), (("t", None, "v1", 0), None)))
    os.remove(f"{folder.removeprefix('file:')}/deltas/batch=three/_SUCCESS")
    assert {tuple(r) for r in store.totals().collect()} == want
    assert store.commit("three", changes((b, None), (a, None), (("t", None, "v1", 0), None)))
    assert store.totals().count() == 0
    store.compact()
    assert store.batches() == ["one", "three", "two"] and store.totals().count() == 0
    with pytest.raises(ValueError):
        store.commit("../x", changes())
    shutil.rmtree(folder.removeprefix("file:"))


# ------------------------------------------------------------------ buckets

def brute_padding(lengths, k):
    x = sorted(set(lengths))
    c = Counter(lengths)
    best = {(0, 0): 0}
    for j in range(1, len(x) + 1):
        for b in range(1, k + 1):
            costs = [best[i, b - 1] + sum(c[v] * (x[j - 1] - v) for v in x[i:j]) for i in range(j) if (i, b - 1) in best]
            if costs:
                best[j, b] = min(costs)
    return min(best[len(x), b] for b in range(1, k + 1) if (len(x), b) in best)


def test_bucket_bounds_are_optimal():
    rng = random.Random(5)
    for _ in range(60):
        lengths = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 40))]
        k = rng.randrange(1, 6)
        c = Counter(lengths)
        bounds = length_buckets.optimal_bounds(np.array(list(c)), np.array(list(c.values())), k)
        assert bounds == sorted(set(bounds)) and len(bounds) <= k and bounds[-1] == max(lengths)
        assert sum(min(b for b in bounds if b >= n) - n for n in lengths) == brute_padding(lengths, k)


def test_pack_batches(spark):
    rng = random.Random(6)
    rows = [(i if i % 50 else None, rng.choice([None, 0, 3, 17, 17, 17, 90, 5000])) for i in range(600)] + [(7, 17)] * 3
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long").withColumn("bucket", F.lit("clash"))
    got = length_buckets.pack(df, max_buckets=3, token_budget=400, range_rows=40).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"] or -1) for r in got) == sorted((a or -1, b or -1) for a, b in rows)
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(got)
    per = Counter((r["bucket"], r["batch"]) for r in got)
    for b in {r["bucket"] for r in got}:
        rows_b = [r for r in got if r["bucket"] == b]
        length = {r["padded_length"] for r in rows_b}.pop()
        capacity = max(1, 400 // max(length, 1))
        assert all((r["n_tokens"] or 0) <= length for r in rows_b)
        sizes = [per[b, k] for k in range(max(r["batch"] for r in rows_b) + 1)]
        assert all(s == capacity for s in sizes[:-1]) and 1 <= sizes[-1] <= capacity     # only the last is not full
    assert length_buckets.pack(df.limit(0)).count() == 0


# ------------------------------------------------------------------ lattices

def segmentations(word, index):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in index:
            for rest in segmentations(word[k:], index):
                yield [index[word[:k]], *rest]


def test_lattice_sums_and_best_paths():
    rng = random.Random(0)
    pieces = sorted({bytes(rng.choice(b"abc ") for _ in range(rng.randrange(1, 5))) for _ in range(30)} |
                    {b"a", b"b", b"c", b" "})
    index = {p: i for i, p in enumerate(pieces)}
    logp = np.log(np.random.default_rng(0).random((len(pieces), 2)))
    words = [bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    lat = Lattice(Trie(pieces), *flat_bytes(pa.array(words, pa.large_binary())))
    alpha, beta = lat.forward_sum(logp), lat.backward_sum(logp)
    best, _ = lat.forward_best(logp[lat.piece, 0])
    for i, w in enumerate(words):
        ways = list(segmentations(w, index))
        for m in range(2):
            want = math.log(sum(math.exp(sum(logp[p, m] for p in way)) for way in ways))
            assert abs(alpha[lat.last[i], m] - want) < 1e-9 and abs(beta[lat.first[i], m] - want) < 1e-9
        assert abs(best[lat.last[i]] - max(sum(logp[p, 0] for p in way) for way in ways)) < 1e-9


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, RANKS, keep_text=False).withColumn("h", language_id.held_out("doc_id"))
    rows = found.collect()
    held = [r for r in rows if r["h"]]
    assert len(rows) == docs.count() and 0.1 < len(held) / len(rows) < 0.3
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_edges_and_independence(spark):
    texts = ["the cat and the dog " * 5, "le chat et le chien " * 5, None, "", "123 !!", "the " * 20_000]
    rows = [(i, t, "fr" if i % 6 == 1 else "en") for i, t in enumerate(texts * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language_id.train(df, RANKS)
    assert model[0] == ["en", "fr"]
    got = [r for r in language_id.identify(df, RANKS, model=model).collect()]
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text"]].add((r["lang_pred"], r["score"]))
    assert all(len(v) == 1 for v in by_text.values())            # the text alone decides
    assert by_text[None] == by_text[""] == by_text["123 !!"] == {("und", 0.0)}
    assert {p for p, _ in by_text[texts[0]] | by_text[texts[5]]} == {"en"} and by_text[texts[1]].pop()[0] == "fr"
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, RANKS).collect()} == {"und"}
    assert language_id.identify(df.limit(0), RANKS).count() == 0


# ------------------------------------------------------------------ n-best pieces

def brute_nbest(model, piece_of, text, n):
    raw = (b" " + text.replace("▁", " ").encode()) if text else b""
    best = {0: [(0.0, 0)]}
    for e in range(1, len(raw) + 1):
        ways = []
        for s in range(max(0, e - 60), e):
            if s in best and raw[s:e] in piece_of:
                ways += [(x + piece_of[raw[s:e]], k + 1) for x, k in best[s]]
        s = e - 1
        while s > 0 and raw[s] & 0xC0 == 0x80:
            s -= 1
        try:
            raw[s:e].decode()
        except UnicodeDecodeError:
            pass
        else:
            if raw[s:e] not in piece_of and s in best:
                ways += [(x + model.score[-1], k + e - s) for x, k in best[s]]
        if ways:
            best[e] = sorted(ways, reverse=True)[:n + 60]
    return [x for x, _ in best[len(raw)]][:n]


def test_nbest_equals_brute_force():
    model = nbest_pieces.model(PIECES)
    piece_of = {model.piece_bytes[i]: s for i, s in zip(model.ids, model.score, strict=False)}
    rng = random.Random(8)
    parts = ["the", "a", "on ", "  ", " ", "and", "é", "中", "\n", "🙂", "x", "ing", "1", "▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 12))) for _ in range(300)] + ["", " "]
    for t, (ids, score, found, size) in zip(texts, nbest_pieces.encode_texts(model, utf8(texts), 4), strict=True):
        want = brute_nbest(model, piece_of, t, 4)
        assert len(found) == len(want) and all(abs(score + x - w) < 1e-6 for (x, _), w in zip(found, want, strict=True))
        assert len({tuple(sorted((k, tuple(v)) for k, v in ways.items())) for _, ways in found}) == len(found)
        assert nbest_pieces.decode_ids(model, ids.tolist()) == t.replace("▁", " ")


def test_nbest_operator(spark):
    texts = odd_texts(9, 40) + [None, "", "word " * 5000, "z" * 5000]
    df = docs_frame(spark, texts).withColumn("n_pieces", F.lit("clash"))
    model = nbest_pieces.model(PIECES)
    rows = nbest_pieces.encode_nbest(df, PIECES, 3, with_ids=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["round_trip"] and r["nbest_scores"] == sorted(r["nbest_scores"], reverse=True)
        assert [len(x) for x in r["nbest_ids"]] == r["nbest_pieces"] and r["nbest_pieces"][0] == r["n_pieces"]
        assert all(nbest_pieces.decode_ids(model, x) == text for x in r["nbest_ids"])
        assert len(set(map(tuple, r["nbest_ids"]))) == len(r["nbest_ids"])
    assert nbest_pieces.encode_nbest(df.limit(0), PIECES).count() == 0


# ------------------------------------------------------------------ cases of the last reviews

def test_pack_spreads_null_keys_and_repeated_keys_and_rows(spark):
    """Half of the rows without a key, a tenth under one key, a tenth equal: no range holds many."""
    rows = [(None if i % 2 else i, 5 + i % 3, i) for i in range(4000)] + [(-1, 5, i) for i in range(1000)] + [(-2, 5, 0)] * 1000
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, other long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = length_buckets.pack(df, range_rows=300, round_to=8, max_buckets=1, token_budget=800).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    places = sorted((r["batch"], r["slot"]) for r in got)
    assert places == [(i // 100, i % 100) for i in range(6000)]           # each place once, whatever the keys
    null_batches = Counter(r["batch"] for r in got if r["doc_id"] is None)
    assert len(null_batches) == 60 and max(null_batches.values()) < 60    # spread over all batches
    assert len({r["batch"] for r in got if r["doc_id"] == -2}) > 50


def test_files_of_stores_are_named_as_spark_names_them(tmp_path):
    for uri, kind in (("s3a://bucket/a/b", "s3"), ("s3n://bucket/a/b", "s3"), ("file:/tmp/x", "local"), ("/tmp/x", "local"),
                      (f"file://{tmp_path}", "local")):
        store, path = token_records.file_system(uri)
        assert store.type_name == kind and "://" not in path
    assert token_records.file_system("s3a://bucket/a/b")[1] == "bucket/a/b"


def test_records_of_null_and_equal_keys_fill_several_files(spark):
    folder = scratch_path(spark, "records-null")
    rows = [(None, f"text {i}") for i in range(300)] + [(7, f"other {i}") for i in range(300)] + [(9, "copy")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = token_records.write_token_records(docs, folder, BPE).collect()
    assert sum(r["records"] for r in files) == 900 and max(r["records"] for r in files) < 500
    got = token_records.read_token_records(spark, folder).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 300, 7: 300, 9: 300}
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == [None] * 300 + [7] * 300 + [9] * 300
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(order, order[1:], strict=False))


def test_words_are_cut_alike_in_training_and_scoring(spark):
    odd = [chr(c) for c in range(1, 0x3001) if not 0xD800 <= c < 0xE000]
    texts = [f"x{c}y" for c in odd]
    by_arrow = [len(w) for w in pa.compute.utf8_split_whitespace(pa.array(texts)).to_pylist()]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", F.size(F.split("t", language_id.WHITE_SPACE)).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in rows] == by_arrow


def test_language_predictions_equal_brute_force(spark):
    """The forward sums over the whole vocabulary, word by word, for every text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").limit(60)
    langs, logp = language_id.train(docs, RANKS, per_language=20, rounds=2)
    pieces = language_id.byte_pieces(RANKS)
    assert len(pieces) == 50_256 and max(map(len, pieces)) == 128 and logp.shape == (len(pieces), len(langs))
    number = {p: i for i, p in enumerate(pieces)}

    def word(w):
        raw = b" " + w.encode()
        total = [np.zeros(len(langs))] + [np.full(len(langs), -np.inf)] * len(raw)
        for end in range(1, len(raw) + 1):
            for start in range(max(0, end - 128), end):
                if raw[start:end] in number:
                    total[end] = np.logaddexp(total[end], total[start] + logp[number[raw[start:end]]])
        return total[-1]
    got = {r["doc_id"]: r for r in language_id.identify(docs, RANKS, model=(langs, logp)).collect()}
    known = {}
    for r in docs.collect()[:25]:
        words = (r["text"] or "").split()[:400] if len((r["text"] or "").split()) <= 400 else None
        if words is None or not any(c.isalpha() for c in r["text"] or ""):
            continue
        scores = sum((known.setdefault(w, word(w)) for w in words), np.zeros(len(langs)))
        assert got[r["doc_id"]]["lang_pred"] == langs[int(scores.argmax())]
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / np.exp(scores - scores.max()).sum(), abs=1e-6)
