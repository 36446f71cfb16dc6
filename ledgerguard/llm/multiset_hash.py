"""Order-independent document fingerprints: a homomorphic multiset hash in native functions.

A text is a multiset of paragraphs (its lines).  Each paragraph hashes to a wide vector; the
fingerprint is the sum of the vectors, lane by lane, modulo a power of two:

* 8 identity lanes modulo 2^32: four seeded XXH64 hashes of the paragraph, 32 bits a lane;
* 128 likeness lanes modulo 2^32: the paragraph's word runs (cut after words by a hash of
  the word, words of over 16 characters first cut by a hash of two characters, both with a
  longest piece, so an edit moves only the runs around it in any script) each add one hash bit
  per lane.

Sums commute, so paragraph order does not matter; inserting or deleting paragraphs adds or
subtracts their vectors (:func:`combine`).  The likeness of two fingerprints is the cosine of
their centred likeness lanes (an estimate of the word-run overlap), cut to 0..1.

Everything is a column expression or a DataFrame aggregate: no Python runs on executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerguard.llm.common import shuffle_partitions

IDENTITY = [f"i{k}" for k in range(8)]
LIKENESS = [f"l{k}" for k in range(64)]   # two 32-bit lanes each
_LOW = 0xFFFFFFFF
_PAIR = 0x0000000100000001
#: a word run ends after one word in so many (by its hash), and after so many words at most
RUN_WORDS, MOST_WORDS = 3, 8
#: a longer word is cut after one pair of characters in so many, and after LONG_WORD characters at most
LONG_WORD, PIECE_CHARS = 16, 4
_CUT = "\x01"


def _lane_terms() -> list[Column]:
    first = F.col("__first")
    hashes = [F.when(first, F.col(f"__h{k}")).otherwise(F.lit(0)) for k in range(4)]
    out = []
    for h in hashes:
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW))]
    for h in (F.col("__r0"), F.col("__r1")):
        out += [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_PAIR)) for k in range(32)]
    return out


def _sums(extra: list[Column]) -> list[Column]:
    terms = _lane_terms()
    return [*(F.sum(t).alias(n) for t, n in zip(terms, [*IDENTITY, *LIKENESS], strict=True)),
            F.count("*").alias("runs"), *extra]


def _hash_hits(one_in: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(one_in)) == 0


def _pieces(word: Column) -> Column:
    """A word as space-separated pieces, cut by its characters."""
    chars = F.split(word, "")
    cut = F.zip_with(chars, F.slice(chars, 2, F.length(word)), lambda c, after: F.when(
        _hash_hits(PIECE_CHARS, c, after), F.concat(c, F.lit(" "))).otherwise(c))
    return F.regexp_replace(F.array_join(cut, ""), rf"(\S{{{LONG_WORD}}})(?=\S)", "$1 ")


def word_runs(paragraph: Column) -> Column:
    """The paragraph's word runs."""
    short = F.array_join(F.transform(F.split(paragraph, r"\s+"), lambda w: F.when(
        F.length(w) > LONG_WORD, _pieces(w)).otherwise(w)), " ")
    words = F.split(F.when(paragraph.rlike(rf"\S{{{LONG_WORD + 1}}}"), short).otherwise(paragraph), r"\s+")
    marked = F.array_join(F.transform(words, lambda w: F.concat(
        w, F.when(_hash_hits(RUN_WORDS, w), _CUT).otherwise(" "))), "")
    marked = F.regexp_replace(marked, f"[ {_CUT}]$", "")
    word = f"[^ {_CUT}]+"
    return F.split(F.regexp_replace(marked, f"((?:{word} ){{{MOST_WORDS - 1}}}{word}) ", f"$1{_CUT}"), _CUT)


def paragraph_runs(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per word run: ``keep`` columns, the paragraph's hashes (valid where ``__first``)
    and the run's hashes.  A null text counts as empty."""
    paragraphs = texts.select(*keep, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("__p"))
    hashed = paragraphs.select(*keep, *[F.xxhash64(F.lit(k), "__p").alias(f"__h{k}") for k in range(4)],
                               word_runs(F.col("__p")).alias("__runs"))
    runs = hashed.select(*keep, *[f"__h{k}" for k in range(4)], F.posexplode("__runs").alias("__at", "__run"))
    return runs.select(*keep, *[f"__h{k}" for k in range(4)], (F.col("__at") == 0).alias("__first"),
                       F.xxhash64(F.lit("a"), "__run").alias("__r0"), F.xxhash64(F.lit("b"), "__run").alias("__r1"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text", extra: list[Column] | None = None,
                 carry: list[str] | None = None) -> DataFrame:
    """(keys, identity array, likeness array, runs, extra aggregates over ``carry`` columns)."""
    runs = paragraph_runs(texts, text, [*keys, *(carry or [])])
    got = runs.groupBy(*keys).agg(*_sums(extra or []))
    return got.select(*keys, F.array(*[F.col(c).bitwiseAND(F.lit(_LOW)) for c in IDENTITY]).alias("identity"),
                      F.array(*LIKENESS).alias("likeness"), "runs",
                      *[c for c in got.columns if c not in {*keys, *IDENTITY, *LIKENESS, "runs"}])


def combine(a: DataFrame, b: DataFrame, keys: list[str], sign: int = 1) -> DataFrame:
    """Fingerprints after inserting (``sign`` 1) or deleting (-1) the paragraphs of ``b``
    into or from ``a``; keys only in one table keep (or negate, modulo 2^32) its lanes."""
    zero8, zero64 = F.array(*[F.lit(0).cast("long")] * 8), F.array(*[F.lit(0).cast("long")] * 64)
    j = a.alias("a").join(b.alias("b"), keys, "full")

    def lanes(name, zero, mask):
        x, y = F.coalesce(F.col(f"a.{name}"), zero), F.coalesce(F.col(f"b.{name}"), zero)
        return F.zip_with(x, y, lambda p, q: (p + sign * q).bitwiseAND(F.lit(mask)) if mask else p + sign * q).alias(name)

    return j.select(*keys, lanes("identity", zero8, _LOW), lanes("likeness", zero64, None),
                    (F.coalesce("a.runs", F.lit(0)) + sign * F.coalesce("b.runs", F.lit(0))).alias("runs"))


def fingerprint_text(identity: Column, likeness: Column) -> Column:
    """Hex of all lanes."""
    lane = lambda width: lambda x: F.lower(F.lpad(F.hex(x), width, "0"))
    return F.concat(F.array_join(F.transform(identity, lane(8)), ""), F.array_join(F.transform(likeness, lane(16)), ""))


def _centred(likeness: Column, runs: Column) -> Column:
    return F.flatten(F.transform(likeness, lambda x: F.array(
        (2 * F.shiftrightunsigned(x, 32) - runs).cast("double"), (2 * x.bitwiseAND(F.lit(_LOW)) - runs).cast("double"))))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def with_neighbour_edit(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with the place of each document in descending ``key`` order cut into buckets
    (``__b``, ``__n``), its edited text, and a leading copy of the next bucket's head
    (``__ghost``) at the end of every bucket, so that "the next document" is always the next
    row of the bucket.  The one window is partitioned by bucket: no step sees all rows.

    Ties in the key are ordered by text.  Rows without a key stand outside the order: the
    next document of each is empty.
    """
    spark = docs.sparkSession
    parts = 4 * shuffle_partitions(spark)
    base = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = docs.select(F.col(key).alias("doc_id")).where("doc_id is not null")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    splits = [float("-inf"), *(sorted({float(c) for c in cuts}) or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="__d", outputCol="__f", handleInvalid="keep")

    def place(df: DataFrame) -> DataFrame:
        return (bucketed.transform(df.withColumn("__d", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
                .withColumn("__own", F.col("__f").cast("int")).drop("__d", "__f"))

    heads = (place(ids).groupBy("__own").agg(F.max("doc_id").alias("head")).orderBy(F.desc("__own")).collect())
    # at most `parts` rows: the head of each bucket follows the end of the bucket above it
    pairs = [(heads[i]["head"], heads[i - 1]["__own"]) for i in range(len(heads))]
    ghosts = spark.createDataFrame(pairs, "__head long, __above int") if pairs else spark.createDataFrame(
        [], "__head long, __above int")
    placed = place(base).join(F.broadcast(ghosts), F.col("doc_id") == F.col("__head"), "left")
    no_key = F.col("doc_id").isNull()
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")
    at = F.array(F.struct(F.when(no_key, spread).otherwise(F.col("__own")).alias("b"), F.lit(False).alias("g")),
                 F.struct(F.col("__above").alias("b"), F.lit(True).alias("g")))
    rows = (placed.withColumn("__at", F.explode(F.when(F.col("__above").isNull(), F.slice(at, 1, 1)).otherwise(at)))
            .select("doc_id", "text", F.col("__at.b").alias("__b"), F.col("__at.g").alias("__ghost")))
    order = Window.partitionBy("__b").orderBy("__ghost", F.desc("doc_id"), "text")
    rows = rows.withColumn("__n", F.row_number().over(order)).withColumn("__next", F.lead("text").over(order))
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    following = F.when(no_key, F.lit("")).otherwise(F.coalesce("__next", F.lit("")))
    return rows.select("doc_id", "text", "__b", "__n", "__ghost", size.cast("long").alias("n_chars"),
                       F.concat(F.substring("text", F.lit(1), size - half),
                                F.substring(following, F.lit(1), half)).alias("__edited"))


def document_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Null text counts as empty; empty texts have one empty paragraph and are alike (1.0).
    Repeated rows each give a row.  An empty table gives no rows.  A very long text is one text,
    taken whole.  Columns beside the key and the text are not read, whatever their names.
    """
    edited = with_neighbour_edit(docs, key, text)
    sha = F.sha2(F.col("__edited").cast("binary"), 256)
    longs = [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long").alias(f"__s{i}") for i in range(4)]
    both = edited.select("__b", "__n", "__ghost", "doc_id", "n_chars", *longs,
                         F.posexplode(F.when(F.col("__ghost"), F.array("text")).otherwise(F.array("text", "__edited")))
                         .alias("__v", "__t"))
    carry = ["doc_id", "n_chars", *[f"__s{i}" for i in range(4)]]
    prints = fingerprints(both, ["__b", "__n", "__ghost", "__v"], "__t", [F.max(c).alias(c) for c in carry], carry)
    order = Window.partitionBy("__b").orderBy("__n", "__v")
    own = F.struct("identity", "likeness", "runs")
    lined = prints.withColumn("own", own).withColumn("ed", F.lead("own", 1).over(order)).withColumn(
        "nx", F.lead("own", 2).over(order)).where("__v = 0 and not __ghost")
    empty = F.struct(F.array(*[F.lit(0).cast("long")] * 8).alias("identity"),
                     F.array(*[F.lit(0).cast("long")] * 64).alias("likeness"), F.lit(0).cast("long").alias("runs"))
    lined = lined.withColumn("nx", F.when(F.col("doc_id").isNull() | F.col("nx").isNull(), empty).otherwise(F.col("nx")))
    vec = lined
    for x in ("own", "ed", "nx"):
        vec = vec.withColumn(f"{x}_c", _centred(F.col(f"{x}.likeness"), F.col(f"{x}.runs")))
    for x in ("own", "ed", "nx"):
        vec = vec.withColumn(f"{x}_q", _dot(F.col(f"{x}_c"), F.col(f"{x}_c")))

    def likeness(x: str) -> Column:
        same = (F.col("own.identity") == F.col(f"{x}.identity")) & (F.col("own.likeness") == F.col(f"{x}.likeness"))
        size = F.sqrt(F.col("own_q") * F.col(f"{x}_q"))
        cos = F.when(size > 0, _dot(F.col("own_c"), F.col(f"{x}_c")) / F.when(size > 0, size)).otherwise(0.0)
        return F.when(same, 1.0).otherwise(F.least(F.greatest(cos, F.lit(0.0)), F.lit(1.0)))

    digest = reduce(F.concat, [F.lower(F.lpad(F.hex(f"__s{i}"), 16, "0")) for i in range(4)])
    return vec.select("doc_id", "n_chars", digest.alias("edited_sha256"),
                      fingerprint_text(F.col("own.identity"), F.col("own.likeness")).alias("fingerprint"),
                      fingerprint_text(F.col("ed.identity"), F.col("ed.likeness")).alias("edited_fingerprint"),
                      likeness("ed").alias("near_edited"), likeness("nx").alias("near_next"))
