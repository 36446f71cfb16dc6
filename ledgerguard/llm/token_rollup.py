"""Token totals by source, language and tokenizer version, kept up by signed changes.

The store is a folder: ``deltas/batch=<id>`` holds a batch's additive totals (one row per
group it touches), ``snapshots/<n>`` the sum of the batches listed in it.  A batch counts once
its folder has Spark's ``_SUCCESS`` marker, which the commit writes last: a batch that broke
off is written again from the start, one that is committed again changes nothing.  Totals are
the latest snapshot plus the batches after it; counts can go down as well as up.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerguard.llm.common import binary_column, bounded_batches, pieces_by_bytes, store
from ledgerguard.llm.pretokens import encoder

GROUP = ["source", "lang", "version"]
_SCHEMA = "source string, lang string, version string, docs long, tokens long"


def with_token_count(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text",
                     name: str = "n_tokens") -> DataFrame:
    """(keep columns, ``name``: ids of the whole text; null text counts 0)."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(*[c for c in keep if c != name], F.col(text).alias("__text"))
    at = len(slim.columns) - 1
    schema = slim.drop("__text").withColumn(name, F.lit(0).cast("long")).schema

    def count(batches):
        coder = encoder(vocabulary)
        for batch in pieces_by_bytes(batches, at):
            n = coder.count(binary_column(batch, at))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(n, pa.int64())],
                                             names=[*batch.schema.names[:at], name])

    return slim.mapInArrow(count, schema)


def signed_changes(changes: DataFrame) -> DataFrame:
    """``changes`` has ``before`` and ``after`` structs (source, lang, version, n_tokens): an
    insert has only after, a delete only before, a revision both.  A column ``times``, if there
    is one, says how many equal changes the row stands for.  Gives signed rows; a row with
    neither struct gives none; a null count adds a document without tokens."""
    times = F.col("times").cast("long") if "times" in changes.columns else F.lit(1).cast("long")
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("d")),
                    F.struct(F.lit(1).alias("sign"), F.col("after").alias("d")))
    rows = changes.select(times.alias("n"), F.explode(sides).alias("x")).where("x.d is not null")
    signed = F.col("x.sign") * F.col("n")
    return rows.select(*[F.col(f"x.d.{c}").alias(c) for c in GROUP], signed.cast("long").alias("docs"),
                       (signed * F.coalesce("x.d.n_tokens", F.lit(0))).cast("long").alias("tokens"))


def _sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class TokenRollup:
    """A rollup store in ``folder`` (shared by all executors)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _exists(self, name: str) -> bool:
        path = self._path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _list(self, name: str, marker: str = "_SUCCESS") -> list[str]:
        """Committed entries of a folder."""
        if not self._exists(name):
            return []
        path = self._path(name)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        names = [s.getPath().getName() for s in found]
        return sorted(n for n in names if self._exists(f"{name}/{n}/{marker}"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of changes; False (and no effect) if it was applied before."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError("a batch id has letters, digits, '_', '.' and '-' only")
        if batch in self.batches():
            return False
        _sum(signed_changes(changes)).write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")
        return True

    def batches(self) -> list[str]:
        """Ids of all applied batches."""
        own = {n.removeprefix("batch=") for n in self._list("deltas")}
        return sorted(own | set(self._folded()[1]))

    def _folded(self) -> tuple[str | None, list[str]]:
        snaps = self._list("snapshots", "batches/_SUCCESS")   # a snapshot's batch list is written last
        if not snaps:
            return None, []
        listed = self.spark.read.schema("batch string").parquet(f"{self.folder}/snapshots/{snaps[-1]}/batches")
        return snaps[-1], [r["batch"] for r in listed.collect()]

    def _rows(self) -> DataFrame:
        snap, folded = self._folded()
        paths = [f"{self.folder}/deltas/{n}" for n in self._list("deltas") if n.removeprefix("batch=") not in folded]
        paths += [f"{self.folder}/snapshots/{snap}/totals"] if snap else []
        if not paths:
            return self.spark.createDataFrame([], _SCHEMA)
        parts = [self.spark.read.schema(_SCHEMA).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, parts)

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of groups that hold anything."""
        return _sum(self._rows()).where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Fold all applied batches into a new snapshot; totals and batch ids stay."""
        done = self.batches()
        at = f"{self.folder}/snapshots/{len(self._list('snapshots', 'batches/_SUCCESS')):08d}"
        _sum(self._rows()).write.mode("overwrite").parquet(f"{at}/totals")
        self.spark.createDataFrame([(b,) for b in done], "batch string").coalesce(1).write.mode("overwrite").parquet(
            f"{at}/batches")


def rollup_documents(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """Roll up a document table as its life goes: load with exact counts (version ``exact``)
    and byte-based estimates (version ``final``), revise the estimates to counts with the end
    id, delete the later copies of equal texts, compact, and commit every batch a second time,
    which changes nothing.

    Nulls in source or lang form their own groups; a null text has no tokens and is equal to
    another null text; a row without a key counts as later than rows with one; of repeated
    rows of one key and text one stays.  A very long text is counted whole; an empty table gives
    no rows; columns beside these four are not read, whatever their names.
    """
    spark = docs.sparkSession
    text_hash = F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.sha2(F.col("text").cast("binary"), 256))
    base = docs.select(F.col(key).alias("doc_id"), "source", "lang", text_hash.alias("h"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"), "text")
    counted = store(with_token_count(base, vocabulary, ["doc_id", "source", "lang", "h", "n_bytes"]), "counts")

    def side(version: str, count):
        return F.struct(F.col("source"), F.col("lang"), F.lit(version).alias("version"),
                        F.lit(count).cast("long").alias("n_tokens") if isinstance(count, int)
                        else count.cast("long").alias("n_tokens"))

    none = F.lit(None).cast("struct<source:string,lang:string,version:string,n_tokens:bigint>")
    exact, guess = side("exact", F.col("n_tokens")), side("final", F.ceil(F.col("n_bytes") / 4))
    final = side("final", F.col("n_tokens") + 1)

    def changes(frame: DataFrame, *pairs) -> DataFrame:
        both = F.array(*[F.struct(b.alias("before"), a.alias("after")) for b, a in pairs])
        more = [c for c in frame.columns if c == "times"]
        return frame.select(*more, F.explode(both).alias("c")).select(*more, "c.before", "c.after")

    # copies of a text are counted per source and language before they meet: a text has a
    # handful of rows from then on, however many copies there are
    order = F.struct(F.col("doc_id").isNull().alias("no_key"), "doc_id", "source", "lang")
    per = counted.groupBy("h", "source", "lang").agg(F.count("*").alias("copies"), F.min(order).alias("first"),
                                                     F.first("n_tokens").alias("n_tokens"))
    heads = per.groupBy("h").agg(F.min("first").alias("head"), F.sum("copies").alias("all")).where(F.col("all") > 1)
    stays = F.col("first").eqNullSafe(F.col("head")).cast("int")       # the first copy stays in its group
    leaving = per.join(heads, "h").withColumn("times", F.col("copies") - stays).where(F.col("times") > 0)
    deletes = changes(leaving, (exact, none), (final, none))
    batches = {"load": changes(counted, (none, exact), (none, guess)), "revise": changes(counted, (guess, final)),
               "copies": deletes}
    rollup = TokenRollup(spark, folder)
    for name, change in batches.items():
        rollup.commit(name, change)
    rollup.compact()
    for name, change in batches.items():
        if rollup.commit(name, change):
            raise RuntimeError(f"batch {name} was applied twice")
    return rollup.totals()
