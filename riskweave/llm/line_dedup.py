"""Line deduplication against levelled sorted runs of line hashes.

A line's key is the line stripped of white space at both ends, A-Z lower-cased; keys below
ten code points are left alone.  The first document to hold a key owns it, and every other
document loses its lines with that key.

Texts come in batches of ascending doc_id.  The keys seen so far are kept as runs: tables of
(hash, owner) sorted by hash, each key in one run.  A batch takes its own distinct keys, with
the smallest doc_id, drops those in any run by a merge anti join, and writes the rest as a new
run of level 0.  When a level holds ``FANOUT`` runs they are merged into one run of the next
level.  Keys are two 64-bit hashes, so equal hashes mean equal keys.

Defined cases: a null or empty text is one empty line; rows with the same doc_id are one
document, whose rows each come out; null ids are one document that comes last; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch
from riskweave.llm.texts import (
    SPACES,
    free_names,
    lower_ascii,
    partitions,
    sha256_hex,
    whole,
)

SHORTEST = 10
BATCHES = 4
FANOUT = 3
HASH = ["h1", "h2"]
LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


class Runs:
    """The keys seen so far."""

    def __init__(self, scratch: Scratch, fanout: int = FANOUT):
        self.scratch, self.fanout = scratch, fanout
        self.levels: list[list[DataFrame]] = []
        self._written = 0

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys that no run has."""
        for run in self.all():
            keys = keys.join(run.hint("merge"), HASH, "left_anti")
        return keys

    def _write(self, rows: DataFrame, level: int) -> DataFrame:
        self._written += 1
        parts = partitions(self.scratch.spark)
        ordered = rows.repartition(parts, *HASH).sortWithinPartitions(*HASH)
        return self.scratch.keep(ordered, f"run-{self._written}-level-{level}")

    def absorb(self, keys: DataFrame) -> None:
        """Add the distinct keys (h1, h2, owner) of a batch and compact full levels."""
        run, level = self._write(self.unseen(keys), 0), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            level += 1
            run = self._write(merged, level)


def _batch_of(id_: Column, docs: DataFrame, batches: int) -> Column:
    """Number of the batch: ranges of ascending doc_id with about equally many rows."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares)).first()[0] or []
    above = (F.when(id_ > cut, 1).otherwise(0) for cut in cuts)
    return reduce(Column.__add__, above, F.lit(0))


def line_hashes(docs: DataFrame, batch: Column) -> DataFrame:
    """Row key (rid, rhash), line position, key hashes and batch of every line that counts."""
    text = whole(F.col("text"))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rid"),
        F.xxhash64(text).alias("rhash"),
        _lines(F.col("text")).alias("lines"),
    )
    lines = rows.select("rid", "rhash", F.posexplode("lines").alias("pos", "line"))
    keyed = lines.select("rid", "rhash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= SHORTEST).select(
        "rid", "rhash", "pos",
        F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"),
        batch.alias("batch"),
    )


def dropped_lines(docs: DataFrame, scratch: Scratch, batches: int = BATCHES) -> DataFrame:
    """(rid, rhash, pos) of the lines that go."""
    lines = scratch.keep(
        line_hashes(docs, _batch_of(F.col("rid"), docs, batches)), "lines", by="batch"
    )
    runs = Runs(scratch)
    for number in range(batches):
        own = lines.where(F.col("batch") == number)
        runs.absorb(own.groupBy(*HASH).agg(F.min("rid").alias("owner")))
    keys = reduce(DataFrame.unionByName, runs.all())
    return lines.join(keys, HASH).where(F.col("rid") > F.col("owner")).select("rid", "rhash", "pos")


def _kept(lines: str, drops: str) -> str:
    """The lines outside the sorted positions, as slices between neighbouring positions."""
    return f"""flatten(transform(sequence(0, size({drops})), i -> slice({lines},
        if(i = 0, 0, get({drops}, i - 1) + 1) + 1,
        if(i = size({drops}), size({lines}), get({drops}, i))
            - if(i = 0, 0, get({drops}, i - 1) + 1))))"""


def dedup_lines(docs: DataFrame, scratch: Scratch, batches: int = BATCHES) -> DataFrame:
    """All columns of the documents, with ``n_lines``, ``n_dropped`` and the text ``kept_text``.

    A new column takes an underscore more where the caller has one of its name, in any case.
    """
    drops = scratch.keep(dropped_lines(docs, scratch, batches), "drops")
    by_row = drops.groupBy("rid", "rhash").agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    rows = docs.select(
        F.struct("*").alias("row"), whole(F.col("text")).alias("whole"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("own_id"),
        F.xxhash64(whole(F.col("text"))).alias("own_hash"),
    )
    joined = rows.join(
        by_row, (F.col("own_id") == F.col("rid")) & (F.col("own_hash") == F.col("rhash")), "left"
    )
    n_lines, n_dropped, kept_text = free_names(docs, "n_lines", "n_dropped", "kept_text")
    kept = F.array_join(F.expr(_kept("lines", "drops")), "\n")
    none = F.col("drops").isNull()
    return joined.withColumn("lines", _lines(F.col("whole"))).select(
        "row.*",
        F.size("lines").cast("long").alias(n_lines),
        F.when(none, 0).otherwise(F.size("drops")).cast("long").alias(n_dropped),
        F.when(none, F.col("whole")).otherwise(kept).alias(kept_text),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, Scratch(spark, "line-dedup")).select(
        "doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept_text")).alias("kept_sha256")
    )


SQL = r"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from split),
k as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
o as (
  select key, min(doc_id) as owner from k where length(key) >= 10
  group by key having count(distinct doc_id) > 1)
select k.doc_id, count(*) as n_lines,
  count(*) filter (o.owner < k.doc_id) as n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) order by k.pos)
    filter (o.owner is null or o.owner = k.doc_id), '')) as kept_sha256
from k left join o using (key) group by k.doc_id
"""

QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLES = {"op7_line_dedup": SQL}
