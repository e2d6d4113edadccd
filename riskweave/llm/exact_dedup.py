"""Exact deduplication with a cuckoo-filter index of live digests.

A text's digest is the SHA-256 of the text without white space.  The index is dealt over
shards by digest.  In a shard, a cuckoo filter of 16-bit fingerprints says at once that a
digest is new; on a hit the full digests stored in the two buckets decide.  A full filter is
doubled and filled again from the stored digests.  Digests can be taken out again.

Rows are combined twice: each scan task puts its own rows into an index and passes on one
entry for each digest, and each shard puts those entries into its index.  So a text that makes
up a third of all rows reaches its shard as one entry for each task.

Defined cases: a null text is an empty one; all empty texts are equal; of equal texts the one
with most code points stays, then the smallest doc_id (null last), then of repeated rows one.
Other columns, whatever their names, are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch
from riskweave.llm.sieve import rows_that_stay
from riskweave.llm.texts import partitions, sha256_hex, whole, without_spaces

SLOTS = 4
MOVES = 200
LAST = (1 << 63) - 1
ENTRY = "digest binary, n_points long, keep_id long, keep_row long, n long"


class CuckooIndex:
    """Digest -> entry.  ``entries`` holds the stored keys; slots name them by number."""

    def __init__(self, buckets: int = 64):
        self.keys: list[bytes | None] = []
        self.entries: list[list] = []
        self._free: list[int] = []
        self._allot(buckets)

    def _allot(self, buckets: int) -> None:
        self.buckets = buckets  # a power of two
        self._prints = [0] * (buckets * SLOTS)
        self._numbers = [0] * (buckets * SLOTS)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[:8], "big") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & (self.buckets - 1))

    def _slot(self, digest: bytes) -> int:
        """The digest's slot, or -1.  A fingerprint that fits is checked against the key."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self._prints[slot] == mark and self.keys[self._numbers[slot]] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> list | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.entries[self._numbers[slot]]

    def insert(self, digest: bytes, entry: list) -> None:
        """Add a digest that ``find`` does not have."""
        if self._free:
            number = self._free.pop()
            self.keys[number], self.entries[number] = digest, entry
        else:
            number = len(self.keys)
            self.keys.append(digest)
            self.entries.append(entry)
        if not self._put(digest, number):
            self._grow()

    def delete(self, digest: bytes) -> bool:
        slot = self._slot(digest)
        if slot < 0:
            return False
        number = self._numbers[slot]
        self._prints[slot] = 0
        self.keys[number], self.entries[number] = None, []
        self._free.append(number)
        return True

    def _put(self, digest: bytes, number: int) -> bool:
        mark, bucket, second = self._places(digest)
        for at in (bucket, second):
            for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                if not self._prints[slot]:
                    self._prints[slot], self._numbers[slot] = mark, number
                    return True
        for move in range(MOVES):
            slot = bucket * SLOTS + (number + move) % SLOTS
            self._prints[slot], mark = mark, self._prints[slot]
            self._numbers[slot], number = number, self._numbers[slot]
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self._prints[free]:
                    self._prints[free], self._numbers[free] = mark, number
                    return True
        return False

    def _grow(self) -> None:
        """Double until every stored key has a slot."""
        full = True
        while full:
            self._allot(self.buckets * 2)
            full = not all(
                self._put(key, number) for number, key in enumerate(self.keys) if key is not None
            )

    def live(self) -> Iterator[tuple[bytes, list]]:
        return ((k, e) for k, e in zip(self.keys, self.entries, strict=True) if k is not None)


def _better(new: list, old: list) -> bool:
    """More code points, then the smaller id (null last), then the earlier row."""
    return (-new[0], LAST if new[1] is None else new[1], new[1] is None, new[2]) < (
        -old[0], LAST if old[1] is None else old[1], old[1] is None, old[2])


def add_entries(index: CuckooIndex, rows: Iterable[tuple]) -> None:
    """Put (digest, code points, doc_id, row, number of rows) into the index.

    A live digest's entry is taken out and the better row's put in when the new row is better.
    """
    for digest, *new in rows:
        old = index.find(digest)
        if old is None:
            index.insert(digest, new)
        elif _better(new, old):
            index.delete(digest)
            index.insert(digest, [*new[:3], new[3] + old[3]])
        else:
            old[3] += new[3]


def _entries(index: CuckooIndex) -> pa.RecordBatch:
    live = list(index.live())
    columns = list(zip(*(e for _, e in live), strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in live], pa.binary()), *(pa.array(c, pa.int64()) for c in columns)],
        ["digest", "n_points", "keep_id", "keep_row", "n"],
    )


def _rows(batch: pa.RecordBatch | pa.Table, names: tuple[str, ...]) -> Iterable[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a task; the numbers are written once and stay."""
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        numbers = pa.array(range(row, row + batch.num_rows), pa.int64())
        row += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], [*batch.schema.names, "row"])


def _local_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        rows = _rows(batch, ("digest", "n_points", "doc_id", "row"))
        add_entries(index, ((*r, 1) for r in rows))
    yield _entries(index)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, code points and hash of the text of every row."""
    text = whole(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(sha256_hex(without_spaces(text))).alias("digest"),
        F.char_length(text).cast("long").alias("n_points"),
        F.xxhash64(text).alias("text_hash"),
    )


def live_index(entries: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """One entry for each live digest, from entries of any number of tasks or batches.

    ``withdrawn`` (digest) lists digests to take out of the index after all insertions.
    """
    shards = partitions(entries.sparkSession)
    gone = F.lit(False)
    rows = entries.withColumn("gone", gone)
    if withdrawn is not None:
        empty = [F.lit(None).cast("long").alias(c) for c in entries.columns[1:]]
        rows = rows.unionByName(
            withdrawn.select("digest", *empty, F.lit(True).alias("gone")).distinct()
        )

    def shard(table: pa.Table) -> pa.Table:
        index = CuckooIndex()
        names = ("digest", "n_points", "keep_id", "keep_row", "n")
        stays = table.filter(pa.compute.invert(table.column("gone")))
        add_entries(index, _rows(stays, names))
        for digest in table.filter(table.column("gone")).column("digest").to_pylist():
            index.delete(digest)
        return pa.Table.from_batches([_entries(index)])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(shard, ENTRY)


def _decided(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``decide`` and the hash of each row's text."""
    schema = "doc_id long, digest binary, n_points long, text_hash long, row long"
    rows = scratch.keep(digests(docs).mapInArrow(_numbered, schema), "digests")
    index = scratch.keep(live_index(rows.mapInArrow(_local_index, ENTRY)), "index")
    # Two plain scans below the join: a digest with very many rows can be split at run time.
    joined = rows.join(index.select("digest", "keep_id", "keep_row", "n"), "digest")
    return joined.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_hash",
    )


def decide(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    return _decided(docs, scratch).drop("text_hash")


def keep_one(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The document rows that stay, with all their columns, whatever their names.

    Rows alone with their text, told by a sieve, are passed on as they are read; only those that
    may belong to a group are shuffled to meet the list of what stays.
    """
    in_groups = _decided(docs, scratch).where("group_size > 1").groupBy(
        F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")
    ).agg(F.bool_or("kept").alias("stays"))
    return rows_that_stay(docs, scratch.keep(in_groups, "grouped"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decide(docs, Scratch(spark, "exact-dedup"))


SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
  from documents),
g as (
  select text_sha256, count(*) as group_size,
    arg_min(doc_id, (-n, doc_id)) as keep_id
  from t group by text_sha256)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, t.text_sha256
from t join g using (text_sha256)
"""

QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLES = {"op3_exact_dedup": SQL}
