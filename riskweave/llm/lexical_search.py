"""Ranked lexical search, term at a time with limited accumulators.

Documents are read once: each becomes a row of the items' terms that it holds, with their
occurrences, and its number of terms.  Counts over all rows give every term's weight.  Then each
task inverts its rows, block by block, into postings and answers every item term at a time, the
rarest first.  A document gets an accumulator while the terms still to come could lift a new one
to the k-th partial score; from then on accumulators are only updated, exactly.  The k-th score
of a task's earlier blocks counts as well.  Each task passes on k documents an item, which are
merged by rank.  Postings are never shuffled, so a frequent term makes no large task.

Items are taken in batches of about ``BATCH_TERMS`` terms (an item is never cut); the terms and
weights of one batch are what tasks get by broadcast, and documents are read once a batch.

Defined cases: a null text has no terms; a document or item without terms is never in a result;
item rows with the same id and text count once, those with other texts are items of their own,
and an item with a null id is one like others; document rows are ranked each for itself, with a
null id after all others in ties; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch
from riskweave.llm.terms import DIGITS, LETTERS, byte_table, term_lists

BEST = 10
TABLE = byte_table(DIGITS + LETTERS)
BATCH_TERMS = 1 << 18
BLOCK_ROWS = 1 << 14
BLOCK_POSTINGS = 1 << 22
LAST = (1 << 63) - 1
#: Of a document's length, 10 parts count flat and 90 by its share of the mean.
FLAT, BY_LENGTH = 100 - 90, 90


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, iid (the row's key) and its distinct terms."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted({t for part in term_lists(text, TABLE) for t in part})
                for text in batch.column("text").to_pylist()
            ]
            terms = pa.array(found, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("iid"), terms], ["item_id", "iid", "terms"]
            )

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    keyed = texts.select(
        "item_id", F.xxhash64("item_id", "text").alias("iid"), F.col("text").cast("binary")
    )
    return keyed.mapInArrow(rows, "item_id long, iid long, terms array<binary>")


def held_terms(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the document), and number and occurrences of each item term it holds."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = known.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text"):
                size, found = 0, Counter()
                for part in term_lists(text.as_py(), TABLE):
                    size += len(part)
                    found.update(filter(of.__contains__, part))
                sizes.append(size)
                terms.append([of[t] for t in found])
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"],
            )

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return texts.mapInArrow(rows, "doc_id long, n long, terms array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Postings of a block of rows: for each term, documents and their part of the score."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray,
                 terms: np.ndarray, tf: np.ndarray):
        """``lengths`` are the documents' values m, ``sizes`` their numbers of held terms."""
        self.ids = ids
        rows = np.repeat(np.arange(len(ids)), sizes)
        parts = (1_000_000_000 * tf) // (1000 * tf + 8 * lengths[rows])
        order = np.argsort(terms, kind="stable")
        self._terms, self._starts = np.unique(terms[order], return_index=True)
        self._stops = np.append(self._starts[1:], len(order))
        self._rows, self._parts = rows[order], parts[order]

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self._terms, term)
        if at == len(self._terms) or self._terms[at] != term:
            return self._rows[:0], self._parts[:0]
        span = slice(self._starts[at], self._stops[at])
        return self._rows[span], self._parts[span]

    def search(self, terms: list[tuple[int, int]], k: int, floor: int) -> tuple:
        """(score, id) arrays of the best k rows with a score above 0, and accumulators made.

        ``terms`` are (number, weight), the rarest first.  Rows below ``floor`` may be missing.
        """
        lists = [(*self.postings(number), w) for number, w in terms]
        bounds = [w * int(parts.max(initial=0)) for _, parts, w in lists]
        left = sum(bounds)
        scores = np.zeros(len(self.ids), np.int64)
        has = np.zeros(len(self.ids), bool)
        made, growing = 0, True
        for (rows, parts, w), bound in zip(lists, bounds, strict=True):
            if growing:
                held = scores[has] if made >= k else scores[:0]
                kth = int(np.partition(held, made - k)[made - k]) if made >= k else 0
                # A new row can reach ``left`` at most; at equality its id may still win.
                growing = left >= max(kth, floor)
            if not growing:
                survivors = has[rows]
                rows, parts = rows[survivors], parts[survivors]
            scores[rows] += w * parts
            has[rows] = True
            made = int(has.sum()) if growing else made
            left -= bound
        return (*best(scores[has], self.ids[has], k), made)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores above 0 with their ids, ties to the smaller id."""
    keep = scores > 0
    if keep.sum() > k:
        keep &= scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
    scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows gathered until a block is full."""
    held, rows, postings = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            held.append(part)
            rows += part.num_rows
            postings += pa.compute.sum(pa.compute.list_value_length(part.column("terms"))).as_py()
            if rows >= BLOCK_ROWS or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return pa.compute.list_flatten(lists).to_numpy().astype(np.int64, copy=False)


def _ranked(held: DataFrame, queries: list[tuple], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best k rows of each task for each of (iid, item_id, terms)."""
    asked = held.sparkSession.sparkContext.broadcast(queries)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        winners = {query[0]: (none, none) for query in asked.value}
        for table in _blocks(batches):
            sizes = pa.compute.list_value_length(table.column("terms")).to_numpy()
            lengths = np.array([
                FLAT + BY_LENGTH * n * n_docs // n_terms for n in table.column("n").to_pylist()
            ], np.int64)
            block = Block(table.column("doc_id").to_numpy(), sizes, lengths,
                          _flat(table.column("terms")), _flat(table.column("tf")))
            for iid, _, terms in asked.value:
                scores, ids = winners[iid]
                floor = int(scores[-1]) if len(scores) == k else 0
                more, more_ids, _ = block.search(terms, k, floor)
                winners[iid] = best(
                    np.concatenate([scores, more]), np.concatenate([ids, more_ids]), k
                )
        found = [(iid, item, int(i), int(s)) for iid, item, _ in asked.value
                 for s, i in zip(*winners[iid], strict=True)]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["iid", "item_id", "doc_id", "score"]
        )

    return held.mapInArrow(rows, "iid long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, scratch: Scratch, k: int = BEST,
           batch_terms: int = BATCH_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item."""
    spark = docs.sparkSession
    asked = scratch.keep(item_terms(items), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = max(1, -(-total // batch_terms))
    results = []
    for number in range(batches):
        batch = asked.where(F.pmod("iid", F.lit(batches)) == number).collect()
        vocabulary = sorted({bytes(t) for row in batch for t in row.terms})
        numbers = {term: i for i, term in enumerate(vocabulary)}
        held = scratch.keep(held_terms(docs, numbers), f"held-{number}")
        n_docs, n_terms = held.where("n > 0").agg(F.count("n"), F.sum("n")).first()
        df = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        queries = []
        for row in batch:
            present = [i for i in (numbers[bytes(t)] for t in row.terms) if i in df]
            present.sort(key=lambda i: (df[i], i))
            queries.append((row.iid, row.item_id, [(i, weight(n_docs, df[i])) for i in present]))
        results.append(_ranked(held, queries, n_docs, n_terms or 1, k))
    found = reduce(DataFrame.unionByName, results)
    rank = "row_number() over (partition by iid, item_id order by score desc, doc_id)"
    return found.withColumn("rank", F.expr(rank)).where(F.col("rank") <= k).select(
        "item_id", "rank",
        F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"), "score",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(docs, items, Scratch(spark, "lexical-search"))


SQL = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
i as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
d as (select doc_id, count(*)::bigint as n from t group by doc_id),
c as (select count(*)::bigint as docs, sum(n)::bigint as terms from d),
m as (select doc_id, (100 - 90 + (90 * n * docs) // terms)::bigint as m from d, c),
p as (select doc_id, term, count(*)::bigint as tf from t group by doc_id, term),
w as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w
  from (select term, count(*) as df from p group by term), c),
s as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from i join p using (term) join w using (term) join m using (doc_id)
  group by item_id, doc_id),
r as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank
  from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10
"""

QUERIES = {"op12_lexical_search": op12_lexical_search}
ORACLES = {"op12_lexical_search": SQL}
