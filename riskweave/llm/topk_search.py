"""Exact top-k search by inner product, one term at a time.

A vector's components are terms with integer weights.  Candidates are kept as postings: for each
term, the candidates that have it and their weights.  A query scatters, term by term, its weight
times the postings into a dense array of scores, one for each candidate; the k best are selected
by partition.  Every query meets every candidate.

Queries and candidates are dealt into blocks by hash.  Each pair of blocks is one task of fixed
size, and the winners of a query's tasks are merged by rank.  A query row is sent once to every
candidate block and a candidate row once to every query block; pairs of rows are never made.

Defined cases: vectors that are null or hold a null, a NaN or an infinity take no part; missing
terms count as 0, so vectors of different lengths can meet and an empty vector scores 0 with all;
rows with the query's own id are no candidates; query rows repeated with the same vector count
once, candidate rows each time; a null id can be found, after all others in ties, but is no
query; components beyond the range of a long are held at its ends and sums wrap around; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BEST = 5
SCALE = 256
EVERY = 50
QUERY_BLOCK = 16384
CANDIDATE_BLOCK = 16384
LAST = (1 << 63) - 1


class Postings:
    """Weighted postings of a block of sparse rows."""

    def __init__(self, offsets: np.ndarray, values: np.ndarray):
        self.n = len(offsets) - 1
        sizes = np.diff(offsets)
        rows = np.repeat(np.arange(self.n), sizes)
        terms = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
        there = np.flatnonzero(values)
        order = there[np.argsort(terms[there], kind="stable")]
        self._rows, self._weights = rows[order], values[order]
        last = int(terms.max(initial=-1)) + 1
        self._starts = np.searchsorted(terms[order], np.arange(last + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Scores of all rows, accumulated term by term."""
        found = np.zeros(self.n, np.int64)
        for term in np.flatnonzero(query[: len(self._starts) - 1]):
            start, stop = self._starts[term], self._starts[term + 1]
            weighted = self._weights[start:stop] * query[term]
            if stop - start == self.n:  # every row has the term
                found += weighted
            else:
                found[self._rows[start:stop]] += weighted
        return found


def select_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, best first, ties to the smaller position."""
    n = len(scores)
    if n > k:
        least = np.partition(scores, n - k)[n - k]
        above = np.flatnonzero(scores > least)
        tied = np.flatnonzero(scores == least)[: k - len(above)]
        chosen = np.concatenate([above, tied])
    else:
        chosen = np.arange(n)
    # The complement of an integer orders like its negative and cannot overflow.
    return chosen[np.lexsort((chosen, ~scores[chosen]))]


def _vectors(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = np.asarray(lists.offsets)
    values = np.asarray(lists.values)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], values.astype(np.int64, copy=False)


def _block(table: pa.Table, k: int) -> pa.Table:
    """The best k candidates of the block for each of its queries."""
    is_query = table.column("is_query")
    queries = table.filter(is_query)
    rows = table.filter(pa.compute.invert(is_query)).sort_by("vec_id")
    out: list[list[np.ndarray]] = [[], [], [], []]
    if queries.num_rows and rows.num_rows:
        ids = rows.column("vec_id").to_numpy()
        postings = Postings(*_vectors(rows.column("v")))
        offsets, values = _vectors(queries.column("v"))
        keys = queries.column("key").to_numpy()
        for i, own in enumerate(queries.column("vec_id").to_numpy()):
            scores = postings.scores(values[offsets[i]:offsets[i + 1]])
            first, last = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            others = np.delete(np.arange(len(ids)), slice(first, last)) if first < last else None
            best = select_best(scores if others is None else scores[others], k)
            best = best if others is None else others[best]
            for column, found in zip(
                out, (np.full(len(best), own), np.full(len(best), keys[i]), ids[best],
                      scores[best]), strict=True
            ):
                column.append(found)
    names = ["query_id", "key", "vec_id", "score"]
    arrays = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
    return pa.table({n: pa.array(a, pa.int64()) for n, a in zip(names, arrays, strict=True)})


def integer_vectors(rows: DataFrame) -> DataFrame:
    """vec_id (null as the largest long) and v, the scaled components rounded down."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.where(F.col("embedding").isNotNull() & finite).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("vec_id"), scaled.alias("v")
    )


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def search(queries: DataFrame, candidates: DataFrame, k: int = BEST) -> DataFrame:
    """query_id, rank, vec_id and score from rows of (vec_id, v)."""
    queries = queries.select("vec_id", "v").distinct().withColumn("key", F.xxhash64("v"))
    query_blocks = _blocks(queries.count(), QUERY_BLOCK)
    candidate_blocks = _blocks(candidates.count(), CANDIDATE_BLOCK)
    left = queries.select(
        "vec_id", "v", "key", F.lit(True).alias("is_query"),
        F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb"),
        _each(candidate_blocks).alias("cb"),
    )
    right = candidates.select(
        "vec_id", "v", F.lit(0).cast("long").alias("key"), F.lit(False).alias("is_query"),
        _each(query_blocks).alias("qb"),
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(candidate_blocks)).cast("int").alias("cb"),
    )
    cells = left.unionByName(right).groupBy("qb", "cb")
    found = cells.applyInArrow(
        lambda table: _block(table, k), "query_id long, key long, vec_id long, score long"
    )
    rank = "row_number() over (partition by query_id, key order by score desc, vec_id)"
    return found.withColumn("rank", F.expr(rank)).where(F.col("rank") <= k).select(
        "query_id", "rank",
        F.when(F.col("vec_id") < LAST, F.col("vec_id")).alias("vec_id"), "score",
    )


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    asked = vectors.where((F.col("vec_id") % EVERY == 0) & (F.col("vec_id") < LAST))
    return search(asked, vectors)


SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from v q join v c on q.vec_id % {EVERY} = 0 and q.vec_id <> c.vec_id),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from s)
select query_id, rank, vec_id, score from r where rank <= {BEST}
"""

QUERIES = {"op10_topk_search": op10_topk_search}
ORACLES = {"op10_topk_search": SQL}
