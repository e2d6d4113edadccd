"""How much the sources of a language differ in their words, by in-mapper stripes.

Each task folds whole documents into one stripe a language and term: the number of documents
that hold the term, and its occurrences in each source.  When stripes outgrow ``SPILL``, those
of one document so far are spilled, or all if that frees too little; so a task's memory is
bounded, and frequent terms stay until its end.  Stripes of equal keys are merged behind one
shuffle, to which a frequent term or a large source comes as one stripe a task.  Stripes with
enough documents are written; their sums give every group's size.  The merged stripes then emit
the divergences: shards of bounded size, each together with the group sizes, give sums for pairs
of sources and the best terms of each group.

Every sum is exact: shares by long division in steps of a thousand, all else in integers that
stay below 2**63.

Defined cases: null text, lang and source count as empty strings; a group without kept terms has
all its shares equal; a language without kept terms has pairs of value 0 and no terms; a
language of one source has no pairs; rows with a repeated or null doc_id are documents of their
own; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch
from riskweave.llm.terms import LETTERS, byte_table, term_lists

LEAST_DOCS = 3
BEST = 200
UNIT_STEPS = 3  # shares are in units of 1000 ** -3
TABLE = byte_table(LETTERS)
#: Memory of a task's stripes in units of about 40 bytes: a stripe takes some, a cell one.
SPILL = 1 << 21
STRIPE_UNITS = 6
BATCH = 1 << 16
SHARD = 1 << 19
CELLS = 1 << 20
#: Stripe that lists a language's sources.  No term is empty.
NO_TERM = b""
STRIPE = "lang string, term binary, df long, source array<string>, n array<long>"
FOUND = "lang string, source string, part string, item binary, value long"


class Stripes:
    """A task's stripes: lang -> term -> source -> occurrences, documents under None."""

    def __init__(self, spill: int = SPILL):
        self._spill = spill
        self.units = 0
        self._of: dict[str, dict[bytes, dict[str | None, int]]] = {}

    def add(self, lang: str, source: str, text: bytes | None) -> None:
        counts = Counter()
        for part in term_lists(text, TABLE):
            counts.update(part)
        terms = self._of.setdefault(lang, {})
        terms.setdefault(NO_TERM, {None: 0})[source] = 0
        for term, n in counts.items():
            stripe = terms.get(term)
            if stripe is None:
                terms[term] = {None: 1, source: n}
                self.units += STRIPE_UNITS + 1
            elif source in stripe:
                stripe[None] += 1
                stripe[source] += n
            else:
                stripe[None] += 1
                stripe[source] = n
                self.units += 1

    def full(self) -> bool:
        return self.units >= self._spill

    def spill(self) -> Iterator[pa.RecordBatch]:
        yield from self._drain(lambda df: df == 1)
        if self.units > self._spill * 4 // 5:
            yield from self.drain()

    def drain(self) -> Iterator[pa.RecordBatch]:
        return self._drain(lambda df: True)

    def _drain(self, goes: Callable[[int], bool]) -> Iterator[pa.RecordBatch]:
        self.units = 0
        for lang, terms in self._of.items():
            leaving = [term for term, stripe in terms.items() if goes(stripe[None])]
            for start in range(0, len(leaving), BATCH):
                names = leaving[start:start + BATCH]
                stripes = [terms.pop(name) for name in names]
                df = [stripe.pop(None) for stripe in stripes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array(names, pa.binary()),
                     pa.array(df, pa.int64()),
                     pa.array([list(stripe) for stripe in stripes], pa.list_(pa.string())),
                     pa.array([list(stripe.values()) for stripe in stripes],
                              pa.list_(pa.int64()))],
                    ["lang", "term", "df", "source", "n"],
                )
            self.units += sum(STRIPE_UNITS + len(stripe) - 1 for stripe in terms.values())


def partial_stripes(docs: DataFrame, spill: int = SPILL) -> DataFrame:
    """Every task's stripes, a key once for each time that it is spilled."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes(spill)
        for batch in batches:
            columns = (batch.column(name) for name in ("lang", "source", "text"))
            for lang, source, text in zip(*columns, strict=True):
                stripes.add(lang.as_py(), source.as_py(), text.as_py())
                if stripes.full():
                    yield from stripes.spill()
        yield from stripes.drain()

    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("binary").alias("text"),
    )
    return texts.mapInArrow(rows, STRIPE)


def merged_cells(partial: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, source and n of kept terms, each once.  One shuffle, by lang and term.

    Most terms are rare and go before their cells are added up.
    """
    documents = F.sum("df").over(Window.partitionBy("lang", "term"))
    dealt = partial.repartition("lang", "term").withColumn("documents", documents)
    kept = dealt.where((F.col("documents") >= least) | (F.col("term") == F.lit(NO_TERM)))
    cells = kept.select("lang", "term", F.explode(F.arrays_zip("source", "n")).alias("cell"))
    return cells.groupBy("lang", "term", F.col("cell.source").alias("source")).agg(
        F.sum("cell.n").alias("n")
    )


def group_sizes(cells: DataFrame) -> DataFrame:
    """lang, source, size (occurrences of kept terms) and kept (the language's kept terms)."""
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    kept = cells.select("lang", "term").distinct().groupBy("lang").agg(
        (F.count(F.lit(1)) - 1).alias("kept")
    )
    return sizes.join(kept, "lang")


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), without leaving 64 bits."""
    rest = count + 1
    units = rest // total
    for _ in range(UNIT_STEPS):
        rest = rest % total * 1000
        units = units * 1000 + rest // total
    return units + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _language(lang: str, cells: pa.Table, groups: pa.Table, best: int) -> Iterator[pa.Table]:
    """Partial pair sums and best terms of one language's cells, which are sorted by term."""
    sources = groups.column("source").to_pylist()
    sizes = groups.column("size").to_numpy().astype(np.int64)
    kept = groups.column("kept")[0].as_py()
    step = max(1, CELLS // len(sources))
    encoded = np.array([s.encode() for s in sources] + [None], object)[:-1]
    coded = cells.column("term").combine_chunks().dictionary_encode()
    names, row = _plain(coded).dictionary.to_pylist(), _plain(coded).indices.to_numpy()
    column = pa.compute.index_in(
        cells.column("source"), value_set=pa.array(sources, pa.string())).to_numpy()
    occurrences = cells.column("n").to_numpy()

    def table(source, part, items, values) -> pa.Table:
        n = len(values)
        return pa.table({
            "lang": pa.array([lang] * n, pa.string()), "source": pa.array([source] * n, pa.string()),
            "part": pa.array([part] * n, pa.string()), "item": pa.array(items, pa.binary()),
            "value": pa.array(values, pa.int64()),
        })

    for start in range(0, max(1, len(names)), step):
        terms = np.array(names[start:start + step] + [None], object)[:-1]
        own = slice(*np.searchsorted(row, [start, start + step]))
        counts = np.zeros((len(terms), len(sources)), np.int64)
        counts[row[own] - start, column[own]] = occurrences[own]
        p = share(counts, np.maximum(sizes + kept, 1))
        q = share(counts.sum(axis=1), max(1, int(sizes.sum()) + kept))
        for g, source in enumerate(sources):
            sums = gap(p[:, g:g + 1], p).sum(axis=0)
            others = np.arange(len(sources)) != g
            yield table(source, "pair", list(encoded[others]), sums[others])
            rows = np.flatnonzero((counts[:, g] > 0) & (p[:, g] > q))
            values = gap(p[rows, g], q[rows])
            first = np.argsort(-values, kind="stable")[:best]
            yield table(source, "term", list(terms[rows[first]]), values[first])


def _plain(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def _shard(cells: pa.Table, groups: pa.Table, best: int) -> pa.Table:
    """Rows of ``FOUND`` of one shard.  Shard 0 names every pair, even without cells."""
    compute = pa.compute
    groups = groups.sort_by([("lang", "ascending"), ("source", "ascending")])
    cells = cells.sort_by([("lang", "ascending"), ("term", "ascending")])
    first = groups.num_rows > 0 and groups.column("shard")[0].as_py() == 0
    found = []
    for lang in compute.unique(groups.column("lang")).to_pylist():
        own = cells.filter(compute.equal(cells.column("lang"), lang))
        if first or own.num_rows:
            of_lang = groups.filter(compute.equal(groups.column("lang"), lang))
            found += _language(lang, own, of_lang, best)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()),
                        ("item", pa.binary()), ("value", pa.int64())])
    return pa.concat_tables([t.cast(schema) for t in found]) if found else schema.empty_table()


def divergences(docs: DataFrame, scratch: Scratch, least: int = LEAST_DOCS, best: int = BEST,
                spill: int = SPILL, shard: int = SHARD) -> DataFrame:
    """lang, source, part, item, value and rank: every other source, and the best terms."""
    cells = scratch.keep(merged_cells(partial_stripes(docs, spill), least), "stripes")
    groups = scratch.keep(group_sizes(cells), "groups")
    shards = max(1, -(-cells.count() // shard))
    dealt = cells.where(F.col("term") != F.lit(NO_TERM)).withColumn(
        "shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int")
    )
    sizes = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = dealt.groupBy("shard").cogroup(sizes.groupBy("shard")).applyInArrow(
        lambda left, right: _shard(left, right, best), FOUND
    )
    # A term stands in one shard; a pair has a sum from each.
    keys = ["lang", "source", "part", "item"]
    summed = found.groupBy(*keys).agg(F.sum("value").alias("value"))
    rank = "row_number() over (partition by lang, source, part order by value desc, item)"
    ranked = summed.withColumn("rank", F.expr(rank))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= best)).withColumn(
        "item", F.col("item").cast("string")
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return divergences(docs, Scratch(spark, "source-divergence"))


SQL = r"""
with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
t as (select rid, lang, source, unnest(terms) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct rid) >= 3),
g as (select distinct lang, source from d),
c as (
  select lang, source, term, count(*)::hugeint as n
  from t join kept using (lang, term) group by lang, source, term),
v as (select lang, (select count(*) from kept k where k.lang = g.lang) as v from g group by lang),
gn as (
  select g.lang, g.source, coalesce(sum(c.n), 0)::hugeint as total
  from g left join c using (lang, source) group by g.lang, g.source),
ln as (select lang, sum(total)::hugeint as total from gn group by lang),
gp as (
  select k.lang, gn.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (gn.total + v.v) as p
  from kept k join gn using (lang) join v using (lang)
  left join c on c.lang = k.lang and c.source = gn.source and c.term = k.term),
lp as (
  select lang, term, 1 + (1000000000 * (sum(n) + 1)) // (any_value(ln.total) + any_value(v.v)) as p
  from gp join ln using (lang) join v using (lang) group by lang, term),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item,
    coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join gp x on x.lang = a.lang and x.source = a.source
  left join gp y on y.lang = a.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
terms as (
  select gp.lang, gp.source, 'term' as part, gp.term as item,
    ((gp.p - lp.p) * (gp.p - lp.p)) // lp.p as value
  from gp join lp on lp.lang = gp.lang and lp.term = gp.term
  where gp.n > 0 and gp.p > lp.p),
r as (
  select *, row_number() over (
    partition by lang, source, part order by value desc, encode(item))::int as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank
from r where part = 'pair' or rank <= 200
"""

QUERIES = {"op13_source_divergence": op13_source_divergence}
ORACLES = {"op13_source_divergence": SQL}
