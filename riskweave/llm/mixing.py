"""Mixing sources to target weights with hash-threshold histograms.

Every source gets a target number of words.  Whole passes over a source come first; of what is
left, documents whose hash is below the source's threshold are taken once more.  The threshold
comes from sums of words by source and hash bucket: the running sum names the bucket in which
the budget ends, and only that bucket is divided further, ``LEVELS`` times.  Documents are then
filtered by comparing hashes; nothing is sorted by document.  The hash is MD5 of doc_id and
size, so reruns agree.  Where several rows have the boundary's hash, digits of the text's MD5
divide them, and rows alike in these, too, are divided by digits of a row number.

A histogram has at most 4096 rows for each source and level, summed before the shuffle, so a
source with a third of all rows costs no more than any other.  The last boundary bucket is
taken if that brings the source nearer to its target, so the mix misses a target by half a
document's size.

Defined cases: a null text has size 0; a null source is a source, the last one; rows with the
same id, size and text are taken in such numbers as the target needs, and which of them is open;
with no words at all every target is 0; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.scratch import Scratch
from riskweave.llm.texts import whole

WEIGHTS = (5, 2, 1)
MOST = 3
DIGITS = 3  # hexadecimal digits for each level: 4096 buckets
LEVELS = 4  # for each of the hash's three parts


def _size_and_hash() -> tuple[Column, Column]:
    """Words of a row's text, and the hash: of id and size, of the text, of a row number."""
    text = whole(F.col("text"))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    id_ = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    parts = (
        F.concat_ws(":", id_, size.cast("string")), text,
        F.monotonically_increasing_id().cast("string"),
    )
    digits = (F.substring(F.md5(part.cast("binary")), 1, DIGITS * LEVELS) for part in parts)
    return size, F.concat(*digits)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and hash."""
    size, hash_ = _size_and_hash()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"),
        hash_.alias("hash"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target and the number of whole passes, one row per source.

    Weights repeat over the sources in code point order, null last.  A target is the weight
    times one level common to all sources, but at most ``MOST`` times the source.  Sources reach
    that limit in the order of size over weight, so the level follows from running sums.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    choices = "array(" + ", ".join(f"{w}L" for w in weights) + ")"
    numbered = by_source.selectExpr(
        "*", "row_number() over (order by source nulls last) - 1 as i"
    ).selectExpr("*", f"get({choices}, cast(i % {len(weights)} as int)) as weight")
    ranked = numbered.selectExpr("*", f"{MOST} * source_size as cap").selectExpr(
        "*",
        "sum(source_size) over () as all_size",
        "sum(weight) over () as all_weight",
        "sum(cap) over (order by cap / weight, i) - cap as caps_before",
        "sum(weight) over (order by cap / weight, i) - weight as weights_before",
    )
    levelled = ranked.selectExpr(
        "*", "(all_size - caps_before) / (all_weight - weights_before) as level"
    ).selectExpr(
        # The first source, in this order, that its limit does not bind sets the level.
        "*", "min(if(weight * level <= cap, struct(cap / weight as r, i, level), null)) over ()"
             ".level as common",
    )
    return levelled.selectExpr(
        "source", "source_size",
        "cast(least(cap, weight * coalesce(common, 0)) as double) as target",
    ).selectExpr(
        "*", "if(source_size = 0, 0L, cast(floor(target / source_size) as bigint)) as passes"
    )


def _on_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join the few rows per source; Spark broadcasts them only if their size allows."""
    named = right.withColumnRenamed("source", "_source")
    return left.join(named, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def thresholds(sized: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """source and the hash ``below`` which documents are taken once more.

    ``edge`` is the last boundary bucket, ``with_edge`` whether it is taken, too.
    """
    state = wanted.select(
        "source",
        (F.col("target") - F.col("passes") * F.col("source_size")).alias("left_over"),
        F.lit("").alias("edge"),
    )
    for level in range(1, 3 * LEVELS + 1):
        # Within the boundary buckets so far: sums by the next digits.
        inside = _on_source(sized, state).where(F.col("hash").startswith(F.col("edge")))
        bucket = F.substring("hash", 1, DIGITS * level)
        histogram = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        running = histogram.selectExpr(
            "*", "sum(words) over (partition by source order by bucket) as upto"
        )
        # The boundary bucket is the last that begins within what is left over.
        begun = _on_source(running, state.select("source", "left_over")).where(
            "upto - words <= left_over"
        )
        last = begun.groupBy("source").agg(
            F.max(F.struct("bucket", F.col("upto") - F.col("words"), "words", "rows")).alias("b")
        ).select("source", "b.*").toDF("source", "bucket", "before", "words", "rows")
        state = scratch.keep(
            _on_source(state.select("source", "edge", "left_over"), last).selectExpr(
                "source", "coalesce(bucket, edge) as edge",
                "left_over - coalesce(before, 0) as left_over",
                "coalesce(words, 0) as edge_words", "coalesce(rows, 0) as edge_rows",
            ),
            f"level-{level}",
        )
        if level >= LEVELS and not state.where("edge_rows > 1 and edge_words > 0").limit(1).count():
            break
    return state.selectExpr("source", "edge", "edge_words > 0 and 2 * left_over >= edge_words as with_edge")


def _plan(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...]) -> tuple:
    """The sized rows, and one row per source that says which of them are taken."""
    sized = scratch.keep(sizes(docs), "sizes")
    wanted = scratch.keep(targets(sized, weights), "targets")
    cut = scratch.keep(thresholds(sized, wanted, scratch), "thresholds")
    return sized, scratch.keep(_on_source(wanted, cut), "plan")


_BEGINNING = "left(hash, length(edge))"
_TIMES = (
    f"passes + if(passes < {MOST} and"
    f" ({_BEGINNING} < edge or ({_BEGINNING} = edge and with_edge)), 1, 0)"
)


def mix(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target and ``times`` the document is taken."""
    sized, plan = _plan(docs, scratch, weights)
    return _on_source(sized, plan).selectExpr(
        "doc_id", "source", "size", "source_size", "target", f"{_TIMES} as times"
    )


def repeat(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The document rows of the mix, each as often as it is taken, with all their columns.

    A row's hash is taken where the row is read and meets the few rows of the plan there, so
    texts are not shuffled while the plan fits a broadcast.
    """
    _, plan = _plan(docs, scratch, weights)
    _, hash_ = _size_and_hash()
    rows = docs.select(F.struct("*").alias("row"), "source", hash_.alias("hash"))
    taken = _on_source(rows, plan).selectExpr("row", f"cast({_TIMES} as int) as times")
    copies = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return taken.where("times > 0").select("row", copies).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, Scratch(spark, "mixing")).selectExpr(
        "doc_id", "size", "source_size", "target", "size * times as taken"
    )


SQL = rf"""
with t as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
h as (
  select *, left(md5(coalesce(doc_id::varchar, '') || ':' || size::varchar), {DIGITS * LEVELS})
    as hash from t),
s as (
  select source, sum(size)::bigint as source_size,
    row_number() over (order by source nulls last) - 1 as i from t group by source),
w as (select *, [{', '.join(map(str, WEIGHTS))}][1 + i % {len(WEIGHTS)}] as weight,
    {MOST} * source_size as cap from s),
r as (
  select *, (sum(source_size) over ()
      - (sum(cap) over (order by cap / weight, i) - cap))::double
    / (sum(weight) over () - (sum(weight) over (order by cap / weight, i) - weight)) as level
  from w),
c as (select *, (select arg_min(level, (cap / weight, i)) from r where weight * level <= cap)
    as common from r),
g as (
  select source, source_size, least(cap, weight * common)::double as target from c),
p as (
  select h.*, g.source_size, g.target, floor(g.target / g.source_size)::bigint as passes,
    sum(size) over (partition by h.source order by hash)
      - sum(size) over (partition by h.source, hash) as before,
    sum(size) over (partition by h.source, hash) as tied
  from h join g on h.source is not distinct from g.source),
q as (select *, target - passes * source_size as left_over from p),
e as (select source, max(hash) as edge from q where before <= left_over group by source)
select q.doc_id, q.size, q.source_size, q.target,
  (q.size * (q.passes + case when q.passes < {MOST} and (q.hash < e.edge
    or (q.hash = e.edge and q.tied > 0 and 2 * (q.left_over - q.before) >= q.tied))
    then 1 else 0 end))::bigint as taken
from q left join e on q.source is not distinct from e.source
"""

QUERIES = {"op8_mixing": op8_mixing}
ORACLES = {"op8_mixing": SQL}
