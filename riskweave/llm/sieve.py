"""Rows that may match some keys, told apart before they are shuffled.

One bit for each hash of a wanted key is broadcast, of ``BITS_A_KEY`` bits for each wanted row, but
``LEAST_BITS`` (128 kB) at least and ``SIEVE_BITS`` (8 MB) at most.  Every row with a wanted key
is among those that may match; others that are, by chance, are left to the join that follows.
When wanted keys far outnumber the bits, all rows may match and nothing is saved; results do not
depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.texts import whole

SIEVE_BITS = 1 << 26
LEAST_BITS, BITS_A_KEY = 1 << 20, 64


def n_bits(keys: int) -> int:
    """Bits of a sieve for so many wanted rows, a power of two."""
    return min(SIEVE_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * keys).bit_length()))


def _place(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def bitmap(wanted: DataFrame, wanted_key: list[str], bits: int) -> DataFrame:
    """(_bucket, _bits) of the wanted keys; a bucket holds 32768 bits."""
    return wanted.select(_place(wanted_key, bits).alias("_place")).groupBy(
        F.bitmap_bucket_number("_place").alias("_bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))


def marked(
    rows: DataFrame, key: list[str], wanted: DataFrame, wanted_key: list[str], name: str = "may",
    n_wanted: int | None = None,
) -> DataFrame:
    """The rows with a boolean ``name``: whether the key may be wanted.

    ``wanted`` is a written table; its rows are counted here unless ``n_wanted`` says how many.
    """
    size = n_bits(wanted.count() if n_wanted is None else n_wanted)
    bits, place = bitmap(wanted, wanted_key, size), _place(key, size)
    at = F.bitmap_bit_position(place)
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.getbit(byte, F.expr("cast(_at % 8 as int)"))
    placed = rows.withColumn("_own", F.bitmap_bucket_number(place)).withColumn("_at", at)
    met = placed.join(F.broadcast(bits), F.col("_own") == F.col("_bucket"), "left")
    return met.select(*rows.columns, F.coalesce(bit == 1, F.lit(False)).alias(name))


def rows_that_stay(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """The document rows, with all their columns whatever their names, but those that go.

    ``listed`` has one row for each id and text of which some row goes: ``of_id``, ``of_hash``
    (xxhash64 of the text, null as empty) and ``stays``, whether one of them stays.  Other rows,
    told by the sieve, are passed on as they are read and not shuffled.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(whole(F.col("text"))).alias("hash"),
    )
    sifted = marked(rows, ["id", "hash"], listed, ["of_id", "of_hash"])
    some = sifted.where("may").join(
        listed, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_hash")), "left"
    )
    # Of rows repeated with id and text one stays, in the partitioning and order of the join.
    one = "row_number() over (partition by id, hash order by stays)"
    stay = some.withColumn("n", F.expr(one)).where("of_hash is null or (stays and n = 1)")
    return sifted.where("not may").select("row.*").union(stay.select("row.*"))
