"""Joins of large fact tables with reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A reference table is broadcast only when the optimizer's estimate of its size stays within
# this bound (session setting of the same meaning: riskweave.broadcast.maxBytes).  The estimate
# is taken from file sizes, so no job runs; parquet unpacks to a few times its size.
BROADCAST_MAX_BYTES = 16 * 1024 * 1024
SALTS = 64


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"riskweave.{name}", str(default)))


def estimated_bytes(df: DataFrame) -> int:
    """Size by the statistics of the optimized plan; beyond any bound where there are none."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(reference: DataFrame) -> bool:
    bound = _setting(reference, "broadcast.maxBytes", BROADCAST_MAX_BYTES)
    return estimated_bytes(reference) <= bound


def lookup_join(
    facts: DataFrame,
    reference: DataFrame,
    on: Sequence[str],
    how: str,
    spread_by: Sequence[Column | str],
    facts_are_set: bool = False,
) -> DataFrame:
    """Join facts with a reference table without letting a hot key pile up in one task.

    A reference table of checked size is broadcast and the facts stay where they are.  A
    larger one is joined by shuffle on the key plus a salt taken from ``spread_by``, with
    every reference row copied to each salt, so one key is spread over many tasks.  The salt
    is a hash of the row, not a random number: a re-run task sends rows to the same place.
    ``facts_are_set`` says that copies of a fact row do not matter to the caller, so they are
    removed before that shuffle.
    """
    if fits_broadcast(reference):
        return facts.join(F.broadcast(reference), list(on), how)
    salts = _setting(facts, "join.salts", SALTS)
    if facts_are_set:
        facts = facts.distinct()
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = reference.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
