"""Claim lines and claim lists stored so that they join without a shuffle.

Both tables are bucketed and sorted by claim number and slot.  The slot of a line is a hash of
the line, so a claim number with a large share of the lines is spread over as many buckets as
there are slots; the list holds each claim number once for each slot.  Every bucket is one
file, written by one task, whose order Spark keeps when it reads (``session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.models import CLAIM, CLAIM_SLOT
from riskweave.sources.tables import catalog_name

SLOTS = 16
KEYS = (CLAIM, CLAIM_SLOT)


def _write(rows: DataFrame, name: str, buckets: int) -> DataFrame:
    # Rows are dealt to tasks by the function that deals them to buckets.
    dealt = rows.repartition(buckets, *KEYS).sortWithinPartitions(*KEYS)
    table = catalog_name(name)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(
        *KEYS
    ).saveAsTable(table)
    return rows.sparkSession.table(table)


def write_claim_lines(lines: DataFrame, name: str, buckets: int, slots: int = SLOTS) -> DataFrame:
    """Replace the table of claim lines and read it back."""
    slot = F.pmod(F.xxhash64(*lines.columns), F.lit(slots)).cast("int")
    return _write(lines.withColumn(CLAIM_SLOT, slot), name, buckets)


def write_claim_list(listed: DataFrame, name: str, buckets: int, slots: int = SLOTS) -> DataFrame:
    """Replace the table of listed claims, with the lines' buckets and slots, and read it back."""
    each = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    return _write(listed.select(CLAIM).withColumn(CLAIM_SLOT, each), name, buckets)
