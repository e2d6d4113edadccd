"""Claim tables that join where they lie."""

from __future__ import annotations

import pytest

from conftest import mapping_by_number, settings
from riskweave.models import CLAIM_SLOT, V23
from riskweave.operators import diagnosis, eds
from riskweave.sources import buckets, ingest

N = 24_000


@pytest.fixture(scope="module")
def stored(spark):
    """Lines of which a third have one claim number, and a list, plain and bucketed."""
    lines = ingest.claims(spark.range(N).selectExpr(
        "if(id % 3 = 0, 'HOT', if(id % 100 = 1, null, 'K' || id)) as clm_cntl_num",
        "'B' || id as hicn", "date'2018-05-05' as clm_thru_dt", "'D' || (1 + id % 250) as diag",
        "'09' as provider_type", "cast(id as int) as clm_line_num"))
    listed = spark.sql(f"select 'HOT' as clm_cntl_num union all select 'K' || id "
                       f"from range(0, {N}, 2) union all select cast(null as string)")
    yield (lines, listed, buckets.write_claim_lines(lines, "lines_by_claim", 8),
           buckets.write_claim_list(listed, "list_by_claim", 8))
    spark.sql("drop table lines_by_claim")
    spark.sql("drop table list_by_claim")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def no_broadcast(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                    spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


def test_flags_without_a_shuffle_or_sort(spark, stored):
    lines, listed, lines_by_claim, list_by_claim = stored
    with no_broadcast(spark):
        flagged = eds.flag_eds_eligible(lines_by_claim, list_by_claim)
        plan = plan_of(flagged)
        assert "SortMergeJoin" in plan
        assert "Exchange" not in plan and "Sort [" not in plan
        assert CLAIM_SLOT not in flagged.columns
        plain = eds.flag_eds_eligible(lines, listed)
        assert "Exchange" in plan_of(plain)
        assert rows(flagged) == rows(plain)


def test_a_hot_claim_is_spread_over_buckets(spark, stored):
    lines_by_claim = stored[2]
    files = lines_by_claim.selectExpr("_metadata.file_name as f").groupBy("f").count().collect()
    assert len(files) == 8
    assert max(r["count"] for r in files) < N / 3
    hot = lines_by_claim.where("clm_cntl_num = 'HOT'").select(CLAIM_SLOT).distinct().count()
    assert hot == buckets.SLOTS


def test_sets_of_v23_shuffle_by_person_alone(spark, stored):
    lines, listed, lines_by_claim, list_by_claim = stored
    mapping = mapping_by_number(spark)
    with no_broadcast(spark):
        sets = diagnosis.condition_sets_of_claims(
            lines_by_claim, list_by_claim, lines_by_claim, mapping, V23)
        assert "hashpartitioning(clm_cntl_num" not in plan_of(sets)
        plain = diagnosis.condition_sets_of_claims(lines, listed, lines, mapping, V23)
        assert "hashpartitioning(clm_cntl_num" in plan_of(plain)
        assert rows(sets) == rows(plain)


def test_stored_and_plain_tables_can_be_mixed(spark, stored):
    lines, listed, lines_by_claim, list_by_claim = stored
    plain = rows(eds.flag_eds_eligible(lines, listed))
    assert rows(eds.flag_eds_eligible(lines, list_by_claim)) == plain
    assert rows(eds.flag_eds_eligible(lines_by_claim, listed)) == plain
