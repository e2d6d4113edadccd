"""Physical plans: what is pushed down, what is shuffled, and what happens to hot keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import mapping_by_number, no_job, settings
from riskweave.checks import fixtures
from riskweave.functions import lookups
from riskweave.models import V22, V23
from riskweave.operators import diagnosis, eds, hcc, person, score
from riskweave.plans import runs
from riskweave.plans.steps import Steps
from riskweave.sources import ingest
from riskweave.sources.tables import materialize, shared_folder


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df: DataFrame) -> str:
    """The plan after adaptive execution has run it to the end."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan: str) -> list[str]:
    return re.findall(r"^.*Exchange hashpartitioning\((\w+)#", plan, re.MULTILINE)


def small_partitions(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


@pytest.fixture(scope="module")
def claims(spark, sf_dir):
    return ingest.claims(materialize(fixtures.claims(spark, sf_dir), "claims"))


def test_diagnoses_are_filtered_and_pruned_at_the_scan(spark, claims):
    plan = plan_of(diagnosis.raps_diagnoses(claims, V22))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(raps_riskeligible,1)" in scan
    assert "GreaterThan" in scan
    columns = set(re.search(r"ReadSchema: struct<(.*)>", scan)[1].split(","))
    assert {c.split(":")[0] for c in columns} == {
        "hicn", "clm_thru_dt", "diag", "raps_riskeligible"}


def test_category_sets_shuffle_once_by_person(spark, claims):
    dx = diagnosis.raps_diagnoses(claims, V22)
    plan = plan_of(diagnosis.condition_sets(dx, fixtures.mapping(spark), V22))
    assert shuffles(plan) == ["hicn"]
    assert "partial_bit_or" in plan and "ObjectHashAggregate" not in plan
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_claim_list_takes_one_scan_and_one_shuffle(spark, claims):
    plan = plan_of(eds.eligible_claims(claims, fixtures.cpt_list(spark)))
    assert plan.count("FileScan") == 1
    assert shuffles(plan) == ["clm_cntl_num"]


def test_v23_shuffles_mapped_lines_only(spark, claims):
    """The crosswalk is applied below the join with the claim list."""
    eligible = runs.eligible_list(claims, fixtures.cpt_list(spark))
    sets = diagnosis.condition_sets_of_claims(
        claims, eligible, claims, fixtures.mapping(spark), V23)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        lines = plan_of(sets).splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert "SortMergeJoin" in lines[semi]
    assert any("BroadcastHashJoin [diag" in line for line in lines[semi:])


def test_python_never_runs_per_row(spark, sf_dir):
    result = runs.run_v22(
        fixtures.eligibility(spark, sf_dir), fixtures.claims(spark, sf_dir),
        runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, V22)))
    plan = plan_of(result)
    assert "Python" not in plan and "Pandas" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_salted_join_equals_broadcast_join(spark, claims):
    """Beyond the row bound of the broadcast the results stay the same."""
    mapping, cpt = fixtures.mapping(spark), fixtures.cpt_list(spark)
    weights = fixtures.weights(spark, V22)
    dx = diagnosis.raps_diagnoses(claims, V22)

    def results() -> list[list]:
        sets = diagnosis.condition_sets(dx, mapping, V22)
        people = claims.select("hicn").distinct().selectExpr(
            "hicn", "date'1940-05-05' as dob", "1 as sex", "0 as orec", "0 as medicaid",
            "'CN' as model")
        scores = score.bene_score(hcc.profile(people, sets, V22), weights, V22)
        frames = [eds.eds_physician(claims, cpt), eds.eligible_claims(claims, cpt),
                  diagnosis.dx_to_hcc(dx.distinct(), mapping), sets, scores]
        return [sorted(map(str, f.collect())) for f in frames]

    broadcast = results()
    with settings(spark, riskweave__broadcast__maxBytes="3", riskweave__join__salts="5",
                  spark__sql__autoBroadcastJoinThreshold="-1"):
        assert not lookups.fits_broadcast(mapping)
        plan = plan_of(eds.eligible_claims(claims, cpt))
        assert "_salt" in plan and "BroadcastHashJoin" not in plan
        assert results() == broadcast


def test_a_hot_code_is_spread_by_the_salt(spark):
    facts = spark.range(8000).selectExpr("'HOT' as code", "cast(id as string) as owner")
    reference = spark.range(100).selectExpr("if(id = 0, 'HOT', 'C' || id) as code", "id as value")
    with settings(spark, riskweave__broadcast__maxBytes="3", riskweave__join__salts="16",
                  spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__coalescePartitions__enabled="false",
                  spark__sql__shuffle__partitions="8"):
        joined = lookups.lookup_join(facts, reference, ["code"], "left", spread_by=["owner"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 8000
        assert max(r["count"] for r in sizes) < 8000 * 0.6


def test_hot_claim_is_split(spark):
    """A claim number with a third of all lines is split by adaptive execution."""
    lines = spark.range(60000).selectExpr(
        "if(id % 3 = 0, 'HOT', 'K' || id) as clm_cntl_num",
        "'B' || id as hicn", "date'2018-05-05' as clm_thru_dt", "'D' || (1 + id % 250) as diag")
    claims = ingest.claims(materialize(lines, "hot_claims"))
    eligible = materialize(
        spark.sql("select 'HOT' as clm_cntl_num union all "
                  "select 'K' || id from range(0, 60000, 2)"), "hot_list")
    expected = claims.where("clm_cntl_num = 'HOT' or substr(clm_cntl_num, 2) % 2 = 0").count()
    mapping = mapping_by_number(spark)
    none = claims.selectExpr("*", "'09' as provider_type")
    with small_partitions(spark):
        flagged = eds.flag_eds_eligible(claims, eligible)
        assert "SortMergeJoin(skew=true)" in final_plan(flagged)
        assert flagged.where("eds_riskeligible = 1").count() == expected
        assert flagged.count() == 60000
        sets = diagnosis.condition_sets_of_claims(claims, eligible, none, mapping, V23)
        assert "SortMergeJoin(skew=true)" in final_plan(sets)
        flags = diagnosis.condition_sets(
            diagnosis.eds_raps_diagnoses(flagged, none, V23), mapping, V23)
        assert sorted(map(tuple, sets.collect())) == sorted(map(tuple, flags.collect()))


def test_hot_person_rows_are_split(spark):
    """Copies of one person row, a third of the table, are split and all kept."""
    people = materialize(spark.range(60000).selectExpr(
        "if(id % 3 = 0, 'HOT', 'P' || id) as hicn", "date'1940-05-05' as dob", "1 as sex",
        "0 as orec", "0 as medicaid", "'CN' as model"), "hot_people")
    dx = spark.sql("select 'HOT' as hicn, 'D8' as diag union all select 'P1', 'D9'")
    with small_partitions(spark):
        profiles = runs.profiles(
            ingest.eligibility(people), dx, mapping_by_number(spark), V22,
            steps=Steps(spark, f"{shared_folder(spark)}/hot-people"))
        assert "SortMergeJoin(skew=true)" in final_plan(profiles)
        found = score.bene_hcc(profiles, V22).groupBy("hcc").count().collect()
    assert {r.hcc: r["count"] for r in found} == {"m75_79": 60000, "HCC008": 20000, "HCC009": 1}


def _shuffled_records(df: DataFrame) -> list[tuple[str, int]]:
    """(shuffle, records written) of an executed adaptive plan."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    found, todo = [], [execution.executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            records = node.metrics().apply("shuffleRecordsWritten").value()
            found.append((node.outputPartitioning().toString(), records))
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return found


def test_a_hot_person_in_the_claims_is_combined_before_the_shuffle(spark):
    """A third of the lines belong to one person: six tasks send at most six rows of theirs."""
    dx = spark.range(0, 30000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'HOT', 'P' || id) as hicn", "'D' || (1 + id % 250) as diag")
    known = set(V22.hccs)
    others = sum(1 for i in range(30000) if i % 3 and 1 + i % 250 in known)
    sets = diagnosis.condition_sets(dx, mapping_by_number(spark), V22)
    by_person = [n for text, n in _shuffled_records(sets) if "hashpartitioning(hicn" in text]
    assert by_person == [others + 6]
    assert sets.where("hicn = 'HOT'").count() == 1


def test_strict_run_fails_on_duplicates_without_a_job_of_its_own(spark, claims):
    people = ingest.eligibility(claims.selectExpr(
        "hicn", "date'1940-05-05' as dob", "1 as sex", "0 as orec", "0 as medicaid",
        "'CN' as model"))
    with no_job(spark):
        checked = person.only_unique(person.prepare_person(people))
        plan = plan_of(checked)
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1
    with pytest.raises(Exception, match="occurs in"):
        checked.collect()


def test_no_job_runs_while_a_run_is_put_together(spark, sf_dir, claims):
    """Broadcasts go by plan statistics, and nothing is written without steps."""
    eligibility = fixtures.eligibility(spark, sf_dir)
    mapping, cpt = fixtures.mapping(spark), fixtures.cpt_list(spark)
    with no_job(spark):
        first = runs.run_v22(
            eligibility, claims, runs.ModelTables(mapping, fixtures.weights(spark, V22)),
            strict=True)
        second = runs.run_v23(
            eligibility, claims, claims,
            runs.ModelTables(mapping, fixtures.weights(spark, V23)),
            eligible=runs.eligible_list(claims, cpt))
        plans = plan_of(first), plan_of(second)
    assert all("NestedLoop" not in p and "Cartesian" not in p for p in plans)


def test_statistics_bound_broadcasts(spark):
    small, huge = spark.range(100), spark.range(10**12)
    assert lookups.fits_broadcast(small) and not lookups.fits_broadcast(huge)
    # A frame of the driver's memory has no statistics.
    assert not lookups.fits_broadcast(spark.createDataFrame([(1,)], "a int"))
