"""Runs that are taken up at the last written step."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import no_job
from riskweave.checks import fixtures
from riskweave.models import V22, V23
from riskweave.plans import runs
from riskweave.plans.steps import Steps, plan_key
from riskweave.sources import ingest


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    """Claims and persons as parquet, and a function that reads them anew."""
    folder = tmp_path_factory.mktemp("inputs")
    fixtures.claims(spark, sf_dir).write.parquet(f"{folder}/claims")
    fixtures.eligibility(spark, sf_dir).write.parquet(f"{folder}/eligibility")

    def read():
        return (ingest.eligibility(spark.read.parquet(f"{folder}/eligibility")),
                ingest.claims(spark.read.parquet(f"{folder}/claims")))

    return read


def tables(spark, spec=V22):
    return runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, spec))


def rows(df):
    return sorted(map(str, df.collect()))


def scans_of(df, column: str) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and column in line for line in plan.splitlines())


def test_a_killed_run_goes_on_after_the_sets(spark, inputs, tmp_path):
    """The first run dies when it scores; the second does not read a claim."""
    eligibility, claims = inputs()
    weights = fixtures.weights(spark, V22).where("variable <> 'HCC008'")  # lacks a variable
    first = Steps(spark, f"{tmp_path}/run")
    result = runs.run_v22(
        eligibility, claims, runs.ModelTables(fixtures.mapping(spark), weights), steps=first)
    with pytest.raises(Exception, match="no weight for key"):
        runs.write_results(result, f"{tmp_path}/out/score", f"{tmp_path}/out/list", steps=first)
    assert (first.taken, first.written) == ([], ["condition_sets_v22"])

    eligibility, claims = inputs()
    again = Steps(spark, f"{tmp_path}/run")
    with no_job(spark):
        result = runs.run_v22(eligibility, claims, tables(spark), steps=again)
    assert (again.taken, again.written) == (["condition_sets_v22"], [])
    assert scans_of(result, "raps_riskeligible") == 0
    plain = runs.run_v22(eligibility, claims, tables(spark))
    assert scans_of(plain, "raps_riskeligible") == 1
    assert rows(result) == rows(plain)
    runs.write_results(result, f"{tmp_path}/out/score", f"{tmp_path}/out/list", steps=again)
    last = Steps(spark, f"{tmp_path}/run")
    result = runs.run_v22(eligibility, claims, tables(spark), steps=last)
    runs.write_results(result, f"{tmp_path}/out/score", f"{tmp_path}/out/list", steps=last)
    assert last.written == [] and last.taken == ["condition_sets_v22", "scored"]


def test_other_inputs_rules_and_years_are_other_steps(spark, inputs, tmp_path):
    folder = f"{tmp_path}/run"

    def taken(claims, spec=V22):
        steps = Steps(spark, folder)
        runs.run_v22(inputs()[0], claims, tables(spark), spec=spec, steps=steps)
        return steps.taken

    claims = inputs()[1]
    assert taken(claims) == [] and taken(inputs()[1]) == ["condition_sets_v22"]
    assert taken(claims.where("clm_line_num < 4")) == []
    assert taken(claims, dataclasses.replace(V22, service_year=2017)) == []
    assert taken(claims, dataclasses.replace(V22, hccs=(*V22.hccs, 463))) == []
    # Age and hierarchies are applied after the sets.
    assert taken(claims, dataclasses.replace(V22, drops={8: (9,)})) == ["condition_sets_v22"]
    numbers = list(range(100))
    one, other = (claims.where(F.col("clm_line_num").isin([*numbers, n])) for n in (500, 501))
    assert plan_key(one) != plan_key(other)


def test_a_rewritten_input_is_another_step(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(10).write.parquet(path)
    key = plan_key(spark.read.parquet(path))
    assert plan_key(spark.read.parquet(path)) == key
    spark.range(10).write.mode("overwrite").parquet(path)
    assert plan_key(spark.read.parquet(path)) != key


def test_lambdas_do_not_change_the_key(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).selectExpr("array(id, 2) as a").write.parquet(path)
    keys = {plan_key(spark.read.parquet(path).select(F.transform("a", lambda x: x + n)))
            for n in (1, 1, 2)}
    assert len(keys) == 2


def test_frames_of_the_drivers_memory_are_written_anew(spark, tmp_path):
    local = spark.createDataFrame([(1,)], "a int")
    assert plan_key(local) is None
    steps = Steps(spark, f"{tmp_path}/run")
    for _ in range(2):
        assert steps.keep(local, "local").collect()[0].a == 1
    assert steps.written == ["local"] * 2 and steps.taken == []


def test_a_step_without_entry_is_not_taken(spark, tmp_path):
    """A write that did not end leaves no entry, and its rows are replaced."""
    df = spark.range(5)
    steps = Steps(spark, f"{tmp_path}/run")
    spark.range(99).write.parquet(f"{tmp_path}/run/five-{plan_key(df)}")
    assert steps.keep(df, "five").count() == 5 and steps.written == ["five"]
    assert steps.keep(df, "five").count() == 5 and steps.taken == ["five"]
    steps.clear()
    assert not steps.folder.exists()


def test_both_versions_from_one_scan(spark, inputs, tmp_path, sf_dir):
    eligibility, claims = inputs()
    steps = Steps(spark, f"{tmp_path}/run")
    eligible = runs.eligible_list(claims, fixtures.cpt_list(spark), steps=steps)
    given = [tables(spark, V22), tables(spark, V23)]
    found = runs.run_both(eligibility, claims, eligible, given, steps)
    assert steps.written == ["eds_all", "condition_sets_both"]
    assert all(scans_of(df, "raps_riskeligible") == 0 for df in found)
    assert rows(found[0]) == rows(runs.run_v22(eligibility, claims, given[0]))
    assert rows(found[1]) == rows(
        runs.run_v23(eligibility, claims, claims, given[1], eligible=eligible))
    sets = runs.diagnosis.condition_sets_of_both(
        claims, eligible, [t.mapping for t in given], (V22, V23))
    assert scans_of(sets, "raps_riskeligible") == 1 and scans_of(sets, "diag") == 1
