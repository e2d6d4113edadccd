"""Counts of a run, made by its own jobs."""

from __future__ import annotations

import pytest

from conftest import born, jobs_so_far, persons
from riskweave.checks import fixtures
from riskweave.functions.counting import Counts
from riskweave.models import V22, V23
from riskweave.operators import diagnosis
from riskweave.plans import runs
from riskweave.plans.steps import Steps
from riskweave.sources import ingest


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("counted")
    fixtures.claims(spark, sf_dir).write.parquet(f"{folder}/claims")
    fixtures.eligibility_repeated(spark, sf_dir).where("hicn <> 'B4'").write.parquet(
        f"{folder}/eligibility")
    return (ingest.eligibility(spark.read.parquet(f"{folder}/eligibility")),
            ingest.claims(spark.read.parquet(f"{folder}/claims")))


def tables(spark, spec):
    return runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, spec))


def plain_counts(spark, eligibility, dx, lines, spec, result) -> dict[str, int]:
    """The same numbers by jobs of their own."""
    mapping = fixtures.mapping(spark).where("hcc is not null")
    of_model = mapping.where(mapping.hcc.isin(*spec.hccs)).select("diag").distinct()
    with_categories = dx.join(of_model, "diag").select("hicn").distinct()
    people = eligibility.where("hicn is not null")
    repeated = people.groupBy("hicn").count().where("count > 1")
    mapped = lines.join(of_model, "diag").count()
    return {
        "diagnoses": lines.count(), "mapped_diagnoses": mapped,
        "unmapped_diagnoses": lines.count() - mapped,
        "persons_with_categories": with_categories.count(),
        "unknown_persons": with_categories.join(people, "hicn", "left_anti").count(),
        "person_rows": people.count(),
        "repeated_person_rows": repeated.groupBy().sum("count").first()[0],
        "rows_without_weights": sum(
            r.lookup_key in (None, "E02", "E03", "E12", "E13") for r in result),
    }


def test_counts_of_v22_equal_plain_counts(spark, inputs):
    eligibility, claims = inputs
    counts = Counts()
    result = runs.run_v22(eligibility, claims, tables(spark, V22), counts=counts).collect()
    dx = diagnosis.raps_diagnoses(claims, V22)
    found = counts.get()
    assert found == plain_counts(spark, eligibility, dx, dx, V22, result)
    assert all(found[name] > 0 for name in found)


def test_counts_of_v23_equal_plain_counts(spark, inputs):
    eligibility, claims = inputs
    counts = Counts()
    eligible = runs.eligible_list(claims, fixtures.cpt_list(spark))
    result = runs.run_v23(
        eligibility, claims, claims, tables(spark, V23), eligible=eligible, counts=counts
    ).collect()
    flagged = runs.flag_claims(claims, fixtures.cpt_list(spark))
    dx = diagnosis.eds_raps_diagnoses(flagged, claims, V23)
    every = diagnosis.eds_raps_diagnoses(
        flagged.selectExpr("* except (eds_riskeligible)", "1 as eds_riskeligible"), claims, V23)
    assert counts.get() == plain_counts(spark, eligibility, dx, every, V23, result)


def test_counting_starts_no_job(spark, inputs):
    eligibility, claims = inputs

    def jobs(counts):
        spark.sparkContext.setJobGroup("counted", "jobs of a test")
        try:
            before = jobs_so_far(spark)
            runs.run_v22(eligibility, claims, tables(spark, V22), counts=counts).collect()
            if counts:
                counts.get()
            return jobs_so_far(spark) - before
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    plain = jobs(None)
    assert 0 < plain and jobs(Counts()) <= plain + 1  # at most the stage of the person window


def test_reruns_take_the_counts_from_the_manifest(spark, inputs, tmp_path):
    eligibility, claims = inputs
    found = []
    for _ in range(2):
        steps, counts = Steps(spark, f"{tmp_path}/run"), Counts()
        runs.run_v22(
            eligibility, claims, tables(spark, V22), steps=steps, counts=counts).collect()
        found.append(counts.get())
    assert steps.taken == ["condition_sets_v22"]
    assert found[0] == found[1] and found[0]["diagnoses"] > 0


def test_counts_without_rows(spark):
    nobody = persons(spark, ("A", born(70), 1, 0, 0, "CN")).limit(0)
    claims = ingest.claims(spark.sql(
        "select 'A' as hicn, 'D1' as diag, date'2018-01-01' as clm_thru_dt, 1 as raps_riskeligible"
    )).where("hicn = 'B'")
    counts = Counts()
    assert runs.run_v22(nobody, claims, tables(spark, V22), counts=counts).collect() == []
    assert set(counts.get().values()) == {0}
