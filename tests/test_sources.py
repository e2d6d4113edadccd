"""Result tables, reruns and the shared folder."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskweave.checks import fixtures
from riskweave.models import V22, V23
from riskweave.operators import eds
from riskweave.plans import runs
from riskweave.sources import tables


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    return runs.run_v22(
        fixtures.eligibility(spark, sf_dir), fixtures.claims(spark, sf_dir),
        runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, V22)))


def test_results_are_written_and_replaced(spark, result, tmp_path):
    score_name, hcc_name = f"{tmp_path}/bene_score_2019_v22", f"{tmp_path}/bene_hcc_2019_v22"
    for _ in range(2):
        runs.write_results(result, score_name, hcc_name)
        scores = tables.read_table(spark, score_name)
        listed = tables.read_table(spark, hcc_name)
        assert rows(scores) == rows(result.select("hicn", "cms_risk_score"))
        assert rows(listed) == rows(result.select("hicn", F.explode("variables").alias("hcc")))
        assert listed.columns == ["hicn", "hcc"]


def test_catalog_tables(spark, result):
    tables.write_table(result.select("hicn", "cms_risk_score"), "bene_score_test")
    tables.write_table(result.select("hicn", "cms_risk_score"), "bene_score_test")
    try:
        assert tables.read_table(spark, "bene_score_test").count() == result.count()
    finally:
        spark.sql("drop table bene_score_test")


def test_claim_lists_are_written(spark, sf_dir, tmp_path):
    lines, cpt = fixtures.claim_lines(spark, sf_dir), fixtures.cpt_list(spark)
    runs.write_claim_lists(lines, cpt, f"{tmp_path}/eds_")
    parts = [tables.read_table(spark, f"{tmp_path}/eds_{n}") for n in ("phys", "ip", "op")]
    whole = tables.read_table(spark, f"{tmp_path}/eds_all")
    alone = [eds.eds_physician(lines, cpt), eds.eds_inpatient(lines),
             eds.eds_outpatient(lines, cpt)]
    assert [rows(p) for p in parts] == [rows(a) for a in alone]
    assert rows(eds.eds_all(*parts)) == rows(whole)


def test_v23_from_flagged_lines_and_from_the_claim_list_agree(spark, sf_dir):
    lines, cpt = fixtures.claim_lines(spark, sf_dir), fixtures.cpt_list(spark)
    claims = fixtures.claims(spark, sf_dir)
    eligibility = fixtures.eligibility(spark, sf_dir)
    given = runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, V23))
    eligible = runs.eligible_list(lines, cpt)
    flagged = runs.flag_claims(claims, cpt)
    assert rows(runs.run_v23(eligibility, claims, claims, given, eligible=eligible)) == rows(
        runs.run_v23(eligibility, flagged, claims, given))


def test_materialize_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert tables.shared_folder(spark) == folder
    kept = tables.materialize(spark.range(5).selectExpr("id", "cast(null as string) as t"), "five")
    assert rows(kept) == rows(spark.range(5).selectExpr("id", "cast(null as string) as t"))
    assert any(p.name.startswith("five-") for p in Path(folder).iterdir())


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    class conf:
        @staticmethod
        def get(name, default):
            return default

    sparkContext = _Context("spark://cluster:7077")


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(_Session())
