"""What a spec cannot hold, weights that are not there, and codes in unusual forms."""

from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from conftest import born, mapping_by_number, persons
from pyspark.sql import functions as F

from riskweave.models import V22
from riskweave.operators import eds, score
from riskweave.plans import runs
from riskweave.sources import ingest


@pytest.mark.parametrize("category", [1000, -1])
def test_categories_without_a_three_digit_label_are_refused(category):
    with pytest.raises(ValueError, match=str(category)):
        dataclasses.replace(V22, hccs=(*V22.hccs, category))


def test_absent_coefficient_is_an_error_and_null_is_not(spark):
    rows = [("CN0", label.upper(), None if i == 3 else "0.1") for i, label in enumerate(V22.labels)]
    weights = spark.createDataFrame(rows, "lookup_key string, variable string, coef string")
    weights = weights.withColumn("coef", F.col("coef").cast("decimal(18,9)"))
    assert score.weight_vectors(weights, V22).count() == 0
    lacking = weights.where(F.col("variable") != V22.labels[5].upper())
    with pytest.raises(Exception, match=f"no weight for key CN0, variable {V22.labels[5].upper()}"):
        score.weight_vectors(lacking, V22).collect()


def test_type_of_bill_of_each_row(spark):
    rows = [("a", "1", "1", None), ("b", None, None, "11x"), ("c", "1", "1", "999"),
            ("d", "", "", "41"), ("e", "9", "9", "11"), ("f", None, "1", None)]
    claims = spark.createDataFrame(
        rows, "clm_cntl_num string, clm_fac_type_cd string, clm_srvc_clsfctn_type_cd string,"
              " type_of_bill string")
    got = {r[0] for r in eds.eds_inpatient(claims).collect()}
    assert got == {"a", "b", "c", "d"}


def test_numeric_provider_type_is_padded(spark):
    rows = spark.sql("select 'k' as clm_cntl_num, date '2018-01-01' as clm_thru_dt, 1 as provider_type")
    assert ingest.claims(rows).first().provider_type == "01"


@pytest.mark.parametrize(("value", "text"), [
    ("1.0D", "01"), ("cast(1 as decimal(9,2))", "01"), ("2.0F", "02"), ("123", "123"),
    ("'1'", "1"), ("cast(null as double)", None), ("1e3D", "1000")])
def test_numeric_codes_are_the_digits_of_whole_numbers(spark, value, text):
    rows = spark.sql(f"select date '2018-01-01' as clm_thru_dt, {value} as provider_type")
    assert ingest.claims(rows).first().provider_type == text


def test_numeric_claim_types_and_bills_match(spark):
    rows = spark.sql(
        "select 'k' as clm_cntl_num, date '2018-01-01' as clm_thru_dt, 4700.0D as clm_type_cd,"
        " 1.0D as clm_fac_type_cd, cast(1 as decimal(3,1)) as clm_srvc_clsfctn_type_cd")
    claims = ingest.claims(rows)
    assert claims.first().clm_type_cd == "4700"
    assert eds.eds_inpatient(claims).count() == 1
    broken = spark.sql("select date '2018-01-01' as clm_thru_dt, 1.5D as provider_type")
    with pytest.raises(Exception, match="1.5 is not a whole number"):
        ingest.claims(broken).collect()


def test_further_diagnoses_take_the_key_form(spark):
    rows = spark.createDataFrame([("a ", "d2.1")], "hicn string, diag string")
    assert tuple(ingest.diagnoses(rows).first())[0] == "A"


def test_long_weights_may_carry_other_columns(spark):
    rows = spark.sql("select 'CN0' as lookup_key, 'HCC001' as variable, 0.1 as coef, 'x' as b_note")
    assert ingest.weights(rows).first().variable == "HCC001"


def test_spec_of_another_year_and_further_diagnoses(spark):
    spec = dataclasses.replace(V22, service_year=2020, age_date=dt.date(2021, 2, 1))
    person = persons(spark, ("A", born(70), 1, 0, 0, "CN"), ("B", born(70), 1, 0, 0, "CN"))
    rows = [("A", "D8", dt.date(2020, 5, 1), 1), ("B", "D8", dt.date(2018, 5, 1), 1)]
    claims = ingest.claims(spark.createDataFrame(
        rows, "hicn string, diag string, clm_thru_dt date, raps_riskeligible int"))
    further = ingest.diagnoses(spark.createDataFrame(
        [("b ", "d.85"), ("b", None), (None, "D85")], "hicn string, diag string"))
    weights = spark.createDataFrame(
        [("CN0", label, "0.1") for label in V22.labels],
        "lookup_key string, variable string, coef string")
    tables = runs.ModelTables(mapping_by_number(spark), ingest.weights(weights))
    result = runs.run_v22(person, claims, tables, spec=spec, further=[further])
    assert {r.hicn: r.variables for r in result.collect()} == {
        "A": ["m70_74", "HCC008"], "B": ["m70_74", "HCC085"]}
