from __future__ import annotations

import contextlib
import datetime as dt
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskweave.session import tune  # noqa: E402
from riskweave.sources import ingest  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("riskweave-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def jobs_so_far(spark) -> int:
    """Jobs that the session has started in the present group."""
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


@contextlib.contextmanager
def no_job(spark):
    """Fails when anything inside starts a job."""
    context = spark.sparkContext
    context.setJobGroup("counted", "jobs of a test")
    before = jobs_so_far(spark)
    try:
        yield
        assert jobs_so_far(spark) == before
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


PERSON_SCHEMA = "hicn string, dob date, sex int, orec int, medicaid int, model string"


def born(age: int) -> dt.date:
    """A birth date in mid-year that gives this age on 1 February 2019."""
    return dt.date(2018 - age, 7, 1)


def persons(spark: SparkSession, *rows: tuple) -> DataFrame:
    return ingest.eligibility(spark.createDataFrame(list(rows), PERSON_SCHEMA))


def mapping_by_number(spark: SparkSession) -> DataFrame:
    """Diagnosis ``D<n>`` maps to category n."""
    return ingest.mapping(
        spark.range(1, 300).selectExpr("'D' || id as diag", "cast(id as int) as hcc")
    )


def diagnoses(spark: SparkSession, *rows: tuple[str, int]) -> DataFrame:
    """(hicn, category number) pairs as diagnoses."""
    return spark.createDataFrame(
        [(hicn, f"D{n}") for hicn, n in rows], "hicn string, diag string"
    )
