"""Model inputs derived from the test tables, and the same text for the SQL checks.

The test tables hold no clinical data: codes and coefficients below are invented.  Each
statement is valid in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.models import ModelSpec
from riskweave.sources import ingest

ELIGIBILITY = """
select case when c_custkey % 97 = 0 then null else concat('B', cast(c_custkey as string)) end as hicn,
 date '1919-02-01' + cast((c_custkey * 7919) % 36500 as int) as dob,
 cast(1 + c_custkey % 2 as int) as sex,
 cast(case when c_custkey % 11 < 7 then 0 when c_custkey % 11 < 9 then 1 when c_custkey % 11 = 9 then 2 else 3 end as int) as orec,
 cast(case when c_custkey % 3 = 0 then 1 else 0 end as int) as medicaid,
 rtrim(substr('CNCNCNCNCNCPCPCPCFCFCFI I E E E X ', cast(1 + 2 * (c_custkey % 17) as int), 2)) as model
from {customer}
"""

# Person rows with repeats: one per order instead of one per customer.
ELIGIBILITY_PER_ORDER = """
select concat('B', cast(o_custkey as string)) as hicn,
 date '1919-02-01' + cast((o_custkey * 7919) % 36500 as int) as dob,
 cast(1 + o_custkey % 2 as int) as sex, cast(0 as int) as orec, cast(0 as int) as medicaid,
 'CN' as model
from {orders}
"""

# Identifiers as a plan may give them: lower case, or with trailing blanks.
ELIGIBILITY_MIXED_CASE = f"""
select case extract(day from dob) % 3 when 0 then lower(hicn) when 1 then concat(hicn, '  ') else hicn end as hicn,
 dob, sex, orec, medicaid, model
from ({ELIGIBILITY}) e
"""

# Every fourth person has a second row, institutional and of the other sex.
SECOND_ROWS = f"""
select hicn, dob, cast(3 - sex as int) as sex, orec, medicaid, 'I' as model
from ({ELIGIBILITY}) e where extract(day from dob) % 4 = 0
"""
ELIGIBILITY_REPEATED = f"{ELIGIBILITY} union all {SECOND_ROWS}"

# Dual status codes 01 to 12 by customer.
DUAL_STATUS = """
select concat('B', cast(c_custkey as string)) as hicn,
 lpad(cast(1 + c_custkey % 12 as string), 2, '0') as dual_status_cd
from {customer}
"""

# Claim lines without the person, for the claim filters: they need neither.
CLAIM_LINES = """
select concat('K', cast(l_orderkey as string)) as clm_cntl_num, l_linenumber as clm_line_num,
 cast(l_shipdate + interval '18' year as date) as clm_thru_dt,
 case when l_orderkey % 3 = 0 then '4700' else '4000' end as clm_type_cd,
 substr('141417777812479', cast(1 + l_orderkey % 12 as int), 1) as clm_fac_type_cd,
 substr('112331367523', cast(1 + l_orderkey % 12 as int), 1) as clm_srvc_clsfctn_type_cd,
 concat('C', lpad(cast(l_partkey % 100 as string), 3, '0')) as hcpcs_cd
from {lineitem}
"""

# The type of bill in parts, whole with blank parts, or whole with a leading zero.
CLAIM_LINES_MIXED_BILL = f"""
select clm_cntl_num, clm_line_num, clm_thru_dt, clm_type_cd, hcpcs_cd,
 case clm_line_num % 3 when 0 then '' when 1 then clm_fac_type_cd end as clm_fac_type_cd,
 case clm_line_num % 3 when 0 then ' ' when 1 then clm_srvc_clsfctn_type_cd end as clm_srvc_clsfctn_type_cd,
 case clm_line_num % 3 when 0 then concat(clm_fac_type_cd, clm_srvc_clsfctn_type_cd, '4')
  when 2 then concat('0', clm_fac_type_cd, clm_srvc_clsfctn_type_cd) end as type_of_bill
from ({CLAIM_LINES}) l
"""

CLAIMS = """
select concat('K', cast(l_orderkey as string)) as clm_cntl_num, l_linenumber as clm_line_num,
 concat('B', cast(o_custkey as string)) as hicn,
 cast(l_shipdate + interval '18' year as date) as clm_thru_dt,
 case when l_orderkey % 3 = 0 then '4700' else '4000' end as clm_type_cd,
 substr('141417777812479', cast(1 + l_orderkey % 12 as int), 1) as clm_fac_type_cd,
 substr('112331367523', cast(1 + l_orderkey % 12 as int), 1) as clm_srvc_clsfctn_type_cd,
 concat('C', lpad(cast(l_partkey % 100 as string), 3, '0')) as hcpcs_cd,
 case when (l_partkey + l_linenumber) % 23 = 0 then null else concat('D', lpad(cast((l_partkey * 31 + l_linenumber) % 95 as string), 2, '0'), '.', cast((l_partkey * 31 + l_linenumber) % 7 as string)) end as diag,
 cast(case when l_orderkey % 5 < 4 then 1 else 0 end as int) as raps_riskeligible,
 lpad(cast(l_suppkey % 4 + 1 as string), 2, '0') as provider_type
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

# Diagnoses from another source, not in key form.
FURTHER_DX = """
select concat('b', cast(o_custkey as string), ' ') as hicn,
 case when o_orderkey % 19 = 0 then null else concat('d', lpad(cast(o_orderkey % 95 as string), 2, '0'), '.', cast(o_orderkey % 7 as string), ' ') end as diag
from {orders}
"""

# --------------------------------------------------------------------------
# Categories that the invented diagnoses map to, those of the models and others.
# --------------------------------------------------------------------------
MAPPED_CATEGORIES = (
    1, 2, 6, 8, 9, 10, 11, 12, 17, 18, 19, 21, 22, 23, 27, 28, 29, 33, 34, 35, 39, 40, 46, 47,
    48, 54, 55, 56, 57, 58, 59, 60, 70, 71, 72, 73, 74, 75, 76, 77, 78, 79, 80, 82, 83, 84, 85,
    86, 87, 88, 96, 99, 100, 103, 104, 106, 107, 108, 110, 111, 112, 114, 115, 122, 124, 134,
    135, 136, 137, 138, 157, 158, 161, 162, 166, 167, 169, 170, 173, 176, 186, 188, 189, 3, 5,
    20, 50, 101, 200,
)
# --------------------------------------------------------------------------
# End of the fixed values.
# --------------------------------------------------------------------------

_CASES = " ".join(f"when {i} then {number}" for i, number in enumerate(MAPPED_CATEGORIES[:89]))
MAPPING = f"""
select concat('D', lpad(cast(id % 95 as string), 2, '0'), cast(id % 7 as string)) as diag,
 case id % 95 {_CASES} when 89 then 1000 end as hcc
from range(665) t(id) where id % 95 < 92
union all select 'D000' as diag, 85 as hcc
"""

CPT_LIST = """
select concat('C', lpad(cast(id % 100 as string), 3, '0')) as hcpcs_cpt_code, cast(2013 + id % 7 as int) as cy
from range(700) t(id) where (id % 100 + id % 7) % 4 = 0
"""

# i is the position of the variable among the model's output labels, from 1.
WEIGHTS = """
select case j when 0 then 'CN0' when 1 then 'CN1' when 2 then 'CP0' when 3 then 'CP1' when 4 then 'CF0'
  when 5 then 'CF1' when 6 then 'I' when 7 then 'E00' when 8 then 'E10' when 9 then 'E01' when 10 then 'E11'
 end as lookup_key, i,
 cast(cast(((i * 37 + j * 101) % 1500) as decimal(12,3)) * cast(0.001 as decimal(4,3)) as decimal(12,3)) as coef
from (select cast(id % 146 + 1 as int) as i, cast((id - id % 146) / 146 as int) as j
 from range(1606) t(id)) n
"""


# The columns that the statements read; a given schema saves the job that infers one.
_TABLES = {
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_shipdate timestamp_ntz",
}


# Inputs that were derived and written before: (folder of the test tables, statement) -> path.
_STORED: dict[tuple[str, str], str] = {}


def store(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Derive persons, claims and claim lines once; later calls read what is written here."""
    for name, text in (("eligibility", ELIGIBILITY), ("claims", CLAIMS),
                       ("claim_lines", CLAIM_LINES)):
        _derive(spark, sf_dir, text).write.parquet(f"{folder}/{name}")
        _STORED[sf_dir, text] = f"{folder}/{name}"


def _derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    if (sf_dir, text) in _STORED:
        return spark.read.parquet(_STORED[sf_dir, text])
    tables = {
        name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        for name, schema in _TABLES.items()
        if f"{{{name}}}" in text
    }
    return spark.sql(text, **tables)


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.eligibility(_derive(spark, sf_dir, ELIGIBILITY))


def eligibility_mixed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.eligibility(_derive(spark, sf_dir, ELIGIBILITY_MIXED_CASE))


def eligibility_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.eligibility(_derive(spark, sf_dir, ELIGIBILITY_REPEATED))


def claim_lines_mixed_bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.claims(_derive(spark, sf_dir, CLAIM_LINES_MIXED_BILL))


def eligibility_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.eligibility(_derive(spark, sf_dir, ELIGIBILITY_PER_ORDER))


def dual_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, DUAL_STATUS)


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.claims(_derive(spark, sf_dir, CLAIM_LINES))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.claims(_derive(spark, sf_dir, CLAIMS))


def further_dx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.diagnoses(_derive(spark, sf_dir, FURTHER_DX))


def _reference(spark: SparkSession, text: str) -> DataFrame:
    """A reference table of fixed size: at most 1,606 rows, so one partition holds it."""
    return spark.sql(text).coalesce(1)


def mapping(spark: SparkSession) -> DataFrame:
    return ingest.mapping(_reference(spark, MAPPING))


def cpt_list(spark: SparkSession) -> DataFrame:
    return ingest.cpt_list(_reference(spark, CPT_LIST))


def weights(spark: SparkSession, spec: ModelSpec) -> DataFrame:
    """Every lookup key has a coefficient for every variable."""
    labels = F.expr("array(" + ", ".join(f"'{label}'" for label in spec.labels) + ")")
    numbered = _reference(spark, WEIGHTS).where(F.col("i") <= len(spec.labels))
    return ingest.weights(
        numbered.select("lookup_key", F.element_at(labels, F.col("i")).alias("variable"), "coef")
    )


def weights_with_null(spark: SparkSession, spec: ModelSpec) -> DataFrame:
    """The same, but one coefficient of the key CN0 is NULL."""
    hole = (F.col("lookup_key") == "CN0") & (F.col("variable") == spec.labels[2].upper())
    return weights(spark, spec).withColumn("coef", F.when(~hole, F.col("coef")))
