"""Bring caller tables to the column names, types and key form the operators expect.

Casts and key normalization happen here once.  A column that already has its type is left
bare, so date ranges and integer flags still reach the file scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.codes import normalized
from riskweave.functions.rounding import COEF_DECIMALS
from riskweave.sources import schemas
from riskweave.sources.schemas import Field

WIDE_PREFIX = "b_"


def _as_type(column: Column, given: str, wanted: str) -> Column:
    """The column in the wanted type.

    A code that arrives as a fractional type (an integer column that had gaps) is the whole
    number's digits, ``1.0`` being "1"; one that is no whole number is an error.
    """
    if given == wanted:
        return column
    if wanted == "string" and (given in ("double", "float") or given.startswith("decimal")):
        whole = column.cast("decimal(38,0)")
        odd = F.format_string("code %s is not a whole number", column.cast("string"))
        return F.when(column == whole, whole.cast("string")).when(
            column.isNotNull(), F.raise_error(odd)
        )
    return column.cast(wanted)


def _conform(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    present = {name.lower(): (name, type_) for name, type_ in df.dtypes}
    columns: list[Column] = []
    for field in fields:
        name = next((n for n in (field.name, *field.aliases) if n in present), None)
        if name is None:
            if field.required:
                raise ValueError(f"input lacks column {field.name}; it has {df.columns}")
            continue
        source, type_ = present[name]
        column = _as_type(F.col(source), type_, field.type)
        if field.digits and type_ != field.type:
            column = F.when(F.length(column) < field.digits, F.lpad(column, field.digits, "0")
                            ).otherwise(column)
        columns.append((normalized(column) if field.key else column).alias(field.name))
    return df.select(*columns)


def claims(df: DataFrame) -> DataFrame:
    """Claim lines, paid claims or submissions; columns an operator does not use may be absent."""
    return _conform(df, schemas.CLAIMS)


def diagnoses(df: DataFrame) -> DataFrame:
    """Further (hicn, diag) rows, such as chart reviews, in the key form of the other inputs."""
    return _conform(df, schemas.DIAGNOSES)


def cpt_list(df: DataFrame) -> DataFrame:
    """Listed procedure codes by calendar year; either spelling of the code column."""
    return _conform(df, schemas.CPT_LIST)


def eligibility(df: DataFrame) -> DataFrame:
    """Persons.  Their identifiers stay as given; joins compare them in key form."""
    return _conform(df, schemas.ELIGIBILITY)


def mapping(df: DataFrame) -> DataFrame:
    """Diagnosis to category crosswalk."""
    return _conform(df, schemas.MAPPING)


def weights(df: DataFrame) -> DataFrame:
    """Coefficients, one row per (lookup key, variable).

    Accepts that long form, or one wide row per lookup key with columns ``b_<variable>``.
    A coefficient with more decimals than the exact arithmetic holds is an error, not a
    rounded value.
    """
    long = {"variable", "coef"} <= {c.lower() for c in df.columns}
    wide = [c for c in df.columns if c.lower().startswith(WIDE_PREFIX)]
    if wide and not long:
        key = next(c for c in df.columns if c.lower() == "lookup_key")
        # Both the variable part of the names and the key are normalized below.
        df = df.select(key, *(F.col(c).cast("decimal(38,18)").alias(c[len(WIDE_PREFIX):])
                              for c in wide))
        df = df.unpivot([key], [c for c in df.columns if c != key], "variable", "coef")
    exact = F.col("coef").cast("decimal(38,18)")
    stored = exact.cast(f"decimal(18,{COEF_DECIMALS})")
    checked = F.when(
        F.abs(exact - stored) > F.lit("1e-12").cast("decimal(38,18)"),
        F.raise_error(F.lit(f"a coefficient has more than {COEF_DECIMALS} decimals")),
    ).otherwise(stored)
    return _conform(df.withColumn("coef", checked), schemas.WEIGHTS)
