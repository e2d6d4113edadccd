"""Which claims count for risk adjustment: physician, inpatient and outpatient filters.

Each filter returns the distinct claim numbers of the lines it accepts.  Only the columns a
filter needs leave the scan, and the one shuffle carries distinct claim numbers.  Beside every
test on a computed value stands one on bare columns that it implies, for the scan to skip by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.codes import (
    any_of,
    code_in,
    implied_by_blank_concat,
    implied_by_concat,
    in_years,
    starts_with_any,
)
from riskweave.functions.lookups import lookup_join
from riskweave.models import CLAIM, CLAIM_RULES, CLAIM_SLOT, ClaimRules

FACILITY, SERVICE, WHOLE_BILL = "clm_fac_type_cd", "clm_srvc_clsfctn_type_cd", "type_of_bill"
_CODE_AND_YEAR = ("hcpcs_cd", "cy")


def bill_type_in(claims: DataFrame, types: tuple[str, ...]) -> Column:
    """Type of bill of each row: facility || service, or where a row lacks either, the first two
    characters of the whole form.  A whole form with a leading zero matches nothing."""
    forms = []
    if {FACILITY, SERVICE} <= set(claims.columns):
        forms.append(F.rtrim(F.concat(FACILITY, SERVICE)))
    if WHOLE_BILL in claims.columns:
        whole = F.substring(WHOLE_BILL, 1, 2)
        # Blank parts are as good as absent ones when the row has the whole form.
        forms = [F.coalesce(*(F.when(form != "", form) for form in forms), whole)]
    return forms[0].isin(*types)


def may_be_bill_type(claims: DataFrame, types: tuple[str, ...]) -> Column:
    """Implied by ``bill_type_in``, on bare columns."""
    parts, whole = {FACILITY, SERVICE} <= set(claims.columns), WHOLE_BILL in claims.columns
    tests = []
    if parts:
        tests.append(implied_by_concat(FACILITY, SERVICE, types))
    if whole:
        begins = starts_with_any(WHOLE_BILL, types)
        tests.append(implied_by_blank_concat(FACILITY, SERVICE) & begins if parts else begins)
    return any_of(tests)


def _of_years(claims: DataFrame, rules: ClaimRules) -> DataFrame:
    return claims.where(in_years("clm_thru_dt", rules.years)) if rules.years else claims


def _of_bill_type(claims: DataFrame, types: tuple[str, ...], rules: ClaimRules) -> DataFrame:
    return _of_years(claims, rules).where(
        may_be_bill_type(claims, types) & bill_type_in(claims, types)
    )


def _listed(cpt: DataFrame) -> DataFrame:
    return cpt.select(F.col("hcpcs_cpt_code").alias("hcpcs_cd"), "cy").distinct()


def _code_lines(claims: DataFrame, *extra: Column) -> DataFrame:
    return claims.select(CLAIM, "hcpcs_cd", F.year("clm_thru_dt").alias("cy"), *extra)


def _with_listed_line(lines: DataFrame, cpt: DataFrame) -> DataFrame:
    matched = lookup_join(
        _code_lines(lines), _listed(cpt), _CODE_AND_YEAR, "left_semi",
        spread_by=[CLAIM], facts_are_set=True,
    )
    return matched.select(CLAIM).distinct()


def eds_physician(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES
) -> DataFrame:
    """Physician claims with a line whose procedure code is listed for the line's year."""
    lines = _of_years(claims, rules).where(code_in("clm_type_cd", rules.physician_types))
    return _with_listed_line(lines, cpt)


def eds_inpatient(claims: DataFrame, rules: ClaimRules = CLAIM_RULES) -> DataFrame:
    """Inpatient claims by type of bill; no procedure code is asked for."""
    return _of_bill_type(claims, rules.inpatient_bills, rules).select(CLAIM).distinct()


def eds_outpatient(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES
) -> DataFrame:
    """Outpatient claims by type of bill, of any claim type, with a listed line."""
    return _with_listed_line(_of_bill_type(claims, rules.outpatient_bills, rules), cpt)


def eds_all(physician: DataFrame, inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Distinct union of the three lists; a NULL claim number survives as one row."""
    return physician.union(inpatient).union(outpatient).distinct()


def claim_flags(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES
) -> DataFrame:
    """One row per claim that passes a filter, with a boolean per filter.

    All three lists and their union from one scan, one lookup and one shuffle.
    """
    by_type = code_in("clm_type_cd", rules.physician_types)
    inpatient = bill_type_in(claims, rules.inpatient_bills)
    outpatient = bill_type_in(claims, rules.outpatient_bills)
    candidates = _of_years(claims, rules).where(
        starts_with_any("clm_type_cd", rules.physician_types)
        | may_be_bill_type(claims, rules.inpatient_bills + rules.outpatient_bills)
    )
    lines = _code_lines(
        candidates.where(by_type | inpatient | outpatient),
        by_type.alias("by_type"), inpatient.alias("inpatient"), outpatient.alias("outpatient"),
    )
    listed = _listed(cpt).withColumn("listed", F.lit(True))
    matched = lookup_join(
        lines, listed, _CODE_AND_YEAR, "left",
        spread_by=[CLAIM], facts_are_set=True,
    )
    rules = {
        "physician": "by_type and listed", "inpatient": "inpatient",
        "outpatient": "outpatient and listed",
    }
    flags = [F.expr(f"coalesce({rule}, false)").alias(name) for name, rule in rules.items()]
    passing = matched.select(CLAIM, *flags).where("physician or inpatient or outpatient")
    return passing.groupBy(CLAIM).agg(*(F.bool_or(name).alias(name) for name in rules))


def eligible_claims(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES
) -> DataFrame:
    """The same list as ``eds_all`` of the three filters, from one scan and one shuffle."""
    return claim_flags(claims, cpt, rules).select(CLAIM)


def claim_keys(lines: DataFrame, listed: DataFrame) -> list[str]:
    """What lines and list are joined by: the slot, too, where both are stored with one."""
    stored = CLAIM_SLOT in lines.columns and CLAIM_SLOT in listed.columns
    return [CLAIM, CLAIM_SLOT] if stored else [CLAIM]


def distinct_claims(listed: DataFrame) -> DataFrame:
    """The list without the copies that it may be stored with."""
    return listed.where(F.col(CLAIM_SLOT) == 0) if CLAIM_SLOT in listed.columns else listed


def flag_eds_eligible(claims: DataFrame, eligible: DataFrame) -> DataFrame:
    """Claim lines with ``eds_riskeligible`` = 1 when the claim is in the list, else 0.

    ``eligible`` holds each claim number once, as all lists here do.  Tables that
    ``sources.buckets`` has written are joined where they lie.  Others are shuffled on the claim
    number; with a list read from a table, adaptive execution then splits a claim number that
    holds a large share of the lines.
    """
    keys = claim_keys(claims, eligible)
    listed = eligible if CLAIM_SLOT in keys else distinct_claims(eligible)
    marks = listed.where(F.col(CLAIM).isNotNull()).select(*keys, F.lit(1).alias("_mark"))
    flagged = claims.drop("eds_riskeligible").join(marks, keys, "left").drop(CLAIM_SLOT)
    return flagged.withColumn("eds_riskeligible", F.coalesce("_mark", F.lit(0))).drop("_mark")
