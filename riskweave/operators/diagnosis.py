"""Diagnoses that count, and the condition categories they map to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.codes import code_in, in_year, in_years
from riskweave.functions.counting import Counts, rows, watched
from riskweave.functions.lookups import lookup_join
from riskweave.models import (
    CLAIM,
    CLAIM_SLOT,
    MAX_LABELLED,
    SUBMISSION_PROVIDER_TYPES,
    ModelSpec,
)
from riskweave.operators.eds import claim_keys, distinct_claims



def _diagnoses(lines: DataFrame, accepted: Column, year: int, *keep: str) -> DataFrame:
    """(hicn, diag without periods) of the accepted lines of one service year, with repeats."""
    usable = in_year("clm_thru_dt", year) & F.col("diag").isNotNull() & F.col("hicn").isNotNull()
    return lines.where(accepted & usable).select(
        *keep, "hicn", F.replace("diag", F.lit("."), F.lit("")).alias("diag")
    )


def raps_diagnoses(claims: DataFrame, spec: ModelSpec) -> DataFrame:
    """Diagnoses of lines flagged eligible by the submission-based logic, with repeats."""
    return _diagnoses(claims, F.col("raps_riskeligible") == 1, spec.service_year)


def submitted_diagnoses(submissions: DataFrame, spec: ModelSpec) -> DataFrame:
    """Diagnoses of inpatient submissions, with repeats."""
    inpatient = code_in("provider_type", SUBMISSION_PROVIDER_TYPES)
    return _diagnoses(submissions, inpatient, spec.service_year)


def eds_raps_diagnoses(paid: DataFrame, submissions: DataFrame, spec: ModelSpec) -> DataFrame:
    """Diagnoses of paid lines flagged encounter-eligible and of inpatient submissions."""
    encounters = _diagnoses(paid, F.col("eds_riskeligible") == 1, spec.service_year)
    return encounters.union(submitted_diagnoses(submissions, spec))


def with_further(dx: DataFrame, further: Sequence[DataFrame]) -> DataFrame:
    """The diagnoses and those of further (hicn, diag) rows, such as chart reviews.

    Further rows count as they are; the caller has chosen year and source.
    """
    for rows in further:
        usable = rows.where(F.col("diag").isNotNull() & F.col("hicn").isNotNull())
        dx = dx.union(usable.select("hicn", F.replace("diag", F.lit("."), F.lit("")).alias("diag")))
    return dx


def dx_raps(claims: DataFrame, spec: ModelSpec) -> DataFrame:
    return raps_diagnoses(claims, spec).distinct()


def dx_eds_raps(paid: DataFrame, submissions: DataFrame, spec: ModelSpec) -> DataFrame:
    return eds_raps_diagnoses(paid, submissions, spec).distinct()


def dx_to_hcc(dx: DataFrame, mapping: DataFrame) -> DataFrame:
    """(hicn, diag, hcc label) of every mapped diagnosis, one row per category it maps to.

    Category numbers beyond three digits keep their row with a NULL label.
    """
    label = F.when(
        F.col("hcc").between(0, MAX_LABELLED), F.format_string("HCC%03d", F.col("hcc"))
    )
    labels = mapping.where(F.col("hcc").isNotNull()).select("diag", label.alias("hcc"))
    joined = lookup_join(dx, labels, ["diag"], "inner", spread_by=["hicn"])
    return joined.select("hicn", "diag", "hcc")


def sets_by_person(rows: DataFrame, *words: str) -> DataFrame:
    """One row per hicn: the union of the row sets.

    ``bit_or`` on a few bigints is combined map-side, so a person with a third of all rows
    reaches the shuffle as one small row per task.
    """
    return rows.groupBy("hicn").agg(*(F.bit_or(w).alias(w) for w in words))


def mapped(
    dx: DataFrame, mapping: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """Diagnosis rows that map to a category of the model, with their categories as a set.

    The crosswalk is reduced to one set per diagnosis first, so a diagnosis with several
    categories does not multiply rows.
    """
    joined = lookup_join(
        watched(counts, dx, diagnoses=rows()), crosswalk_sets(mapping, spec), ["diag"], "inner",
        spread_by=[c for c in dx.columns if c != "diag"],
        # Copies are removed before a shuffle unless they are to be counted.
        facts_are_set=counts is None,
    )
    return watched(counts, joined.drop("diag"), mapped_diagnoses=rows())


def crosswalk_sets(mapping: DataFrame, spec: ModelSpec, prefix: str = "pre") -> DataFrame:
    """Each diagnosis of the crosswalk with the set of the model's categories it maps to."""
    names = spec.categories.names(prefix)
    words = [F.expr(spec.categories.bit_of_number("hcc", w)).alias(name)
             for w, name in enumerate(names)]
    of_model = mapping.where(F.col("hcc").isin(*spec.hccs)).select("diag", *words)
    return of_model.groupBy("diag").agg(*(F.bit_or(name).alias(name) for name in names))


def condition_sets(
    dx: DataFrame, mapping: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """(hicn, pre_0...): the model's categories of each person with any.

    ``dx`` may repeat diagnoses: a set union is idempotent, so the distinct that would cost a
    shuffle of its own is not needed.
    """
    found = mapped(dx, mapping, spec, counts)
    sets = sets_by_person(found, *spec.categories.names("pre"))
    return watched(counts, sets, persons_with_categories=rows())


def condition_sets_of_claims(
    claims: DataFrame,
    eligible: DataFrame,
    submissions: DataFrame,
    mapping: DataFrame,
    spec: ModelSpec,
    further: Sequence[DataFrame] = (),
    counts: Counts | None = None,
) -> DataFrame:
    """The sets of ``eds_raps_diagnoses`` from unflagged claims and the eligible claim list.

    Only lines of the service year whose diagnosis maps to a category are shuffled to meet
    the claim list, instead of all lines to be flagged.  Counted diagnoses are those of all
    these lines, listed or not.
    """
    keys = claim_keys(claims, eligible)
    listed = eligible if CLAIM_SLOT in keys else distinct_claims(eligible)
    lines = _diagnoses(claims, F.col(CLAIM).isNotNull(), spec.service_year, *keys)
    encounters = mapped(lines, mapping, spec, counts).join(
        listed.select(*keys), keys, "left_semi")
    others = with_further(submitted_diagnoses(submissions, spec), further)
    submitted = mapped(others, mapping, spec, counts)
    sets = sets_by_person(
        encounters.drop(*keys).unionByName(submitted), *spec.categories.names("pre")
    )
    return watched(counts, sets, persons_with_categories=rows())


def condition_sets_of_both(
    claims: DataFrame,
    eligible: DataFrame,
    mappings: Sequence[DataFrame],
    specs: Sequence[ModelSpec],
) -> DataFrame:
    """(hicn, v0_0..., v1_0...): the sets of two models from one scan of the claims.

    The first model takes lines flagged by submission-based eligibility; the second takes lines
    of listed claims, and inpatient submissions among the same lines.  A line carries the
    categories that its diagnosis has in either model, and one aggregate makes both sets.
    """
    keys = claim_keys(claims, eligible)
    listed = eligible if CLAIM_SLOT in keys else distinct_claims(eligible)
    marks = listed.where(F.col(CLAIM).isNotNull()).select(*keys, F.lit(True).alias("_listed"))
    prefixes = [f"v{i}" for i in range(len(specs))]
    names = [spec.categories.names(p) for spec, p in zip(specs, prefixes, strict=True)]
    first, second = (in_year("clm_thru_dt", spec.service_year) for spec in specs)
    flagged = F.col("raps_riskeligible") == 1
    submitted = code_in("provider_type", SUBMISSION_PROVIDER_TYPES)
    lines = claims.where(
        in_years("clm_thru_dt", {spec.service_year for spec in specs})
        & F.col("diag").isNotNull() & F.col("hicn").isNotNull()
    ).select(
        *keys, "hicn", F.replace("diag", F.lit("."), F.lit("")).alias("diag"),
        F.coalesce(flagged & first, F.lit(False)).alias("_first"),
        F.coalesce(submitted & second, F.lit(False)).alias("_second"),
        second.alias("_in_second"),
    )
    left, right = (
        crosswalk_sets(m, spec, p) for m, spec, p in zip(mappings, specs, prefixes, strict=True)
    )
    both = left.join(right, "diag", "full")
    zero = F.lit(0).cast("bigint")
    both = both.withColumns({n: F.coalesce(n, zero) for group in names for n in group})
    found = lookup_join(lines, both, ["diag"], "inner", spread_by=["hicn"], facts_are_set=True)
    met = found.join(marks, keys, "left")
    takes = (
        F.col("_first"),
        F.col("_second") | (F.col("_in_second") & F.col("_listed").isNotNull()),
    )
    words = [F.when(take, F.col(n)).otherwise(zero).alias(n)
             for take, group in zip(takes, names, strict=True) for n in group]
    return sets_by_person(met.select("hicn", *words), *names[0], *names[1])
