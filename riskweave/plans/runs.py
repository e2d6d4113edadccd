"""Whole runs: claim filter, V22 and V23, from input tables to result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.counting import Counts
from riskweave.models import CLAIM_RULES, V22, V23, ClaimRules, ModelSpec
from riskweave.operators import diagnosis, eds, hcc, score
from riskweave.operators.person import only_unique, prepare_person
from riskweave.plans.steps import Steps, kept
from riskweave.sources.publish import Publication, publish_views
from riskweave.sources.tables import catalog_name, is_path, materialize


@dataclass(frozen=True)
class ModelTables:
    """The caller's reference tables of one model version, already ingested."""

    mapping: DataFrame
    weights: DataFrame


def eligible_list(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES, steps: Steps | None = None
) -> DataFrame:
    """The claim list, as the step ``eds_all``.

    With steps, a join with claim lines has two plain scans below its shuffles, the form in
    which adaptive execution can split a claim number with a large share of the lines.
    """
    return kept(steps, eds.eligible_claims(claims, cpt, rules), "eds_all")


def flag_claims(
    claims: DataFrame, cpt: DataFrame, rules: ClaimRules = CLAIM_RULES, steps: Steps | None = None
) -> DataFrame:
    """Claim lines with ``eds_riskeligible`` from the claim filter."""
    return eds.flag_eds_eligible(claims, eligible_list(claims, cpt, rules, steps))


def _profiles(
    eligibility: DataFrame, sets: DataFrame, spec: ModelSpec, strict: bool,
    steps: Steps | None, counts: Counts | None,
) -> DataFrame:
    """Person profiles from the category sets, the step ``condition_sets_<version>``.

    The sets are a few numbers per person.  Written between the scan of all claims and the
    person-level steps, they serve every result without going back to the claims, and repeated
    person rows can be split by adaptive execution.
    """
    person = prepare_person(eligibility)
    if strict:
        person = only_unique(person)
    stored = kept(steps, sets, f"condition_sets_{spec.version}", counts)
    return hcc.profile(person, stored, spec, counts)


def profiles(
    eligibility: DataFrame,
    diagnoses: DataFrame,
    mapping: DataFrame,
    spec: ModelSpec,
    strict: bool = False,
    steps: Steps | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    """Person profiles from (hicn, diag) rows of any origin."""
    sets = diagnosis.condition_sets(diagnoses, mapping, spec, counts)
    return _profiles(eligibility, sets, spec, strict, steps, counts)


def profiles_v22(
    eligibility: DataFrame,
    claims: DataFrame,
    mapping: DataFrame,
    strict: bool = False,
    spec: ModelSpec = V22,
    further: Sequence[DataFrame] = (),
    steps: Steps | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    """V22 takes the diagnoses of lines flagged by submission-based eligibility.

    ``spec`` may be another year's; ``further`` are (hicn, diag) frames from other sources.
    """
    dx = diagnosis.with_further(diagnosis.raps_diagnoses(claims, spec), further)
    return profiles(eligibility, dx, mapping, spec, strict, steps, counts)


def profiles_v23(
    eligibility: DataFrame,
    paid: DataFrame,
    submissions: DataFrame,
    mapping: DataFrame,
    strict: bool = False,
    eligible: DataFrame | None = None,
    spec: ModelSpec = V23,
    further: Sequence[DataFrame] = (),
    steps: Steps | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    """V23 takes encounter-eligible paid lines and inpatient submissions.

    Paid lines either carry ``eds_riskeligible`` or come with the list of eligible claims.
    """
    if eligible is None:
        dx = diagnosis.eds_raps_diagnoses(paid, submissions, spec)
        dx = diagnosis.with_further(dx, further)
        return profiles(eligibility, dx, mapping, spec, strict, steps, counts)
    sets = diagnosis.condition_sets_of_claims(
        paid, eligible, submissions, mapping, spec, further, counts
    )
    return _profiles(eligibility, sets, spec, strict, steps, counts)


def run(
    rows: DataFrame, weights: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """Score and variable list per person row, from its profile."""
    return score.scored(rows, weights, spec, counts)


def run_v22(
    eligibility: DataFrame,
    claims: DataFrame,
    tables: ModelTables,
    strict: bool = False,
    spec: ModelSpec = V22,
    further: Sequence[DataFrame] = (),
    steps: Steps | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    rows = profiles_v22(
        eligibility, claims, tables.mapping, strict, spec, further, steps, counts
    )
    return run(rows, tables.weights, spec, counts)


def run_v23(
    eligibility: DataFrame,
    paid: DataFrame,
    submissions: DataFrame,
    tables: ModelTables,
    strict: bool = False,
    eligible: DataFrame | None = None,
    spec: ModelSpec = V23,
    further: Sequence[DataFrame] = (),
    steps: Steps | None = None,
    counts: Counts | None = None,
) -> DataFrame:
    rows = profiles_v23(
        eligibility, paid, submissions, tables.mapping, strict, eligible, spec, further, steps,
        counts,
    )
    return run(rows, tables.weights, spec, counts)


def run_both(
    eligibility: DataFrame,
    claims: DataFrame,
    eligible: DataFrame,
    tables: Sequence[ModelTables],
    steps: Steps,
    strict: bool = False,
    specs: Sequence[ModelSpec] = (V22, V23),
) -> list[DataFrame]:
    """Results of both versions over the same claims, which are scanned once.

    Submissions are the lines of ``claims`` with a provider type that counts.  Both category
    sets of a person come out of one aggregate, the step ``condition_sets_both``.
    """
    found = diagnosis.condition_sets_of_both(claims, eligible, [t.mapping for t in tables], specs)
    sets = steps.keep(found, "condition_sets_both")
    person = prepare_person(eligibility)
    if strict:
        person = only_unique(person)
    results = []
    for i, (spec, of_version) in enumerate(zip(specs, tables, strict=True)):
        words = zip(spec.categories.names(f"v{i}"), spec.categories.names("pre"), strict=True)
        own = sets.select("hicn", *(F.col(name).alias(pre) for name, pre in words))
        results.append(run(hcc.profile(person, own, spec), of_version.weights, spec))
    return results


def write_results(
    result: DataFrame, score_name: str, hcc_name: str, steps: Steps | None = None
) -> None:
    """Write the score table and the variable list of a run, replacing earlier ones at once.

    Both come from the same rows, the step ``scored``.  Names are two folders below the same
    one, or two names of the catalog.
    """
    scores = ["hicn", "cms_risk_score"]
    if is_path(score_name):
        rows = steps.keep(result, "scored") if steps else materialize(result, "scored")
        listed = rows.select("hicn", F.explode("variables").alias("hcc"))
        _replace({score_name: rows.select(*scores), hcc_name: listed})
    else:
        publish_views(result, {
            catalog_name(score_name): ", ".join(scores),
            catalog_name(hcc_name): "hicn, explode(variables) as hcc",
        })


def write_claim_lists(
    claims: DataFrame, cpt: DataFrame, prefix: str, rules: ClaimRules = CLAIM_RULES,
    steps: Steps | None = None,
) -> None:
    """Write the four claim lists ``<prefix>phys``, ``ip``, ``op`` and ``all``, all at once.

    The claims are scanned once; the lists are read off one small table of claim flags, the
    step ``claim_flags``.
    """
    passed = {"phys": "physician", "ip": "inpatient", "op": "outpatient", "all": "true"}
    flags = kept(steps, eds.claim_flags(claims, cpt, rules), "claim_flags")
    if is_path(prefix):
        flags = flags if steps else materialize(flags, "claim_flags")
        _replace({f"{prefix}{name}": flags.where(test).select(eds.CLAIM)
                  for name, test in passed.items()})
    else:
        publish_views(flags, {catalog_name(f"{prefix}{name}"): (eds.CLAIM, test)
                              for name, test in passed.items()})


def _replace(frames: dict[str, DataFrame]) -> None:
    """Publish folders of one parent together."""
    folders = {name.rstrip("/").rsplit("/", 1)[0] for name in frames}
    if len(folders) > 1:
        raise ValueError(f"tables that are replaced together share a folder, not {sorted(folders)}")
    spark = next(iter(frames.values())).sparkSession
    Publication(spark, folders.pop()).replace(
        {name.rstrip("/").rsplit("/", 1)[1]: frame for name, frame in frames.items()}
    )
