"""Every operator as a named query on the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.checks import fixtures
from riskweave.models import V22, V23, ClaimRules, ModelSpec
from riskweave.operators import diagnosis, eds, hcc, person, score
from riskweave.plans import runs
from riskweave.plans.steps import Steps
from riskweave.sources import rules
from riskweave.sources.files import Folder
from riskweave.sources.tables import read_table, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
SPECS = (V22, V23)
EDITED_RULES = ClaimRules(
    physician_types=("4000",), inpatient_bills=("12",), outpatient_bills=("77", "13", "99")
)


def _persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return person.prepare_person(fixtures.eligibility(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Age date and rules are the same in both versions.
    return person.age_disabled(_persons(spark, sf_dir), V22)


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.eligible_list(fixtures.claim_lines(spark, sf_dir), fixtures.cpt_list(spark))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eds.flag_eds_eligible(fixtures.claims(spark, sf_dir), _eligible(spark, sf_dir))


def _distinct_dx(spark: SparkSession, sf_dir: str, spec: ModelSpec) -> DataFrame:
    if spec is V22:
        return diagnosis.dx_raps(fixtures.claims(spark, sf_dir), V22)
    return diagnosis.dx_eds_raps(
        _flagged(spark, sf_dir), fixtures.claims(spark, sf_dir), V23
    )


def _profiles(spark: SparkSession, sf_dir: str, spec: ModelSpec) -> DataFrame:
    eligibility = fixtures.eligibility(spark, sf_dir)
    claims = fixtures.claims(spark, sf_dir)
    mapping = fixtures.mapping(spark)
    if spec is V22:
        return runs.profiles_v22(eligibility, claims, mapping)
    eligible = _eligible(spark, sf_dir)
    return runs.profiles_v23(eligibility, claims, claims, mapping, eligible=eligible)


def _shared() -> dict[str, Query]:
    def lines_and_list(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
        return fixtures.claim_lines(spark, sf_dir), fixtures.cpt_list(spark)

    def lists_of(rules: ClaimRules) -> Query:
        return lambda s, d: eds.claim_flags(*lines_and_list(s, d), rules)

    def all_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The union of the three lists, read off one table of claim flags."""
        flags = eds.claim_flags(*lines_and_list(spark, sf_dir))
        return flags.where("physician or inpatient or outpatient").select(eds.CLAIM)

    def persons_v22(
        eligibility: Callable, weights: Callable = fixtures.weights, spec: ModelSpec = V22
    ) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            tables = runs.ModelTables(fixtures.mapping(spark), weights(spark, spec))
            claims = fixtures.claims(spark, sf_dir)
            result = runs.run_v22(eligibility(spark, sf_dir), claims, tables, spec=spec)
            return result.withColumn("variables", F.array_join("variables", "|"))
        return query

    def from_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = rules.read_spec(
            "v22", *rules.rule_tables(spark, V22), normalization_millis=V22.normalization_millis
        )
        return persons_v22(fixtures.eligibility, spec=spec)(spark, sf_dir)

    def both(spark: SparkSession, sf_dir: str) -> DataFrame:
        steps = Steps(spark, f"{shared_folder(spark)}/run-both-{uuid.uuid4().hex}")
        steps.folder.delete_on_exit()
        claims, cpt = fixtures.claims(spark, sf_dir), fixtures.cpt_list(spark)
        given = [runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, spec))
                 for spec in SPECS]
        eligible = runs.eligible_list(fixtures.claim_lines(spark, sf_dir), cpt, steps=steps)
        results = runs.run_both(fixtures.eligibility(spark, sf_dir), claims, eligible, given, steps)
        first, second = (
            r.select(F.lit(spec.version).alias("version"), "hicn", "cms_risk_score",
                     F.array_join("variables", "|").alias("variables"))
            for r, spec in zip(results, SPECS, strict=True)
        )
        return first.union(second)

    def result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The two tables of a run, published and read back."""
        folder = f"{shared_folder(spark)}/result-tables-{uuid.uuid4().hex}"
        Folder(spark, folder).delete_on_exit()
        given = runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, V22))
        result = runs.run_v22(
            fixtures.eligibility(spark, sf_dir), fixtures.claims(spark, sf_dir), given)
        runs.write_results(result, f"{folder}/bene_score", f"{folder}/bene_hcc")
        listed = read_table(spark, f"{folder}/bene_hcc").groupBy("hicn").agg(
            F.count("hcc").alias("n_variables"), F.min("hcc").alias("first_variable"))
        return read_table(spark, f"{folder}/bene_score").join(listed, "hicn", "left")

    def dual_status(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixtures.dual_status(spark, sf_dir).withColumn(
            "dual_status_class", person.dual_status_class("dual_status_cd")
        )

    def run_with_further(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = runs.ModelTables(fixtures.mapping(spark), fixtures.weights(spark, V22))
        result = runs.run_v22(
            fixtures.eligibility(spark, sf_dir), fixtures.claims(spark, sf_dir), tables,
            further=[fixtures.further_dx(spark, sf_dir)],
        )
        return result.withColumn("variables", F.array_join("variables", "|"))

    return {
        "run_v22_extra_dx": run_with_further,
        "eds_physician": lambda s, d: eds.eds_physician(*lines_and_list(s, d)),
        "eds_inpatient": lambda s, d: eds.eds_inpatient(fixtures.claim_lines(s, d)),
        "eds_outpatient": lambda s, d: eds.eds_outpatient(*lines_and_list(s, d)),
        "eds_all": all_lists,
        "eds_lists_of_years": lists_of(ClaimRules(years=(2016, 2018, 2019))),
        "eds_lists_edited": lists_of(EDITED_RULES),
        "eds_lists_mixed_bill": lambda s, d: eds.claim_flags(
            fixtures.claim_lines_mixed_bill(s, d), fixtures.cpt_list(s)),
        "run_v22_mixed_case": persons_v22(fixtures.eligibility_mixed_case),
        "run_v22_repeated_persons": persons_v22(fixtures.eligibility_repeated),
        "run_v22_null_coefficient": persons_v22(fixtures.eligibility, fixtures.weights_with_null),
        "run_v22_from_rules": from_rules,
        "run_both": both,
        "result_tables_v22": result_tables,
        "eds_eligible_claims": lambda s, d: eds.eligible_claims(*lines_and_list(s, d)),
        "flag_eds_eligible": _flagged,
        "prepare_person": _persons,
        "duplicate_hicn": lambda s, d: person.duplicate_hicn(
            person.prepare_person(fixtures.eligibility_per_order(s, d))
        ),
        "dual_status_class": dual_status,
        "age_disabled": _features,
        "orec_adjusted": lambda s, d: person.orec_adjusted(_features(s, d)),
        "demographic_bands": lambda s, d: person.demographic_bands(_features(s, d)),
        "originally_disabled": lambda s, d: person.originally_disabled(_features(s, d)),
        "lookup_key": lambda s, d: person.lookup_key(_features(s, d)),
        "dx_raps_v22": lambda s, d: _distinct_dx(s, d, V22),
        "dx_eds_raps_v23": lambda s, d: _distinct_dx(s, d, V23),
    }


def _versioned(spec: ModelSpec) -> dict[str, Query]:
    def dx_to_hcc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return diagnosis.dx_to_hcc(_distinct_dx(spark, sf_dir, spec), fixtures.mapping(spark))

    def hcc_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
        claims, mapping = fixtures.claims(spark, sf_dir), fixtures.mapping(spark)
        if spec is V22:
            sets = diagnosis.condition_sets(diagnosis.raps_diagnoses(claims, V22), mapping, V22)
        else:
            eligible = _eligible(spark, sf_dir)
            sets = diagnosis.condition_sets_of_claims(claims, eligible, claims, mapping, V23)
        return hcc.hcc_flags(_persons(spark, sf_dir), sets, spec)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = runs.run(_profiles(spark, sf_dir, spec), fixtures.weights(spark, spec), spec)
        return result.withColumn("variables", F.array_join("variables", "|"))

    queries: dict[str, Query] = {
        "dx_to_hcc": dx_to_hcc,
        "hcc_flags": hcc_flags,
        "hierarchy_snapshot": lambda s, d: hcc.hierarchy_snapshot(_profiles(s, d, spec), spec),
        "interactions": lambda s, d: hcc.interactions(_profiles(s, d, spec), spec),
        "apply_hierarchies": lambda s, d: hcc.apply_hierarchies(_profiles(s, d, spec), spec),
        "assemble": lambda s, d: hcc.assemble(_profiles(s, d, spec), spec),
        "risk_score": lambda s, d: score.risk_score(
            _profiles(s, d, spec), fixtures.weights(s, spec), spec
        ),
        "bene_score": lambda s, d: score.bene_score(
            _profiles(s, d, spec), fixtures.weights(s, spec), spec
        ),
        "bene_hcc": lambda s, d: score.bene_hcc(_profiles(s, d, spec), spec),
        "bene_hcc_explained": lambda s, d: score.explained(
            _profiles(s, d, spec), fixtures.weights(s, spec), spec
        ),
        "run": run,
    }
    return {f"{name}_{spec.version}": query for name, query in queries.items()}


def queries() -> dict[str, Query]:
    found = _shared()
    for spec in SPECS:
        found |= _versioned(spec)
    return found
