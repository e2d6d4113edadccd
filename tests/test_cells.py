"""Rare branches on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import born, diagnoses, mapping_by_number, persons
from riskweave.models import V22, V23
from riskweave.operators import diagnosis, eds, hcc, person, score
from riskweave.plans import runs
from riskweave.sources import ingest


def listed(spark, rows, dx=(), spec=V22) -> dict[str, list[str]]:
    """Variables per hicn of the given persons and (hicn, category) diagnoses."""
    profiles = runs.profiles(
        persons(spark, *rows), diagnoses(spark, *dx) if dx else diagnoses(spark, ("-", 1)),
        mapping_by_number(spark), spec,
    )
    found = score.bene_hcc(profiles, spec).groupBy("hicn").agg(F.collect_list("hcc").alias("v"))
    return {row.hicn: row.v for row in found.collect()}


def weights_of(spark, spec, keys, coefs=(), default="0"):
    """Long weights with one value everywhere, except the given (key, variable, value)."""
    values = {(k, v): default for k in keys for v in spec.labels}
    values |= {(k, v): c for k, v, c in coefs}
    rows = [(k, v, None if c is None else Decimal(c)) for (k, v), c in values.items()]
    return ingest.weights(
        spark.createDataFrame(rows, "lookup_key string, variable string, coef decimal(12,3)")
    )


def scores(spark, rows, weights, dx=(), spec=V22) -> list[tuple[str, float]]:
    profiles = runs.profiles(
        persons(spark, *rows), diagnoses(spark, *dx) if dx else diagnoses(spark, ("-", 1)),
        mapping_by_number(spark), spec,
    )
    return sorted(tuple(r) for r in score.bene_score(profiles, weights, spec).collect())


def test_age_by_days_over_365_25(spark):
    rows = persons(
        spark,
        ("A", dt.date(1954, 2, 1), 2, 0, 0, "CN"),
        ("B", dt.date(1951, 2, 1), 2, 0, 0, "CN"),
        ("C", dt.date(2019, 3, 1), 2, 0, 0, "CN"),
        ("D", None, 2, 1, 0, "CN"),
        ("E", dt.date(2015, 2, 1), 2, 0, 0, "CN"),
    )
    found = {r.hicn: (r.age, r.disabled) for r in person.age_disabled(rows, V22).collect()}
    assert found == {"A": (64, 0), "B": (68, 0), "C": (-1, 0), "D": (None, 0), "E": (4, 0)}


def test_age_matches_exact_arithmetic_for_every_birth_date(spark):
    days = spark.sql("""
        select cast(id as string) as hicn, date_sub(date'2019-02-01', cast(id as int)) as dob,
         1 as sex, 0 as orec, 0 as medicaid, 'CN' as model, id as days
        from range(-2000, 45000)""")
    aged = person.age_disabled(days, V22)
    # Whole quotients of 365.25 days are multiples of 1461 days by 4.
    wrong = aged.where("age <> floor(days * 4 / cast(1461 as decimal(10,0)))")
    assert wrong.count() == 0


def test_no_band_without_a_positive_age(spark):
    found = listed(spark, [
        ("A", dt.date(2019, 3, 1), 2, 0, 0, "CN"),
        ("B", None, 1, 0, 0, "CN"),
        ("C", born(0), 1, 0, 0, "CN"),
        ("D", born(30), 3, 0, 0, "CN"),
    ])
    assert found == {}


@pytest.mark.parametrize("model", ["CN", "E"])
def test_age_64_is_split_by_original_entitlement(spark, model):
    found = listed(spark, [
        ("A", born(64), 2, 0, 0, model),
        ("B", born(64), 2, 3, 0, model),
        ("C", born(64), 2, None, 0, model),
        ("D", born(64), 1, 0, 0, model),
    ])
    assert found == {"A": ["f65"], "B": ["f60_64"], "D": ["m65"]}


def test_new_enrollees_get_single_year_and_range(spark):
    found = listed(spark, [
        *((f"E{a}", born(a), 1, 0, 0, "E") for a in range(65, 71)),
        ("C67", born(67), 1, 0, 0, "CN"),
    ])
    assert found == {
        "E65": ["m65", "m65_69"], "E66": ["m66", "m65_69"], "E67": ["m67", "m65_69"],
        "E68": ["m68", "m65_69"], "E69": ["m69", "m65_69"], "E70": ["m70_74"],
        "C67": ["m65_69"],
    }


def test_bands_change_at_their_limits(spark):
    ages = [1, 34, 35, 44, 45, 54, 55, 59, 60, 63, 65, 70, 75, 80, 85, 90, 94, 95, 110]
    found = listed(spark, [(f"{a:03d}", born(a), 2, 0, 0, "CN") for a in ages])
    assert [found[f"{a:03d}"][0] for a in ages] == [
        "f0_34", "f0_34", "f35_44", "f35_44", "f45_54", "f45_54", "f55_59", "f55_59", "f60_64",
        "f60_64", "f65_69", "f70_74", "f75_79", "f80_84", "f85_89", "f90_94", "f90_94",
        "f95_gt", "f95_gt",
    ]


def test_adjusted_entitlement_is_a_separate_column(spark):
    rows = person.age_disabled(persons(spark, ("A", born(60), 2, 1, 0, "CN"),
                                       ("B", born(70), 1, 1, 0, "CN"),
                                       ("C", born(60), 1, 3, 0, "CN")), V22)
    adjusted = {r.hicn: (r.orec, r.orec_adjusted) for r in person.orec_adjusted(rows).collect()}
    assert adjusted == {"A": (1, 0), "B": (1, 1), "C": (3, 3)}
    flags = {r.hicn: (r.originallydisabled_female, r.originallydisabled_male)
             for r in person.originally_disabled(person.orec_adjusted(rows)).collect()}
    assert flags == {"A": (1, 0), "B": (0, 1), "C": (0, 0)}
    profiles = hcc.profile(rows.select(*person.PERSON_COLUMNS),
                           diagnosis.condition_sets(diagnoses(spark, ("A", 8)),
                                                    mapping_by_number(spark), V22), V22)
    wide = {r.hicn: (r.orec, r.disabled) for r in hcc.assemble(profiles, V22).collect()}
    assert wide == {"A": (0, 1), "B": (1, 0), "C": (3, 1)}


@pytest.mark.parametrize(
    ("present", "left"),
    [((8, 9, 10, 11, 12), (8,)), ((27, 80, 166, 167), (27, 166)), ((70, 103, 104, 169), (70,)),
     ((12,), (12,)), ((134, 136, 137), (134,))],
)
@pytest.mark.parametrize("spec", [V22, V23])
def test_hierarchies(spark, spec, present, left):
    found = listed(spark, [("A", born(75), 1, 0, 0, "CN")], [("A", n) for n in present], spec)
    assert [v for v in found["A"] if v.startswith("HCC") and "_" not in v] == [
        f"HCC{n:03d}" for n in left
    ]


def test_every_drop_rule(spark):
    """One person per (parent, child) pair of each model: only the parent stays."""
    for spec in (V22, V23):
        pairs = [(p, c) for p, children in spec.drops.items() for c in children]
        found = listed(
            spark,
            [(f"{p}-{c}", born(75), 1, 0, 0, "CN") for p, c in pairs],
            [(f"{p}-{c}", n) for p, c in pairs for n in (p, c)],
            spec,
        )
        for p, c in pairs:
            assert f"HCC{p:03d}" in found[f"{p}-{c}"]
            assert f"HCC{c:03d}" not in found[f"{p}-{c}"]


def test_interactions_read_the_set_before_the_hierarchies(spark):
    found = listed(spark, [("A", born(50), 1, 1, 0, "CN")], [("A", 106), ("A", 161)])
    assert "HCC106" in found["A"]
    assert "DISABLED_HCC161".lower() in found["A"]
    assert "HCC161" not in found["A"]


def test_one_null_coefficient_makes_the_whole_score_zero(spark):
    rows = [("A", born(75), 2, 0, 0, "CN"), ("B", born(75), 2, 0, 0, "CP")]
    weights = weights_of(spark, V22, ["CN0", "CP0"], [("CN0", "HCC189", None)], default="1")
    assert scores(spark, rows, weights) == [("A", 0.0), ("B", 0.904)]


def test_persons_without_weights_keep_a_zero_score(spark):
    rows = [
        ("A", born(75), 2, 0, 0, "SNP"),
        ("B", born(75), 2, 2, 0, "E"),
        ("C", None, 2, 0, 0, "E"),
        ("D", born(75), 2, 0, None, "E"),
        ("E", born(75), 2, 0, 0, "E"),
        ("F", born(40), 2, 1, 1, "E"),
    ]
    keys = {r.hicn: r.lookup_key
            for r in person.features(persons(spark, *rows), V22).collect()}
    assert keys == {"A": None, "B": "E02", "C": None, "D": None, "E": "E00", "F": "E10"}
    weights = weights_of(spark, V22, ["E00"], default="1.041")
    # 1.041 for the one band, times 0.941 / 1.041
    assert scores(spark, rows, weights) == [
        ("A", 0.0), ("B", 0.0), ("C", 0.0), ("D", 0.0), ("E", 0.941), ("F", 0.0)
    ]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("0.519", 0.471), ("5.709", 5.176), ("-0.519", -0.471), ("0", 0.0), ("1.038", 0.941)],
)
def test_ties_are_rounded_half_up_exactly(spark, raw, expected):
    weights = weights_of(spark, V23, ["CN0"], [("CN0", "f75_79", raw)])
    assert scores(spark, [("A", born(75), 2, 0, 0, "CN")], weights, spec=V23) == [("A", expected)]


def test_duplicate_persons_are_reported_and_kept(spark):
    rows = [("A", born(75), 2, 0, 0, "CN"), ("A", born(40), 2, 0, 0, "CN"),
            ("B", born(75), 2, 0, 0, "CN")]
    table = persons(spark, *rows)
    assert [tuple(r) for r in person.duplicate_hicn(table).collect()] == [("A", 2)]
    weights = weights_of(spark, V22, ["CN0"], default="1.041")
    assert scores(spark, rows, weights, [("A", 8)]) == [
        ("A", 1.882), ("A", 1.882), ("B", 0.941)
    ]
    assert hcc.hcc_flags(
        table, diagnosis.condition_sets(diagnoses(spark, ("A", 8)), mapping_by_number(spark), V22),
        V22).count() == 2
    strict = runs.profiles(
        table, diagnoses(spark, ("A", 8)), mapping_by_number(spark), V22, strict=True)
    with pytest.raises(Exception, match="HICN A occurs in 2 person rows"):
        score.bene_hcc(strict, V22).collect()


def test_category_labels(spark):
    mapping = ingest.mapping(spark.createDataFrame(
        [("X", 1), ("X", 22), ("X", 138), ("X", 1000), ("X", None), ("Z", 5)],
        "diag string, hcc int"))
    dx = spark.createDataFrame([("A", "X"), ("A", "Y")], "hicn string, diag string")
    labelled = diagnosis.dx_to_hcc(dx, mapping)
    found = sorted(((r.diag, r.hcc) for r in labelled.collect()), key=str)
    assert found == [("X", "HCC001"), ("X", "HCC022"), ("X", "HCC138"), ("X", None)]
    for spec, expected in ((V22, {1, 22}), (V23, {1, 22, 138})):
        rows = persons(spark, ("A", born(75), 1, 0, 0, "CN"))
        flags = hcc.hcc_flags(rows, diagnosis.condition_sets(dx, mapping, spec), spec)
        row = flags.first().asDict()
        assert {int(k[3:]) for k, v in row.items() if v == 1} == expected


def test_codes_match_regardless_of_case_blanks_and_periods(spark):
    claims = ingest.claims(spark.createDataFrame(
        [("a ", dt.date(2018, 5, 1), "E11.9", 1), ("A", dt.date(2018, 5, 1), "e119 ", 1)],
        "hicn string, clm_thru_dt date, diag string, RAPS_RiskEligible int"))
    dx = diagnosis.dx_raps(claims, V22)
    assert [tuple(r) for r in dx.collect()] == [("A", "E119")]
    mapping = ingest.mapping(
        spark.createDataFrame([("E119", 19)], "DIAG string, HCC int"))
    assert diagnosis.dx_to_hcc(dx, mapping).first().hcc == "HCC019"


def test_service_year_limits_and_flags(spark):
    rows = [
        ("A", dt.date(2017, 12, 31), "D1", 1, "01"), ("B", dt.date(2018, 1, 1), "D1", 1, "02"),
        ("C", dt.date(2018, 12, 31), "D1", 1, "01 "), ("D", dt.date(2019, 1, 1), "D1", 1, "01"),
        ("E", dt.date(2018, 6, 1), "D1", 0, "03"), ("F", dt.date(2018, 6, 1), None, 1, "01"),
        (None, dt.date(2018, 6, 1), "D1", 1, "01"), ("G", dt.date(2018, 6, 1), "D1", None, "012"),
    ]
    claims = ingest.claims(spark.createDataFrame(
        rows, "hicn string, clm_thru_dt date, diag string, raps_riskeligible int, "
              "provider_type string"))
    assert sorted(r.hicn for r in diagnosis.dx_raps(claims, V22).collect()) == ["B", "C"]
    paid = claims.withColumn("eds_riskeligible", F.lit(0))
    union = diagnosis.dx_eds_raps(paid, claims, V23)
    assert sorted(r.hicn for r in union.collect()) == ["B", "C"]


def test_unknown_persons_vanish_and_healthy_persons_stay(spark):
    rows = [("A", born(75), 1, 0, 0, "CN"), ("B", born(75), 1, 0, 0, "CN")]
    found = listed(spark, rows, [("A", 8), ("Z", 9)])
    assert found == {"A": ["m75_79", "HCC008"], "B": ["m75_79"]}


CLAIM_SCHEMA = ("clm_cntl_num string, hcpcs_cd string, clm_thru_dt date, clm_type_cd string, "
                "clm_fac_type_cd string, clm_srvc_clsfctn_type_cd string")


def claim_lines(spark, *rows):
    return ingest.claims(spark.createDataFrame(list(rows), CLAIM_SCHEMA))


def code_list(spark, column="hcpcs_cpt_code"):
    return ingest.cpt_list(
        spark.createDataFrame([("99213", 2018), ("99213", 2018)], f"{column} string, CY int"))


def claim_filters(lines, cpt) -> list[set]:
    frames = [eds.eds_physician(lines, cpt), eds.eds_inpatient(lines),
              eds.eds_outpatient(lines, cpt)]
    union = eds.eds_all(*frames)
    fused = eds.eligible_claims(lines, cpt)
    found = [[r.clm_cntl_num for r in f.collect()] for f in [*frames, union, fused]]
    assert all(len(f) == len(set(f)) for f in found)
    return [set(f) for f in found]


@pytest.mark.parametrize("column", ["HCPCS_CPT_CODE", "HCPCS_CPT"])
def test_claim_filters(spark, column):
    in_2018, in_2017 = dt.date(2018, 3, 1), dt.date(2017, 3, 1)
    lines = claim_lines(
        spark,
        ("P1", "99213", in_2018, "4700", "9", "9"), ("P1", "00000", in_2018, "4700", "9", "9"),
        ("P2", "00000", in_2018, "4700", "9", "9"), ("P3", "99213", in_2017, "4700", "9", "9"),
        ("I1", "00000", in_2017, "4000", "1", "1"), ("I2", None, None, None, "4", "1"),
        ("O1", "99213 ", in_2018, "4000", "1", "3"), ("O2", "00000", in_2018, "4000", "1", "3"),
        ("O3", "99213", in_2018, None, "8", "5"), ("N1", "99213", in_2018, "4000", None, "1"),
        ("N2", "99213", in_2018, "4000", "1", "4"),
    )
    physician, inpatient, outpatient, union, fused = claim_filters(lines, code_list(spark, column))
    assert physician == {"P1"}
    assert inpatient == {"I1", "I2"}
    assert outpatient == {"O1", "O3"}
    assert union == fused == {"P1", "I1", "I2", "O1", "O3"}


def test_null_claim_numbers_are_one_row_and_never_flagged(spark):
    day = dt.date(2018, 3, 1)
    lines = claim_lines(spark, (None, "99213", day, "4700", "9", "9"),
                        (None, None, day, "4000", "1", "1"), ("K", "99213", day, "4700", "9", "9"),
                        ("L", "1", day, "4700", "9", "9"))
    *_, union, fused = claim_filters(lines, code_list(spark))
    assert union == fused == {None, "K"}
    flagged = runs.flag_claims(lines, code_list(spark))
    assert sorted(((r.clm_cntl_num, r.eds_riskeligible) for r in flagged.collect()), key=str) == [
        ("K", 1), ("L", 0), (None, 0), (None, 0)]


def test_whole_type_of_bill(spark):
    lines = ingest.claims(spark.createDataFrame(
        [("A", "111"), ("B", "131"), ("C", "41"), ("D", "999")],
        "clm_cntl_num string, type_of_bill string").withColumn("clm_thru_dt", F.current_date()))
    assert {r.clm_cntl_num for r in eds.eds_inpatient(lines).collect()} == {"A", "C"}


def test_numeric_bill_type_parts_are_joined_as_text(spark):
    lines = ingest.claims(spark.createDataFrame(
        [("A", 1, 1), ("B", 1, 3), ("C", 4, 1), ("D", 4, None)],
        "clm_cntl_num string, clm_fac_type_cd int, clm_srvc_clsfctn_type_cd int",
    ).withColumn("clm_thru_dt", F.current_date()))
    assert {r.clm_cntl_num for r in eds.eds_inpatient(lines).collect()} == {"A", "C"}


def test_two_weights_for_one_key_are_rejected(spark):
    rows = [("A", born(75), 2, 0, 0, "CN")]
    once = weights_of(spark, V22, ["CN0"], default="1")
    with pytest.raises(PySparkException, match="two weights for key CN0"):
        scores(spark, rows, once.union(once.where("variable = 'F75_79'")))


def test_substance_and_psychiatric_interaction(spark):
    rows = [("A", born(50), 1, 1, 0, "CN"), ("B", born(75), 1, 0, 0, "CN")]
    dx = [(h, n) for h in "AB" for n in (55, 58)]
    v22, v23 = listed(spark, rows, dx, V22), listed(spark, rows, dx, V23)
    assert "gsubstanceabuse_gpsychiatric" in v22["A"] and "gsubstanceabuse_gpsychiatric" in v22["B"]
    assert "disable_substAbuse_psych_V23" in v23["A"]
    assert "disable_substAbuse_psych_V23" not in v23["B"]


def test_label_case_differs_by_model(spark):
    rows = [("A", born(75), 1, 0, 1, "I"), ("B", born(75), 1, 0, None, "I")]
    v22, v23 = listed(spark, rows), listed(spark, rows, spec=V23)
    assert v22 == {"A": ["m75_79", "ltimcaid"], "B": ["m75_79"]}
    assert v23 == {"A": ["m75_79", "LTIMCAID"], "B": ["m75_79"]}


def test_dual_status_classes(spark):
    codes = spark.createDataFrame([(f"{n:02d}",) for n in range(12)] + [(None,)], "code string")
    found = {r.code: r.c for r in
             codes.select("code", person.dual_status_class("code").alias("c")).collect()}
    assert {c for c, v in found.items() if v == "partial"} == {"01", "03", "05", "06"}
    assert {c for c, v in found.items() if v == "full"} == {"02", "04", "08", "10"}
    assert found[None] is None and found["00"] is None


def test_wide_and_long_weights_agree(spark):
    rows = [("A", born(75), 2, 0, 0, "CN"), ("B", born(40), 1, 1, 0, "CN")]
    dx = [("A", 8), ("A", 85), ("B", 110), ("B", 85)]
    coefs = {label: Decimal(i + 1) / 1000 for i, label in enumerate(V22.labels)}
    wide = spark.createDataFrame(
        [(key, *coefs.values()) for key in ("cn0 ", "CN1")],
        "LOOKUP_KEY string, " + ", ".join(f"B_{label} decimal(12,3)" for label in coefs))
    long = weights_of(spark, V22, ["CN0", "CN1"],
                      [(k, label, c) for k in ("CN0", "CN1") for label, c in coefs.items()])
    assert scores(spark, rows, ingest.weights(wide), dx) == scores(spark, rows, long, dx)
    doubles = wide.select("LOOKUP_KEY", *(F.col(c).cast("double") for c in wide.columns[1:]))
    assert scores(spark, rows, ingest.weights(doubles), dx) == scores(spark, rows, long, dx)


def test_coefficients_too_fine_for_exact_sums_are_rejected(spark):
    weights = spark.createDataFrame(
        [("CN0", "f75_79", Decimal("0.1234567891"))],
        "lookup_key string, variable string, coef decimal(20,12)")
    with pytest.raises(PySparkException, match="more than 9 decimals"):
        ingest.weights(weights).collect()


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="lacks column dob"):
        ingest.eligibility(spark.createDataFrame([("A",)], "hicn string"))
