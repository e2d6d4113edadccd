"""Random persons against a plain calculation, and properties every run must have."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import PERSON_SCHEMA, mapping_by_number
from riskweave.checks import oracle
from riskweave.models import V22, V23
from riskweave.operators import score
from riskweave.plans import runs
from riskweave.sources import ingest

SPECS = [V22, V23]
KEYS = ("CN0", "CN1", "CP0", "CF1", "I", "E00", "E10", "E01", "E12")
PERSONS = 400


def random_persons(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    start = dt.date(1915, 1, 1)
    return [
        (
            f"P{i}",
            None if rng.random() < 0.03 else start + dt.timedelta(days=rng.randrange(38200)),
            rng.choice([1, 2, 2, 3, None]), rng.choice([0, 0, 0, 1, 1, 2, 3, None]),
            rng.choice([0, 1, None]), rng.choice(["CN", "CP", "CF", "I", "E", "E", "X", None]),
        )
        for i in range(PERSONS)
    ]


def random_diagnoses(seed: int) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    return [(f"P{rng.randrange(PERSONS + 20)}", f"D{rng.randrange(1, 200)}") for _ in range(6000)]


def random_weights(spec, seed: int) -> dict[str, dict[str, Decimal]]:
    rng = random.Random(seed)
    return {k: {v.upper(): Decimal(rng.randrange(-500, 3000)) / 1000 for v in spec.labels}
            for k in KEYS}


def expected(person, numbers, weights, spec) -> tuple[float, list[str]]:
    """The model by hand, from the rule tables of the SQL checks."""
    _, dob, sex, orec, medicaid, model = person
    version = spec.version
    age = None if dob is None else ((dt.date(2019, 2, 1) - dob).days * 4) // 1461
    disabled = age is not None and age < 65 and orec not in (0, None)
    present = {n for n in numbers if n in oracle._hccs(version)}
    kept = present - {c for p, c in oracle._drop_pairs(version) if p in present}
    labels = []
    letter = {1: "m", 2: "f"}.get(sex)
    if letter and age is not None:
        for low, high in ((1, 34), (35, 44), (45, 54), (55, 59), (60, 63), (65, 69), (70, 74),
                          (75, 79), (80, 84), (85, 89), (90, 94)):
            if low <= age <= high:
                labels.append(f"{letter}{0 if low == 1 else low}_{64 if high == 63 else high}")
        if age >= 95:
            labels.append(f"{letter}95_gt")
        if age == 64 and orec is not None:
            labels.append(letter + ("65" if orec == 0 else "60_64"))
        if model == "E" and 65 <= age <= 69:
            labels.append(f"{letter}{age}")
    if letter and orec == 1:
        labels.append("originallydisabled_" + ("male" if sex == 1 else "female"))
    labels += [f"HCC{n:03d}" for n in kept]
    for label, groups, only_disabled in oracle._rules(version):
        if groups and all(present & set(g) for g in groups) and (disabled or not only_disabled):
            labels.append(label)
    if medicaid == 1 and model == "I":
        labels.append(oracle.INSTITUTIONAL_MEDICAID[version])
    key = None
    if model in ("CN", "CP", "CF"):
        key = f"{model}{int(disabled)}"
    elif model == "I":
        key = "I"
    elif model == "E" and age is not None and medicaid is not None:
        if age <= 64:
            key = f"E{medicaid}0"
        elif orec is not None:
            key = f"E{medicaid}{orec}"
    raw = sum((weights[key][v.upper()] for v in labels), Decimal(0)) if key in weights else Decimal(0)
    exact = raw * 941 / oracle.NORMALIZATION[version]
    return float(exact.quantize(Decimal("0.001"), ROUND_HALF_UP)), sorted(labels)


def scored(spark, people, dx, weights, spec):
    long = [(k, v, c) for k, by_name in weights.items() for v, c in by_name.items()]
    profiles = runs.profiles(
        ingest.eligibility(spark.createDataFrame(people, PERSON_SCHEMA)),
        spark.createDataFrame(dx, "hicn string, diag string"), mapping_by_number(spark), spec)
    return profiles, runs.run(profiles, ingest.weights(
        spark.createDataFrame(long, "lookup_key string, variable string, coef decimal(12,3)")),
        spec)


@pytest.mark.parametrize("spec", SPECS)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_persons_against_a_plain_calculation(spark, spec, seed):
    people, dx = random_persons(seed), random_diagnoses(seed)
    weights = random_weights(spec, seed)
    numbers: dict[str, set[int]] = {}
    for hicn, diag in dx:
        numbers.setdefault(hicn, set()).add(int(diag[1:]))
    _, result = scored(spark, people, dx, weights, spec)
    found = {r.hicn: (r.cms_risk_score, sorted(r.variables)) for r in result.collect()}
    assert found == {
        p[0]: expected(p, numbers.get(p[0], set()), weights, spec) for p in people
    }


@pytest.mark.parametrize("spec", SPECS)
def test_order_and_repeats_of_the_input_do_not_matter(spark, spec):
    people, dx, weights = random_persons(3), random_diagnoses(3), random_weights(spec, 3)
    _, once = scored(spark, people, dx, weights, spec)
    rng = random.Random(4)
    mixed = dx + dx[:500]
    rng.shuffle(mixed)
    shuffled = people[:]
    rng.shuffle(shuffled)
    _, again = scored(spark, shuffled, mixed, weights, spec)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert once.count() == PERSONS


@pytest.mark.parametrize("spec", SPECS)
def test_no_dropped_category_is_left_with_its_parent(spark, spec):
    profiles, result = scored(
        spark, random_persons(5), random_diagnoses(5), random_weights(spec, 5), spec)
    listed = score.bene_hcc(profiles, spec)
    pairs = spark.createDataFrame(
        [(f"HCC{p:03d}", f"HCC{c:03d}") for p, cs in spec.drops.items() for c in cs],
        "parent string, child string")
    left = listed.join(pairs, F.col("hcc") == F.col("parent")).select(
        "hicn", F.col("child").alias("hcc")).join(listed, ["hicn", "hcc"], "left_semi")
    assert left.count() == 0
    assert listed.count() == result.select(F.sum(F.size("variables"))).first()[0]
    assert listed.where("upper(hcc) = 'ORIGDS'").count() == 0
