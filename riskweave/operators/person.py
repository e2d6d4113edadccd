"""Beneficiary preparation and the features that depend on demographics only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.bitset import BitSet, bit_if
from riskweave.functions.codes import normalized
from riskweave.models import (
    AGE_BANDS,
    AGE_SPLIT_BY_ENTITLEMENT,
    BAND_AT_SPLIT_OLD_AGE,
    BAND_AT_SPLIT_OTHER,
    COMMUNITY_MODELS,
    FULL_DUAL_CODES,
    INSTITUTIONAL_MEDICAID,
    INSTITUTIONAL_MODEL,
    NEVER,
    NEW_ENROLLEE_MODEL,
    ORIGINALLY_DISABLED,
    PARTIAL_DUAL_CODES,
    SEX_PREFIXES,
    Interaction,
    ModelSpec,
    demographic_labels,
)

PERSON_COLUMNS = ("hicn", "dob", "sex", "orec", "medicaid", "model")
# Words of bits: the demographic labels, then the interactions in label order.
EXTRA = "extra"
# The demographic labels alone fit the first word.
DEMOGRAPHIC = BitSet(demographic_labels())
assert DEMOGRAPHIC.words == 1


def prepare_person(eligibility: DataFrame) -> DataFrame:
    """Persons with an identifier, which stays as given; it is compared in key form."""
    return eligibility.where(F.col("hicn").isNotNull()).select(*PERSON_COLUMNS)


def duplicate_hicn(person: DataFrame) -> DataFrame:
    """Identifiers, in key form, that occur in more than one row, with their row count."""
    counts = person.groupBy(normalized("hicn").alias("hicn")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counts.where("row_count > 1")


def only_unique(person: DataFrame) -> DataFrame:
    """The same rows; using them fails when an identifier, in key form, occurs twice.

    The check is part of the plan: rows of a key meet for it, as they do for the join with
    categories, and no job of its own is run.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(normalized("hicn")))
    message = F.format_string("HICN %s occurs in %s person rows", "hicn", "_rows")
    counted = person.withColumn("_rows", rows)
    checked = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(F.lit(True))
    return counted.where(checked).drop("_rows")


def dual_status_class(code: Column | str) -> Column:
    """Medicaid dual status code -> 'partial' or 'full'; other codes -> NULL."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code.isin(*PARTIAL_DUAL_CODES), "partial").when(
        code.isin(*FULL_DUAL_CODES), "full"
    )


def age_disabled(person: DataFrame, spec: ModelSpec) -> DataFrame:
    """Adds age on the model's age date (days / 365.25, rounded down) and disabled 0/1."""
    days = F.datediff(F.lit(spec.age_date), "dob")
    # 365.25 is exact in binary, so whole quotients are exact and none is rounded up to one.
    age = F.floor(days / F.lit(365.25)).cast("int")
    return person.withColumn("age", age).withColumn(
        "disabled", F.expr("case when age < 65 and orec <> 0 then 1 else 0 end")
    )


def orec_adjusted(person: DataFrame) -> DataFrame:
    """Adds the reported entitlement code: 1 becomes 0 up to age 64.

    It is a new column.  Bands, originally-disabled and the lookup key use the raw code.
    """
    return person.withColumn(
        "orec_adjusted", F.expr("case when age <= 64 and orec = 1 then 0 else orec end")
    )


def lookup_key(person: DataFrame) -> DataFrame:
    """Adds the coefficient set the person is scored with; NULL for an unknown model.

    New enrollees up to age 64 always use entitlement 0.  ``||`` gives NULL when a part is.
    """
    community = ", ".join(f"'{m}'" for m in COMMUNITY_MODELS)
    return person.withColumn("lookup_key", F.expr(f"""
        case when model in ({community}) then model || cast(disabled as string)
             when model = '{INSTITUTIONAL_MODEL}' then model
             when model = '{NEW_ENROLLEE_MODEL}' then
                 model || cast(medicaid as string)
                 || case when age <= 64 then '0' when age > 64 then cast(orec as string) end
        end"""))


def _band_bits() -> str:
    """Bits 0..16: the bands an age falls in, before the sex is taken into account."""
    bit_of = {band[0]: bit for bit, band in enumerate(AGE_BANDS)}

    def ages(low: int, high: int | None) -> str:
        return f"age >= {low}" if high is None else f"age between {low} and {high}"

    def cases(new_enrollee_only: bool) -> str:
        return " ".join(
            f"when {ages(low, high)} then {1 << bit_of[suffix]}L"
            for suffix, low, high, only in AGE_BANDS
            if only == new_enrollee_only
        )

    split = (
        f"when age = {AGE_SPLIT_BY_ENTITLEMENT} and orec = 0"
        f" then {1 << bit_of[BAND_AT_SPLIT_OLD_AGE]}L"
        f" when age = {AGE_SPLIT_BY_ENTITLEMENT} and orec <> 0"
        f" then {1 << bit_of[BAND_AT_SPLIT_OTHER]}L"
    )
    # The bands of each kind exclude one another, so one case serves all of a kind.
    return (
        f"(case {cases(False)} {split} else 0L end"
        f" | case when model = '{NEW_ENROLLEE_MODEL}' then case {cases(True)} else 0L end"
        " else 0L end)"
    )


def demographic_bits() -> str:
    """SQL text of the demographic part of ``extra``."""
    labels = demographic_labels()
    shifts = " ".join(
        f"when {sex} then {i * len(AGE_BANDS)}" for i, (_, sex) in enumerate(SEX_PREFIXES)
    )
    bands = f"coalesce(shiftleft({_band_bits()}, case sex {shifts} end), 0L)"
    originally = " ".join(
        f"when {sex} then {1 << labels.index(label)}L" for label, sex in ORIGINALLY_DISABLED
    )
    return f"({bands} | case when orec = 1 then case sex {originally} else 0L end else 0L end)"


def interaction_test(rule: Interaction, categories: BitSet, source: str) -> str:
    """SQL text: the rule holds for the person row, on the category set ``source``."""
    if rule.groups == NEVER:
        return "false"
    if rule.groups == INSTITUTIONAL_MEDICAID:
        return f"coalesce(medicaid = 1 and model = '{INSTITUTIONAL_MODEL}', false)"
    tests = [categories.any_of(source, group) for group in rule.groups]
    if rule.disabled_only:
        tests.append("disabled = 1")
    return f"({' and '.join(tests)})"


def extra_bits(spec: ModelSpec, source: str) -> dict[str, str]:
    """Name and SQL text of each word of ``extra``."""
    terms: list[list[str]] = [[] for _ in range(spec.features.words)]
    terms[0].append(demographic_bits())
    for rule in spec.interactions:
        if rule.groups != NEVER:
            word, bit = spec.features.place(rule.label)
            terms[word].append(bit_if(interaction_test(rule, spec.categories, source), bit))
    return {
        name: " | ".join(parts) or "0L"
        for name, parts in zip(spec.features.names(EXTRA), terms, strict=True)
    }


def extra_flags(labels: tuple[str, ...], features: BitSet = DEMOGRAPHIC) -> list[str]:
    """0/1 columns, named by the lower-case labels, from the words ``extra``."""
    return [f"{features.flag(EXTRA, label)} as {label.lower()}" for label in labels]


def _demographic_words(person: DataFrame) -> DataFrame:
    return person.select("hicn", F.expr(demographic_bits()).alias(DEMOGRAPHIC.names(EXTRA)[0]))


def demographic_bands(person: DataFrame) -> DataFrame:
    """hicn and the 34 age/sex flags."""
    bands = demographic_labels()[: -len(ORIGINALLY_DISABLED)]
    return _demographic_words(person).selectExpr("hicn", *extra_flags(bands))


def originally_disabled(person: DataFrame) -> DataFrame:
    """hicn and the originally-disabled flag of each sex: raw entitlement code, no age test."""
    labels = tuple(label for label, _ in ORIGINALLY_DISABLED)
    return _demographic_words(person).selectExpr("hicn", *extra_flags(labels))


def features(person: DataFrame, spec: ModelSpec) -> DataFrame:
    """Person columns with age, disabled and lookup key."""
    return lookup_key(age_disabled(person, spec))
