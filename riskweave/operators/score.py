"""Risk score and the list of variables behind it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.counting import Counts, watched
from riskweave.functions.lookups import lookup_join
from riskweave.functions.rounding import COEF_DECIMALS, normalized_score
from riskweave.models import ModelSpec, demographic_labels
from riskweave.operators.person import EXTRA


def _variables(spec: ModelSpec, categories: str = "post") -> list[tuple[str, str]]:
    """(label, SQL text that is 1 when the person has it) of every output variable."""
    found = [
        (label, spec.categories.has(categories, h))
        for label, h in zip(spec.hcc_labels, spec.hccs, strict=True)
    ]
    others = [(label, spec.features.has(EXTRA, label)) for label in spec.features.members]
    first = len(demographic_labels())
    return others[:first] + found + others[first:]


def set_positions(spec: ModelSpec) -> Column:
    """Ascending report positions (from 0) of the variables that are 1.

    Written out instead of a lambda over a table of bits: inside a lambda the optimizer would
    repeat the hierarchy expressions for every element.
    """
    entries = ", ".join(
        f"if({has} = 1, {pos}, -1)" for pos, (_, has) in enumerate(_variables(spec))
    )
    return F.expr(f"array_remove(array({entries}), -1)")


def _texts(values: Iterable[str]) -> Column:
    """Array literal."""
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")


def _label_at(spec: ModelSpec, position: Column) -> Column:
    return F.get(_texts(spec.labels), position)


def weight_vectors(weights: DataFrame, spec: ModelSpec) -> DataFrame:
    """(lookup_key, coefs): one integer coefficient per variable, in report order.

    A key with a NULL coefficient scores 0 for everyone, whichever variables the person has, so
    it is left out and then treated like an unknown key.  A key that has some of the variables
    but lacks one is an error, and so are two values for one (key, variable), since either
    could win.
    """
    known = [label.upper() for label in spec.labels]
    single = (
        weights.where(F.col("lookup_key").isNotNull() & F.col("variable").isin(*known))
        .groupBy("lookup_key", "variable")
        .agg(F.count(F.lit(1)).alias("n"), F.max("coef").alias("coef"))
    )
    duplicate = F.format_string("two weights for key %s, variable %s", "lookup_key", "variable")
    units = (F.col("coef") * F.lit(10**COEF_DECIMALS)).cast("bigint")
    entry = F.struct("variable", F.when(F.col("n") > 1, F.raise_error(duplicate))
                     .otherwise(units).alias("units"))
    by_key = single.groupBy("lookup_key").agg(
        F.map_from_entries(F.collect_list(entry)).alias("by_name")
    )
    lacking = F.filter(_texts(known), lambda name: ~F.map_contains_key("by_name", name))
    absent = F.format_string("no weight for key %s, variable %s", "lookup_key", F.get(lacking, 0))
    complete = F.when(F.size(lacking) > 0, F.raise_error(absent)).otherwise(F.lit(True))
    by_key = by_key.where(complete)
    coefs = F.transform(_texts(known), lambda name: F.element_at("by_name", name))
    return by_key.select("lookup_key", coefs.alias("coefs")).where(
        F.forall("coefs", lambda c: c.isNotNull())
    )


def scored(
    profiles: DataFrame, weights: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """hicn, lookup_key, cms_risk_score and the variable labels, one row per person row."""
    rows = profiles.select("hicn", "lookup_key", set_positions(spec).alias("positions"))
    joined = lookup_join(
        rows, weight_vectors(weights, spec), ["lookup_key"], "left",
        spread_by=["hicn"],
    )
    joined = watched(counts, joined, rows_without_weights=F.count_if(F.col("coefs").isNull()))
    units = F.expr("aggregate(positions, 0L, (total, p) -> total + coefs[p])")
    return joined.withColumn("units", F.coalesce(units, F.lit(0))).select(
        "hicn",
        "lookup_key",
        F.expr(normalized_score("units", spec)).alias("cms_risk_score"),
        F.transform("positions", lambda p: _label_at(spec, p)).alias("variables"),
    )


def risk_score(profiles: DataFrame, weights: DataFrame, spec: ModelSpec) -> DataFrame:
    """hicn, lookup key and score; a person without usable weights scores 0."""
    return scored(profiles, weights, spec).drop("variables")


def bene_hcc(profiles: DataFrame, spec: ModelSpec) -> DataFrame:
    """(hicn, hcc): every variable of the person that is 1, after hierarchies."""
    positions = profiles.select("hicn", F.explode(set_positions(spec)).alias("p"))
    return positions.select("hicn", _label_at(spec, F.col("p")).alias("hcc"))


def bene_score(profiles: DataFrame, weights: DataFrame, spec: ModelSpec) -> DataFrame:
    """(hicn, cms_risk_score)."""
    return risk_score(profiles, weights, spec).select("hicn", "cms_risk_score")


def _found_variables(spec: ModelSpec) -> str:
    """SQL text: (position, categories that dropped it) of what is 1 before the hierarchies."""
    parents: dict[int, list[int]] = {}
    for parent, children in spec.drops.items():
        for child in children:
            parents.setdefault(child, []).append(parent)
    number = dict(zip(spec.hcc_labels, spec.hccs, strict=True))
    entries = []
    for position, (label, has) in enumerate(_variables(spec, "pre")):
        by = ", ".join(
            f"if({spec.categories.has('pre', p)} = 1, 'HCC{p:03d}', null)"
            for p in sorted(parents.get(number.get(label), ()))
        )
        dropped = f"array_compact(array({by}))" if by else "cast(array() as array<string>)"
        entries.append(
            f"if({has} = 1, named_struct('position', {position}, 'dropped_by', {dropped}), null)"
        )
    return f"array_compact(array({', '.join(entries)}))"


def explained(profiles: DataFrame, weights: DataFrame, spec: ModelSpec) -> DataFrame:
    """(hicn, hcc, dropped_by, coefficient, contribution): why each variable counts or does not.

    One row for every variable that a person has before the hierarchies.  ``dropped_by`` names
    the present categories that removed it, joined by "|", and is empty for a variable that
    counts.  ``coefficient`` is that of the person's lookup key, NULL where the key has no
    usable weights; ``contribution`` is what the variable adds to the raw sum, so a person's
    contributions add up to the score before coding intensity and normalization.
    """
    found = profiles.select("hicn", "lookup_key", F.expr(f"inline({_found_variables(spec)})"))
    joined = lookup_join(
        found, weight_vectors(weights, spec), ["lookup_key"], "left",
        spread_by=["hicn", "position"],
    )
    coefficient = F.get("coefs", F.col("position")).cast("double") / float(10**COEF_DECIMALS)
    counts = (F.size("dropped_by") == 0) & F.col("coefs").isNotNull()
    return joined.select(
        "hicn",
        _label_at(spec, F.col("position")).alias("hcc"),
        F.array_join("dropped_by", "|").alias("dropped_by"),
        coefficient.alias("coefficient"),
        F.when(counts, coefficient).otherwise(0.0).alias("contribution"),
    )
