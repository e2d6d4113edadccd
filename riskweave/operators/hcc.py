"""Category flags, hierarchies and interactions per beneficiary.

The core row of a person is the *profile*: person columns, the category set before
(``pre_*``) and after (``post_*``) the hierarchies, and ``extra`` with the demographic and
interaction bits.  The wide 0/1 tables are projections of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.codes import normalized
from riskweave.functions.counting import Counts, rows, watched
from riskweave.models import ModelSpec, demographic_labels
from riskweave.operators.person import EXTRA, extra_bits, extra_flags, features, orec_adjusted


def with_sets(
    person: DataFrame, sets: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """Person rows with their category set; persons without a category get the empty set.

    Identifiers meet in key form, and the person's stays as given.
    """
    keyed = sets.withColumnRenamed("hicn", "_key")
    if counts is not None:
        # Rows of a key meet here as they do for the join.
        key = Window.partitionBy(normalized("hicn"))
        person = person.withColumns({
            "_copies": F.count(F.lit(1)).over(key),
            "_copy": F.row_number().over(key.orderBy("hicn")),
        })
    joined = person.join(keyed, normalized(person["hicn"]) == keyed["_key"], "left")
    joined = watched(
        counts, joined, person_rows=rows(),
        repeated_person_rows=F.count_if(F.col("_copies") > 1),
        _known_persons=F.count_if((F.col("_copy") == 1) & F.col("_key").isNotNull()),
    ).drop("_key", "_copies", "_copy")
    return joined.withColumns({w: F.coalesce(w, F.lit(0).cast("bigint"))
                               for w in spec.categories.names("pre")})


def profile(
    person: DataFrame, sets: DataFrame, spec: ModelSpec, counts: Counts | None = None
) -> DataFrame:
    """Everything known about a person in a handful of columns.

    Interactions read the set before the hierarchies.
    """
    featured = features(with_sets(person, sets, spec, counts), spec)
    post = {
        name: spec.categories.drop_children("pre", spec.drops, word)
        for word, name in enumerate(spec.categories.names("post"))
    }
    words = post | extra_bits(spec, "pre")
    return featured.withColumns({name: F.expr(text) for name, text in words.items()})


def _hcc_columns(spec: ModelSpec, source: str) -> list[str]:
    return [f"{spec.categories.flag(source, h)} as hcc{h:03d}" for h in spec.hccs]


def _snapshot_columns(spec: ModelSpec) -> list[str]:
    return [f"{spec.categories.flag('pre', h)} as cc_{h:02d}" for h in spec.drops]


def _interaction_columns(spec: ModelSpec) -> list[str]:
    return extra_flags(tuple(i.label for i in spec.interactions), spec.features)


def hcc_flags(person: DataFrame, sets: DataFrame, spec: ModelSpec) -> DataFrame:
    """One row per person, whatever the case of the identifier, and one 0/1 column per model category."""
    persons = person.groupBy(normalized("hicn").alias("_id")).agg(F.min("hicn").alias("hicn"))
    return with_sets(persons.drop("_id"), sets, spec).selectExpr("hicn", *_hcc_columns(spec, "pre"))


def hierarchy_snapshot(profiles: DataFrame, spec: ModelSpec) -> DataFrame:
    """hicn and ``cc_nn``: the parent categories as they were before the hierarchies."""
    return profiles.selectExpr("hicn", *_snapshot_columns(spec))


def interactions(profiles: DataFrame, spec: ModelSpec) -> DataFrame:
    """hicn and one 0/1 column per interaction."""
    return profiles.selectExpr("hicn", *_interaction_columns(spec))


def apply_hierarchies(profiles: DataFrame, spec: ModelSpec) -> DataFrame:
    """hicn and the category flags that the hierarchies leave."""
    return profiles.selectExpr("hicn", *_hcc_columns(spec, "post"))


def assemble(profiles: DataFrame, spec: ModelSpec) -> DataFrame:
    """The wide working row of a person, before hierarchies and score."""
    return orec_adjusted(profiles).selectExpr(
        "hicn",
        *_hcc_columns(spec, "pre"),
        "sex", "dob", "age", "orec_adjusted as orec", "disabled", "model",
        *extra_flags(demographic_labels(), spec.features),
        *_snapshot_columns(spec),
        *_interaction_columns(spec),
        "lookup_key",
        "0D as cms_risk_score",
    )
