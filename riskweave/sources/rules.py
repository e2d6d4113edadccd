"""A model version whose rules come as tables instead of code.

``categories``: ``hcc``.  ``drops``: ``parent, child``, chains need not be written out.
``interactions``: ``position, label, kind, disabled_only, grp, hcc`` with one row for each
category of each group that the rule needs; a rule without categories has one row with NULL
``grp`` and ``hcc``.  ``kind`` is ``groups`` (every group is hit), ``institutional Medicaid`` or
``never``.  Rules run in the order of ``position``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from riskweave.models import INSTITUTIONAL_MEDICAID, NEVER, Interaction, ModelSpec

GROUPS = "groups"
#: Rules are read to the driver, which builds expressions of them: a table of more rows is refused.
MAX_ROWS = 20_000
DROPS = "parent int, child int"
INTERACTIONS = (
    "position int, label string, kind string, disabled_only boolean, grp int, hcc int"
)


def _rows(df: DataFrame, *columns: str) -> list[Row]:
    found = df.select(*columns).distinct().limit(MAX_ROWS + 1).collect()
    if len(found) > MAX_ROWS:
        raise ValueError(f"a rule table has more than {MAX_ROWS} rows")
    return sorted(found, key=lambda row: tuple((v is not None, v) for v in row))


def _interactions(rows: list[Row]) -> tuple[Interaction, ...]:
    rules: dict[int, Interaction] = {}
    groups: dict[int, dict[int, list[int]]] = {}
    for row in rows:
        if row.kind not in (GROUPS, INSTITUTIONAL_MEDICAID, NEVER):
            raise ValueError(f"interaction {row.label} is of an unknown kind: {row.kind}")
        rule = Interaction(row.label, row.kind, bool(row.disabled_only))
        if rules.setdefault(row.position, rule) != rule:
            raise ValueError(f"position {row.position} holds two interactions")
        if row.kind == GROUPS:
            if row.grp is None or row.hcc is None:
                raise ValueError(f"interaction {row.label} lacks a group or category")
            groups.setdefault(row.position, {}).setdefault(row.grp, []).append(row.hcc)
    return tuple(
        Interaction(rule.label, tuple(tuple(groups[at][g]) for g in sorted(groups[at])),
                    rule.disabled_only) if rule.groups == GROUPS else rule
        for at, rule in sorted(rules.items())
    )


def read_spec(
    version: str, categories: DataFrame, drops: DataFrame, interactions: DataFrame,
    normalization_millis: int, **others,
) -> ModelSpec:
    """The spec of the tables; ``others`` are further fields of ``ModelSpec``."""
    children: dict[int, list[int]] = {}
    for row in _rows(drops, "parent", "child"):
        children.setdefault(row.parent, []).append(row.child)
    columns = [part.split()[0] for part in INTERACTIONS.split(", ")]
    return ModelSpec(
        version=version,
        hccs=tuple(row.hcc for row in _rows(categories, "hcc")),
        drops={parent: tuple(found) for parent, found in children.items()},
        interactions=_interactions(_rows(interactions, *columns)),
        normalization_millis=normalization_millis,
        **others,
    )


def rule_tables(spark: SparkSession, spec: ModelSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Categories, drops and interactions of a spec as tables, to be edited and read again."""
    rows = []
    for position, rule in enumerate(spec.interactions):
        head = (position, rule.label)
        if isinstance(rule.groups, str):
            rows.append((*head, rule.groups, rule.disabled_only, None, None))
        else:
            rows += [(*head, GROUPS, rule.disabled_only, g, hcc)
                     for g, group in enumerate(rule.groups) for hcc in group]
    pairs = [(parent, child) for parent, found in spec.drops.items() for child in found]
    return (
        spark.createDataFrame([(h,) for h in spec.hccs], "hcc int"),
        spark.createDataFrame(pairs, DROPS),
        spark.createDataFrame(rows, INTERACTIONS),
    )
