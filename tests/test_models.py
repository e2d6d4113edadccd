from __future__ import annotations

import dataclasses

import pytest

from riskweave.checks import oracle
from riskweave.models import V22, V23, Interaction


@pytest.mark.parametrize(
    ("spec", "hccs", "parents", "drops", "labels"),
    [(V22, 79, 31, 57, 142), (V23, 83, 35, 68, 146)],
)
def test_sizes(spec, hccs, parents, drops, labels):
    assert len(spec.hccs) == hccs == len(set(spec.hccs))
    assert list(spec.hccs) == sorted(spec.hccs)
    assert len(spec.drops) == parents
    assert sum(map(len, spec.drops.values())) == drops
    assert len(spec.labels) == labels == len(set(spec.labels))
    assert len(spec.interactions) == 27


@pytest.mark.parametrize("spec", [V22, V23])
def test_labels_agree_with_the_checks_own_list(spec):
    assert list(spec.labels) == oracle._labels(spec.version)


@pytest.mark.parametrize("spec", [V22, V23])
def test_drops_are_transitively_closed(spec):
    for parent, children in spec.drops.items():
        for child in children:
            assert set(spec.drops.get(child, ())) <= set(children), (parent, child)


def test_v23_adds_four_categories_to_v22():
    assert set(V23.hccs) - set(V22.hccs) == {56, 59, 60, 138}
    assert set(V22.hccs) < set(V23.hccs)


def test_rules_must_name_model_categories():
    with pytest.raises(ValueError, match="unknown categories"):
        dataclasses.replace(V22, drops={8: (13,)})
    with pytest.raises(ValueError, match="unknown categories"):
        dataclasses.replace(V22, interactions=(Interaction("x", ((5,),), False),))
