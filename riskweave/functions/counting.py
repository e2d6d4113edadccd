"""Counts that the jobs of a run make on the side, without a job or scan of their own."""

from __future__ import annotations

from collections import Counter

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Counts:
    """Numbers observed on the plans of a run.

    ``get`` is for after the result has been used: it waits for the jobs that observe.  A frame
    that is used by several jobs is counted by the first.  Like all of Spark's observed metrics
    the numbers are those of the tasks that ran; a task run again after a lost executor may be
    counted again, which changes the numbers and not the results.
    """

    def __init__(self) -> None:
        self._pending: list[tuple[Observation, tuple[str, ...]]] = []
        self._known: Counter[str] = Counter()

    def watch(self, df: DataFrame, **numbers: Column) -> DataFrame:
        observation = Observation()
        self._pending.append((observation, tuple(numbers)))
        return df.observe(observation, *(n.alias(name) for name, n in numbers.items()))

    def settle(self) -> dict[str, int]:
        """Take the numbers of all that is watched so far; only after jobs that used it."""
        found: Counter[str] = Counter()
        for observation, names in self._pending:
            found.update(dict.fromkeys(names, 0))
            try:
                found.update({name: n or 0 for name, n in observation.get.items()})
            except Py4JJavaError:
                # The optimizer saw that the frame is empty and took it out of the plan.
                continue
        self._pending.clear()
        self._known.update(found)
        return dict(found)

    def forget(self) -> None:
        """Drop what is watched so far: its rows are read from an earlier run."""
        self._pending.clear()

    def add(self, numbers: dict[str, int]) -> None:
        self._known.update(numbers)

    def get(self) -> dict[str, int]:
        """All numbers, and those that follow from them.

        ``diagnoses`` that count, with repeats; ``mapped_diagnoses`` and ``unmapped_diagnoses``;
        ``persons_with_categories``, whether known or not; ``unknown_persons`` among them;
        ``person_rows``; ``repeated_person_rows``; ``rows_without_weights``.
        """
        self.settle()
        found = dict(self._known)
        if "diagnoses" in found:
            found["unmapped_diagnoses"] = found["diagnoses"] - found["mapped_diagnoses"]
        if "persons_with_categories" in found and "_known_persons" in found:
            found["unknown_persons"] = (
                found["persons_with_categories"] - found.pop("_known_persons"))
        return found


def rows() -> Column:
    return F.count(F.lit(1))


def watched(counts: Counts | None, df: DataFrame, **numbers: Column) -> DataFrame:
    return df if counts is None else counts.watch(df, **numbers)
