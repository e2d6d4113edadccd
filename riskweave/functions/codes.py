"""Text comparison rules: keys match regardless of case and trailing blanks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: Column | str) -> Column:
    """Join-key form of a code or identifier."""
    return F.upper(F.rtrim(F.col(column) if isinstance(column, str) else column))


def any_of(tests: Iterable[Column]) -> Column:
    """At least one of the tests; false when there is none."""
    return reduce(or_, tests, F.lit(False))


def starts_with_any(column: str, codes: Sequence[str]) -> Column:
    return any_of(F.col(column).startswith(code) for code in codes)


def code_in(column: str, codes: Sequence[str]) -> Column:
    """Column holds one of the codes, trailing blanks ignored.

    The prefix test is implied by the exact one; it is there because a prefix can be pushed
    down to the file scan and a trimmed comparison cannot.
    """
    return starts_with_any(column, codes) & F.rtrim(column).isin(*codes)


def in_years(column: str, years: Iterable[int]) -> Column:
    """Date lies in one of the calendar years, as ranges that are pushed down to the scan."""
    ranges: list[list[int]] = []
    for year in sorted(set(years)):
        if ranges and ranges[-1][1] == year:
            ranges[-1][1] = year + 1
        else:
            ranges.append([year, year + 1])
    day = F.col(column)
    return any_of(
        (day >= F.lit(f"{first}-01-01").cast("date")) & (day < F.lit(f"{after}-01-01").cast("date"))
        for first, after in ranges
    )


def in_year(column: str, year: int) -> Column:
    return in_years(column, [year])


# Tests on computed values do not reach a file scan.  The following are implied by such tests:
# comparisons of bare columns that hold wherever the exact test holds.

def implied_by_concat(first: str, second: str, values: Sequence[str]) -> Column:
    """Implied by rtrim(first || second) being one of the values, none of which ends in a blank.

    Either ``first`` is a proper beginning of a value and ``second`` begins with the rest, or
    ``first`` begins with the whole value.
    """
    rests: dict[str, list[str]] = {}
    for value in values:
        for cut in range(len(value)):
            rests.setdefault(value[:cut], []).append(value[cut:])
    split = ((F.col(first) == head) & starts_with_any(second, tails)
             for head, tails in sorted(rests.items()))
    return any_of([*split, starts_with_any(first, values)])


def implied_by_blank_concat(first: str, second: str) -> Column:
    """Implied by first || second being NULL or nothing but blanks."""
    one, other = F.col(first), F.col(second)
    return one.isNull() | other.isNull() | (one == "") | one.startswith(" ")
