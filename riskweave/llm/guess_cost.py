"""How many guesses a password needs, as the cheapest way to put it together.

A value is cut into segments; each is a word, a date, a repeat, a sequence, a keyboard walk, or
a brute-force span.  A segment costs the binary logarithm of the guesses that reach it, plus
``SEGMENT`` for naming its kind, and the value's cost is the least sum over all ways to cut it,
found by a program over prefixes.  Costs are whole thousandths of a bit, so sums are exact.
Segments other than brute-force spans have at most ``LONGEST`` characters; time and memory
grow with the value's length, however long it is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

# --------------------------------------------------------------------------
# Words that passwords are made of, the commonest first, and a keyboard.
# --------------------------------------------------------------------------
WORDS = """
password admin welcome login letmein secret master dragon monkey shadow sunshine princess
football baseball superman batman michael jordan jennifer hunter trustno qwerty iloveyou hello
freedom whatever starwars computer internet service server system manager user guest root test
demo example sample change changeme default temp public private pass word key token access
account email mail office company database oracle mysql postgres redis docker spring summer
autumn winter january february march april june july august september october november december
monday tuesday wednesday thursday friday saturday sunday love money magic cheese coffee orange
apple banana pepper ginger cookie chocolate flower angel silver golden black white green blue
red purple yellow happy lucky sweet super power strong secure safe house home family mother
father brother sister charlie robert daniel thomas george andrew jessica ashley nicole amanda
your here none null true false string value config process environ
""".split()
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s",
        "7": "t", "+": "t"}
#: Rows of a keyboard, plain and shifted, and how far each row is moved to the right.
KEYS = (
    ("`1234567890-=", "~!@#$%^&*()_+", 0.0),
    ("qwertyuiop[]\\", "QWERTYUIOP{}|", 1.5),
    ("asdfghjkl;'", "ASDFGHJKL:\"", 1.75),
    ("zxcvbnm,./", "ZXCVBNM<>?", 2.25),
)
# --------------------------------------------------------------------------
# End of the fixed values.
# --------------------------------------------------------------------------

LONGEST = 64
SHORTEST_WORD = 3
SHORTEST_RUN = 3
LONGEST_UNIT = 8
YEARS = range(1900, 2100)
NEVER = 1 << 62


def millibits(guesses: float) -> int:
    return round(1000 * math.log2(guesses))


SEGMENT = millibits(6)  # one of six kinds
DIGIT, LETTER, SIGN, OTHER = (millibits(n) for n in (10, 26, 33, 100))
YEAR, DATE = millibits(len(YEARS)), millibits(len(YEARS) * 366)
KEY, TURN = millibits(47), millibits(6)
TIMES = [0] + [millibits(n) for n in range(1, LONGEST + 1)]
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_PLAIN = {ord(a): b for a, b in LEET.items()}
_PLACES = {
    key: (column + shift, row)
    for row, (plain, shifted, shift) in enumerate(KEYS)
    for keys in (plain, shifted)
    for column, key in enumerate(keys)
}


def character(c: str) -> int:
    """Cost of one character in a brute-force span, whose kind of character is known."""
    if "0" <= c <= "9":
        return DIGIT
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return LETTER
    return SIGN if c < "\x80" else OTHER


def walk_step(a: str, b: str) -> tuple[int, int] | None:
    """Direction from a key to a neighbouring one, None when they are no neighbours."""
    if a not in _PLACES or b not in _PLACES:
        return None
    (x, y), (u, v) = _PLACES[a], _PLACES[b]
    if abs(u - x) > 1 or abs(v - y) > 1 or (x, y) == (u, v):
        return None
    return (u > x) - (u < x), v - y


def _same_kind(a: str, b: str) -> bool:
    return any(low <= a <= high and low <= b <= high for low, high in ("09", "az", "AZ"))


def sequence_step(a: str, b: str) -> int:
    """1 or -1 when b follows or precedes a among digits or letters of one case, else 0."""
    return ord(b) - ord(a) if abs(ord(b) - ord(a)) == 1 and _same_kind(a, b) else 0


def is_repeat(unit: str) -> bool:
    return unit in (unit + unit)[1:-1]


def _dates(value: str, i: int) -> Iterator[tuple[int, int]]:
    for size in (4, 6, 8, 10):
        cost = date(value[i:i + size]) if i + size <= len(value) else None
        if cost is not None:
            yield i + size, cost


def _walks(value: str, i: int) -> Iterator[tuple[int, int]]:
    """Sequences in one direction, and walks over neighbouring keys with turns."""
    end = min(len(value), i + LONGEST)
    if i + 1 >= end:
        return
    way, j = sequence_step(value[i], value[i + 1]), i + 1
    while way and j < end and sequence_step(value[j - 1], value[j]) == way:
        j += 1
        if j - i >= SHORTEST_RUN:
            yield j, KEY + TIMES[j - i]
    turns, last = 0, None
    for j in range(i + 1, end):
        heading = walk_step(value[j - 1], value[j])
        if heading is None:
            return
        turns += last is not None and heading != last
        last = heading
        if j + 1 - i >= SHORTEST_RUN:
            yield j + 1, KEY + TIMES[j + 1 - i] + turns * TURN


class GuessCost:
    """Costs with a ranked list of words: ``WORDS`` and then the caller's."""

    def __init__(self, more: Sequence[str] = ()):
        self._rank: dict[str, int] = {}
        for word in (*WORDS, *(w.translate(_ASCII_LOWER) for w in more)):
            if SHORTEST_WORD <= len(word) <= LONGEST:
                self._rank.setdefault(word, len(self._rank) + 1)
        self._longest = max(map(len, self._rank))
        self._heads = {word[:SHORTEST_WORD] for word in self._rank}
        self._unit = lru_cache(1 << 12)(self.cost)

    def word(self, segment: str) -> int | None:
        """Its rank, a bit or more for capitals, and a bit for every character replaced."""
        lower = segment.translate(_ASCII_LOWER)
        rank, replaced = self._rank.get(lower), 0
        if rank is None:
            plain = lower.translate(_PLAIN)
            rank = self._rank.get(plain)
            replaced = sum(map(str.__ne__, lower, plain))
        if rank is None:
            return None
        capitals = sum("A" <= c <= "Z" for c in segment)
        first_or_all = capitals == len(segment) or (capitals == 1 and "A" <= segment[0] <= "Z")
        case = 0 if not capitals else 1000 if first_or_all else (
            1000 + millibits(math.comb(len(segment), capitals))
        )
        return millibits(rank) + case + 1000 * replaced

    def _words(self, value: str, i: int) -> Iterator[tuple[int, int]]:
        for j in range(i + SHORTEST_WORD, min(len(value), i + self._longest) + 1):
            cost = self.word(value[i:j])
            if cost is not None:
                yield j, cost

    def _repeats(self, value: str, i: int) -> Iterator[tuple[int, int]]:
        """A unit of a few characters, itself no repeat, two times or more."""
        end = min(len(value), i + LONGEST)
        for size in range(1, LONGEST_UNIT + 1):
            unit = value[i:i + size]
            if i + 2 * size > end or not value.startswith(unit, i + size) or is_repeat(unit):
                continue
            j, times, cost = i + size, 1, self._unit(unit)
            while j + size <= end and value.startswith(unit, j):
                j, times = j + size, times + 1
                if size * times >= SHORTEST_RUN:
                    yield j, cost + TIMES[times]

    def _segments(self, value: str, lower: str, plain: str, i: int) -> Iterator[tuple[int, int]]:
        """(end, cost) of the segments that begin at i, but for brute force.

        Each kind is tried only where its first characters allow it.
        """
        head = slice(i, i + SHORTEST_WORD)
        if lower[head] in self._heads or plain[head] in self._heads:
            yield from self._words(value, i)
        if "0" <= value[i] <= "9":
            yield from _dates(value, i)
        if value[i] in value[i + 1:i + 1 + LONGEST_UNIT]:
            yield from self._repeats(value, i)
        yield from _walks(value, i)

    def cost(self, value: str) -> int:
        """Thousandths of a bit; 0 for an empty value."""
        lower = value.translate(_ASCII_LOWER)
        plain = lower.translate(_PLAIN)
        best = [0] + [NEVER] * len(value)
        open_span = NEVER
        for i, c in enumerate(value):
            here = best[i] + SEGMENT
            for j, cost in self._segments(value, lower, plain, i):
                if here + cost < best[j]:
                    best[j] = here + cost
            # A brute-force span goes on, or begins here.
            open_span = min(open_span, here) + character(c)
            best[i + 1] = min(best[i + 1], open_span)
        return best[-1]


def date(segment: str) -> int | None:
    """A year, six or eight digits, or eight digits with two separators, that name a day."""
    digits = segment
    if len(segment) == 10:
        marks = {c for c in segment if c in "-/._"}
        digits = "".join(c for c in segment if c not in marks) if len(marks) == 1 else ""
        shape = [c in marks for c in segment]
        if len(digits) != 8 or shape not in (
            [k in (4, 7) for k in range(10)], [k in (2, 5) for k in range(10)]
        ):
            return None
    if len(digits) not in (4, 6, 8) or not (digits.isascii() and digits.isdigit()):
        return None
    if len(digits) == 4:
        return YEAR if int(digits) in YEARS else None
    extra = 2000 if len(segment) == 10 else 0
    n = [int(digits[k:k + 2]) for k in range(0, len(digits), 2)]
    if len(digits) == 6:
        named = _day(n[1], n[2]) or _day(n[1], n[0]) or _day(n[0], n[1])
    else:
        named = (int(digits[:4]) in YEARS and _day(n[2], n[3])) or (
            int(digits[4:]) in YEARS and (_day(n[1], n[0]) or _day(n[0], n[1])))
    return DATE + extra if named else None


def _day(month: int, day: int) -> bool:
    return 1 <= month <= 12 and 1 <= day <= 31
