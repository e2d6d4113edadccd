"""Sets of a model's members (condition categories, or output variables) as bits of bigints.

Member ``i`` of a set is bit ``i % 63`` of word ``i // 63``, whatever its number, so a model
takes as many words as it has members, and the sign bit is never used.  A fixed number of
bigints is an aggregation buffer that ``bit_or`` combines map-side inside generated code, however
many rows one person has.  Helpers return SQL text because the wide projections have over a
hundred columns.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

WORD_BITS = 63


@dataclass(frozen=True)
class BitSet:
    members: tuple[Hashable, ...]

    @cached_property
    def _position(self) -> dict[Hashable, int]:
        return {member: i for i, member in enumerate(self.members)}

    @property
    def words(self) -> int:
        return max(1, -(-len(self.members) // WORD_BITS))

    def place(self, member: Hashable) -> tuple[int, int]:
        """Word and bit of a member."""
        return divmod(self._position[member], WORD_BITS)

    def names(self, prefix: str) -> list[str]:
        return [f"{prefix}_{w}" for w in range(self.words)]

    def masks(self, members: Iterable[Hashable]) -> list[int]:
        words = [0] * self.words
        for member in members:
            word, bit = self.place(member)
            words[word] |= 1 << bit
        return words

    def any_of(self, prefix: str, members: Iterable[Hashable]) -> str:
        """True when at least one of the members is in the set."""
        tests = [
            f"({prefix}_{w} & {mask}L) <> 0" for w, mask in enumerate(self.masks(members)) if mask
        ]
        return f"({' or '.join(tests) or 'false'})"

    def has(self, prefix: str, member: Hashable) -> str:
        """1 when the member is in the set, else 0, as a byte."""
        word, bit = self.place(member)
        return f"getbit({prefix}_{word}, {bit})"

    def flag(self, prefix: str, member: Hashable) -> str:
        return f"cast({self.has(prefix, member)} as int)"

    def bit_of_number(self, number: str, word: int) -> str:
        """The bit that the member held by a column has in one word, else 0."""
        cases = " ".join(
            f"when {member} then {1 << bit}L"
            for member in self.members
            for at, bit in [self.place(member)]
            if at == word
        )
        return f"case {number} {cases} else 0L end" if cases else "0L"

    def drop_children(self, source: str, drops: Mapping[int, tuple[int, ...]], word: int) -> str:
        """One word of the set after every present parent has removed its children.

        All parents are read from the undropped ``source``, so the order of rules is
        irrelevant, given that the children of a child are children, too.
        """
        removed = []
        for parent, children in drops.items():
            if mask := self.masks(children)[word]:
                at, bit = self.place(parent)
                removed.append(_mask_if_bit(f"{source}_{at}", bit, mask))
        if not removed:
            return f"{source}_{word}"
        return f"{source}_{word} & ~({' | '.join(removed)})"


def _mask_if_bit(word: str, bit: int, mask: int) -> str:
    """``mask`` when the bit of the word is 1, else 0, without a branch.

    Minus one is all ones.  Dozens of branches would push the generated method beyond the
    size the JVM compiles.
    """
    return f"(-(shiftright({word}, {bit}) & 1L) & {mask}L)"


def bit_if(test: str, bit: int) -> str:
    """The bit when a test that is never NULL holds, else 0."""
    return f"shiftleft(cast({test} as bigint), {bit})"
