"""Byte pair encodings as dynamic programs over prefixes.

The encoding of a text by merges is the only sequence of tokens in which every two neighbours
``fit``: merging their joined text from scratch gives exactly these two.  And every prefix of
that sequence is the encoding of its own text.  So the last token of a prefix's encoding is the
one token ending there that fits the last token of the prefix before it.  One pass finds it for
every prefix, looking back no further than the longest token.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from functools import cached_property

PAIRS_REMEMBERED = 500_000


class Merges:
    """Tokens and the order of merges.

    ``order`` ranks a merge, by the pair of neighbours or else by their joined text: the
    smallest rank is merged first, the leftmost of equals.  Characters are the units; byte
    vocabularies use the 256 characters that stand for bytes in Latin-1.
    """

    def __init__(self, tokens, order: dict, by_pair: bool):
        self.tokens = frozenset(tokens)
        self._order = order
        self._by_pair = by_pair
        self._splits: dict[str, tuple | None] = {}
        # For each token, whether it fits the tokens seen before it.
        self._fits: dict[str, dict[str | None, bool]] = {}
        self._pairs = 0

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.tokens), default=1)

    @cached_property
    def _ending(self):
        """Finds, at every end in a text, the tokens that end there, longest first: token, size
        and what it is known to fit.

        Units are left out: where no longer token fits, the unit is the last token, fit or not.
        """
        import ahocorasick

        found = ahocorasick.Automaton()
        for token in self.tokens:
            if len(token) > 1:
                found.add_word(token, (token, len(token), self._fits.setdefault(token, {})))
        found.make_automaton()
        return found

    def order(self, left: str, right: str) -> float:
        return self._order.get((left, right) if self._by_pair else left + right, math.inf)

    def merged(self, text: str) -> tuple[list[str], tuple | None]:
        """Encoding of a short text by merging, and the last merge with its rank."""
        parts, last = list(text), None
        while len(parts) > 1:
            ranks = [self.order(a, b) for a, b in zip(parts, parts[1:], strict=False)]
            rank = min(ranks)
            if rank == math.inf:
                break
            at = ranks.index(rank)
            last = (rank, parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, last

    def _split(self, token: str) -> tuple | None:
        """Rank of the merge that made the token, and its parts; rank -1 for units, None for a
        token that merging never makes."""
        if token not in self._splits:
            parts, last = self.merged(token)
            self._splits[token] = None if len(parts) > 1 else last or (-1, token, token)
        return self._splits[token]

    def fits(self, left: str | None, right: str) -> bool:
        """Whether two tokens may be neighbours; ``left`` is None at the start of a text."""
        pairs = self._fits.setdefault(right, {})
        known = pairs.get(left)
        if known is None:
            known = self._split(right) is not None and (left is None or self._seam(left, right))
            if self._pairs >= PAIRS_REMEMBERED:
                for of_token in self._fits.values():
                    of_token.clear()
                self._pairs = 0
            pairs[left] = known
            self._pairs += 1
        return known

    def _seam(self, left: str, right: str) -> bool:
        """Undo the merges at the seam, latest first.  The tokens fit unless some pair across
        the seam would have been merged before one of its two was used up on its own side."""
        used_left = used_right = math.inf
        while True:
            across = self.order(left, right)
            if across < used_left and across <= used_right:
                return False
            made_left, made_right = self._split(left), self._split(right)
            if made_left[0] > made_right[0]:
                used_left, left = made_left[0], made_left[2]
            elif made_right[0] >= 0:
                used_right, right = made_right[0], made_right[1]
            else:
                return True

    def last_tokens(self, text: str) -> list[str | None]:
        """The last token of the encoding of every prefix of ``text``; None for length 0.

        A unit outside the vocabulary is a token of its own.
        """
        last: list[str | None] = [None, *text]
        if len(text) < 2 or self.longest < 2:
            return last
        fits, done = self.fits, -1
        for at, (token, size, known) in self._ending.iter(text):
            if at == done:
                continue  # found already: a longer token fitted
            before = last[at + 1 - size]
            found = known.get(before)
            if found or (found is None and fits(before, token)):
                last[at + 1] = token
                done = at
        return last

    def ends(self, text: str) -> Iterator[str]:
        """The same as a stream that keeps no more than the longest token spans."""
        size = self.longest + 1
        if size <= 2:
            yield from text
            return
        last: list[str | None] = [None] * size
        fits, upto = self.fits, 0
        for at, (token, length, known) in self._ending.iter(text):
            end = at + 1
            if end == upto:
                continue  # found already: a longer token fitted
            while upto < end - 1:
                last[(upto + 1) % size] = text[upto]
                yield text[upto]
                upto += 1
            before = last[(end - length) % size]
            found = known.get(before)
            if found or (found is None and fits(before, token)):
                last[end % size] = token
                yield token
                upto = end
        yield from text[upto:]


def prefix_counts(merges: Merges, text: str) -> list[int]:
    """Number of tokens of every prefix, from length 0 on."""
    counts = [0]
    for end, token in enumerate(merges.last_tokens(text)[1:], 1):
        counts.append(counts[end - len(token)] + 1)
    return counts


#: The bytes that byte-level vocabulary files write as the same character.
_PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
              *range(ord("®"), ord("ÿ") + 1)]


def byte_characters() -> dict[int, str]:
    """From the code of each character in a byte-level file to the byte, as Latin-1."""
    others = [b for b in range(256) if b not in _PRINTABLE]
    return {b: chr(b) for b in _PRINTABLE} | {256 + i: chr(b) for i, b in enumerate(others)}


def byte_level(path: str) -> tuple[Merges, list[str]]:
    """Merges, over bytes as Latin-1, and added tokens of a byte-level ``tokenizers`` file."""
    with open(path, encoding="utf-8") as file:
        loaded = json.load(file)
    to_byte = byte_characters()
    added = [t["content"] for t in loaded["added_tokens"]]
    tokens = [t.translate(to_byte) for t in loaded["model"]["vocab"] if t not in added]
    pairs = (p if isinstance(p, list) else p.split(" ") for p in loaded["model"]["merges"])
    order = {(a.translate(to_byte), b.translate(to_byte)): i for i, (a, b) in enumerate(pairs)}
    return Merges(tokens, order, by_pair=True), added
