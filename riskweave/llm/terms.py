"""Terms of whole texts, read off their UTF-8 bytes.

Every byte of a character beyond ASCII is 128 or more, so a class of terms that takes all such
characters and some ASCII ones is a table of 256 bytes: separators become blanks and A-Z become
a-z in one pass, and terms are what stands between blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

DIGITS = b"0123456789"
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
#: A text is cut into lists of terms at the first separator after this many bytes.
SLICE = 1 << 20


def byte_table(ascii_terms: bytes) -> bytes:
    """Table that keeps the given ASCII bytes and all beyond ASCII; A-Z count as a-z."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in ascii_terms:
        table[byte] = byte
        table[bytes([byte]).upper()[0]] = byte
    return bytes(table)


def term_lists(text: bytes | None, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size unless one term is longer."""
    plain = (text or b"").translate(table)
    start = 0
    while start < len(plain):
        stop = plain.find(b" ", start + SLICE)
        stop = len(plain) if stop < 0 else stop
        yield plain[start:stop].split()
        start = stop
