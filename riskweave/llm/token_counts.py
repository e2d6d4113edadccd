"""Exact token counts of every prefix of a text.

A text is cut into pre-tokens, which merges never cross, and a dynamic program counts the
tokens of every prefix of a pre-token (see ``bpe``).  Those counts are stored by offset inside
the pre-token; the count of a text is the sum of the last ones.  ``prefixes`` stores the count of
every prefix of a text.  A prefix that ends in white space, a contraction or an added token can be
cut otherwise than the whole text; its last two pre-tokens are then cut again while storing.
Truncation (the longest prefix within a budget) and budget questions only read stored counts.

Pre-tokens repeat, so each task remembers their counts, up to ``REMEMBERED`` of them; that is
a bound on memory and changes no result.

Defined cases: a null text is empty and has 0 tokens; strings of added tokens inside a text
count as one token; texts of any length are read whole; repeated rows come out repeated; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe
from riskweave.llm.texts import whole

LIMIT = 512
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
#: Fixed value: how the byte-level vocabulary cuts texts.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class PrefixCounter:
    def __init__(self, path: str):
        self.merges, self.added = bpe.byte_level(path)
        special = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self._special = regex.compile(f"({special})") if self.added else None
        self._pieces = regex.compile(PATTERN)
        self._space = regex.compile(r"\s*")
        # A pre-token may be cut in two where it ends a prefix.
        self._contraction = regex.compile("'(?:s|t|re|ve|m|ll|d)")
        self._counts: dict[str, array] = {}

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and added tokens, which together are the text."""
        if self._special is None or not self._special.search(text):
            return self._pieces.findall(text)
        found: list[str] = []
        for part in self._special.split(text):
            found += [part] if part in self.added else self._pieces.findall(part)
        return found

    def _inside(self, piece: str) -> array:
        """Tokens of every prefix of a pre-token, by code points from 0 on.  Of an added token
        only the last one counts."""
        known = self._counts.get(piece)
        if known is None:
            if piece in self.added:
                known = array("I", [0] * len(piece) + [1])
            else:
                known = array("I", bpe.prefix_counts(self.merges, piece.encode().decode("latin-1")))
                if len(known) > len(piece) + 1:  # counted by bytes
                    at, kept = 0, array("I", [0])
                    for char in piece:
                        at += len(char.encode())
                        kept.append(known[at])
                    known = kept
            if len(self._counts) >= REMEMBERED:
                self._counts.clear()
            if len(piece) <= LONGEST_REMEMBERED:
                self._counts[piece] = known
        return known

    def count(self, text: str) -> int:
        """Tokens of the whole text: the sum of the counts at the ends of its pre-tokens."""
        inside, known = self._inside, self._counts
        return sum((known.get(piece) or inside(piece))[-1] for piece in self.pieces(text))

    def prefixes(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the pre-tokens, in code points, and the count of every prefix; both begin
        with 0."""
        ends, counts = [0], [0]
        before, upto, base = "", 0, 0  # the pre-token before, tokens before it and before this one
        for piece in self.pieces(text):
            inside = self._inside(piece)
            counts += [base + n for n in inside[1:]]
            if piece in self.added or self._contraction.fullmatch(piece):
                again = len(piece) - 1
            elif before and self._space.fullmatch(before[-1]):
                again = self._space.match(piece).end()
            else:
                again = 0
            for length in range(1, again + 1):
                counts[ends[-1] + length] = upto + self.count(before + piece[:length])
            ends.append(ends[-1] + len(piece))
            before, upto, base = piece, base, base + inside[-1]
        return ends, counts

    def at(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Tokens of the first ``length`` code points."""
        return counts[length]

    def fitting(self, text: str, ends: list[int], counts: list[int], budget: int) -> int:
        """Length of the longest prefix within the budget; 0 if there is none."""
        # From the longest down: counts of prefixes are not monotone.
        return next((n for n in range(len(text), -1, -1) if counts[n] <= budget), 0)


def _mapped(path: str, schema: pa.Schema, row) -> callable:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            ids, texts = batch.columns
            found = [row(counter, text) for text in texts.to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * (len(schema) - 1)
            typed = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *typed], schema=schema)

    return over


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), whole(F.col("text")).alias("text"))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text."""

    def row(counter: PrefixCounter, text: str) -> tuple:
        n = counter.count(text)
        return len(text.encode()), n, n > limit

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
    return _read(docs).mapInArrow(
        _mapped(path, schema, row),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id with the ends of the text's pre-tokens and the token count of every prefix."""
    schema = pa.schema([("doc_id", pa.int64()), ("ends", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int32()))])
    return _read(docs).mapInArrow(
        _mapped(path, schema, lambda counter, text: counter.prefixes(text)),
        "doc_id long, ends array<int>, counts array<int>",
    )


def truncate(docs: DataFrame, path: str, budget: int = LIMIT) -> DataFrame:
    """doc_id, the text's longest prefix within the budget, and its tokens."""

    def row(counter: PrefixCounter, text: str) -> tuple:
        ends, counts = counter.prefixes(text)
        length = counter.fitting(text, ends, counts, budget)
        return text[:length], counter.at(text, ends, counts, length)

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64())])
    return _read(docs).mapInArrow(
        _mapped(path, schema, row), "doc_id long, text string, n_tokens long"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op6_token_counts": op6_token_counts}
ORACLES: dict[str, str] = {}
