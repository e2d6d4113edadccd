"""Secrets in texts: patterns, and values in a credential's place that are hard to guess.

Three patterns are fixed: assignments to a credential's name, access keys, and long hexadecimal
runs.  They match from the left without overlap within a kind; matches too short for their kind
are dropped.  Beyond them, every value in a credential's place (after a name as in ``NAMES`` and
a separator, in the userinfo of a URL, or in an authorization header) is priced by
``guess_cost``: the cheapest cut into words, dates, repeats, sequences, keyboard walks and
brute-force spans.  A value of ``LEAST_BITS`` or more that no other span holds becomes a span of
kind ``guess``; values of assignments are priced, too, and reported whatever their price.

Patterns run over the whole text, in time in proportion to its length.  Texts that cannot hold a
kind (a plain search says so) skip its pattern.

Defined cases: a null or empty text has no spans; rows are scanned each for itself, so repeated
rows and null ids change nothing; the caller's columns pass unchanged, and the new column takes
a longer name where one of them has its name in any case; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.llm.guess_cost import GuessCost
from riskweave.llm.texts import free_names

KINDS = ("assign", "access", "hex", "guess")
BASE = KINDS[:3]
SHORTEST = {"assign": 12, "access": 18, "hex": 16}
#: Values below about 2 ** 34, or 10 ** 10, guesses are not reported by price alone.
LEAST_BITS = 34
SHORTEST_VALUE = 8
#: Prices of values up to this length are remembered by a task, this many of them.
REMEMBERED_LENGTH, REMEMBERED = 256, 1 << 14

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The run is as long as it can be, so a shorter match is one that would be dropped.
HEX = re.compile(rf"[0-9a-f]{{{SHORTEST['hex']},}}")
NAMES = r"pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|" \
    r"(?:api|access|account|auth|client|encryption|master|private|shared|signing)[_-]?key"
VALUE = r"""[^\s"'`<>,;(){}\[\]]+"""
PLACES = (
    re.compile(rf"""(?:{NAMES})["'`]?\x20*(?::=|=>|->|[:=])\x20*["'`]?({VALUE})""",
               re.IGNORECASE | re.ASCII),
    re.compile(r"""://[^\s:/@"'<>]+:([^\s/@"'<>]+)@"""),
    re.compile(rf"""authorization["']?\x20*[:=]\x20*["']?(?:basic|bearer|token)\x20+({VALUE})""",
               re.IGNORECASE | re.ASCII),
)
#: A text must have one of these, A-Z lower-cased, to hold a name.
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "://", "authorization")
FINDING = "array<struct<kind:string,start:int,stop:int,millibits:int>>"
_HEX_RUN = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


class Scanner:
    """Findings of a text: (kind, start, stop, millibits or None), by start and kind."""

    def __init__(self, words: Sequence[str] = (), least_bits: float = LEAST_BITS):
        cost = GuessCost(words).cost
        self._least = round(1000 * least_bits)
        self._known = lru_cache(REMEMBERED)(cost)
        self._cost = cost

    def price(self, value: str) -> int:
        return (self._known if len(value) <= REMEMBERED_LENGTH else self._cost)(value)

    def find(self, text: str | None) -> list[tuple]:
        if not text:
            return []
        lower = text.lower()
        named = any(hint in lower for hint in HINTS)
        found = []
        if named:
            found += [("assign", *m.span(), self.price(m[2])) for m in ASSIGN.finditer(text)
                      if len(m[2]) >= SHORTEST["assign"]]
        if "AKIA" in text:
            found += [("access", *m.span(), None) for m in ACCESS.finditer(text)
                      if len(m[0]) >= SHORTEST["access"]]
        if b"x" * SHORTEST["hex"] in text.encode("utf-8", "replace").translate(_HEX_RUN):
            found += [("hex", *m.span(), None) for m in HEX.finditer(text)]
        if named:
            found += self._guessed(text, found)
        return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))

    def _guessed(self, text: str, found: list[tuple]) -> list[tuple]:
        """Values in a credential's place that no span holds and that are hard to guess."""
        values = set()
        for place in PLACES:
            for m in place.finditer(text):
                start = m.start(1)
                stop = start + len(m[1].rstrip(".:!?"))
                if stop - start >= SHORTEST_VALUE:
                    values.add((start, stop))
        taken = sorted((f[1], f[2]) for f in found)
        more, at, reach = [], 0, -1
        # Of values that begin at one place the longest; of those inside another, the outer.
        for start, stop in sorted(values, key=lambda v: (v[0], -v[1])):
            while at < len(taken) and taken[at][0] <= start:
                reach = max(reach, taken[at][1])
                at += 1
            if stop > reach and (price := self.price(text[start:stop])) >= self._least:
                more.append(("guess", start, stop, price))
                reach = max(reach, stop)
        return more


def scan(docs: DataFrame, words: Sequence[str] = (), least_bits: float = LEAST_BITS) -> DataFrame:
    """The caller's columns and ``findings``, in code points with the end exclusive.

    ``words`` are further words of passwords, the commonest first; they go to every task.
    """
    (name,), words = free_names(docs, "findings"), list(words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(words, least_bits)
        fields = ("kind", "start", "stop", "millibits")
        type_ = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                    ("stop", pa.int32()), ("millibits", pa.int32())]))
        for batch in batches:
            found = [
                [dict(zip(fields, f, strict=True)) for f in scanner.find(text.as_py())]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type_)], [*batch.schema.names, name]
            )

    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"{name} {FINDING}").fields])
    return docs.mapInArrow(rows, schema)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs).select("doc_id", "findings")

    def joined(findings: str):
        return F.array_join(F.transform(F.expr(findings), lambda f: F.concat_ws(
            ":", f["kind"], f["start"], f["stop"])), ",")

    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(findings, f -> f.kind = '{kind}')) as long)").alias(f"n_{kind}")
          for kind in BASE),
        F.sha2(joined("filter(findings, f -> f.kind <> 'guess')"), 256).alias("base_sha256"),
        joined("findings").alias("spans"),
        F.expr("cast(size(filter(findings, f -> f.kind = 'guess')) as long)").alias("n_guess"),
    )


QUERIES = {"op11_secret_scan": op11_secret_scan}
# The spans that the method adds are not expressible in SQL.
ORACLES: dict[str, str] = {}
