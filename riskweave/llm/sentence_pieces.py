"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The pass reads a text once.  For every boundary between characters it finds the piece that ends
there on the best path and keeps a backpointer, but only within a window as long as the longest
piece: no later piece can start before it.  When the paths from all boundaries of the window
lead back through one boundary, everything up to it is final; its ids are put out and forgotten.
Memory is bounded by the window and the stretch between two such boundaries, not by the text.

The vocabulary is one of merges (its scores are the order of merging), so a path is valid when
every two neighbouring pieces fit (see ``bpe``); at each boundary exactly one such path ends, and
it is the one the library takes.  No piece has a word mark inside, so where a word begins every
piece of the window ends or begins: all paths meet, and looking at the next character shows it.
The pass commits there at once, and ``_meeting`` looks for meeting paths only in stretches that
outgrow the window.  What lies between two such places always gives the same ids; the task
remembers it, up to ``REMEMBERED`` stretches, which bounds memory and changes no result.  Ids are
put out for each ``CHUNK`` of the text, rows by ``BLOCK``, so that a task holds the ids of few
texts at a time.

Model rules followed: one space is put before a text, spaces are written as the word mark,
characters outside the vocabulary become byte pieces.

Defined cases: a null or empty text has no ids and decodes to the empty text; ids of control
pieces decode to nothing; a word mark inside a text comes back as a space, as the library does
it; other columns stay as they are unless named like an output, in any case; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.bpe import Merges
from riskweave.llm.memory import giving_back
from riskweave.llm.texts import whole, with_text

MARK = "▁"
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64
CHUNK = 1 << 16
BLOCK = 256


class Pieces:
    """A SentencePiece model of merges with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.texts = [model.id_to_piece(i) for i in ids]
        self.control = {i for i in ids if model.is_control(i) or model.is_unknown(i)}
        self.byte_id = {int(self.texts[i][3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        normal = [i for i in ids if i not in self.control and i not in self.byte_of]
        self.ids = {self.texts[i]: i for i in normal}
        # Pieces are merged by score, best first.
        rank = {self.texts[i]: -model.get_score(i) for i in normal if len(self.texts[i]) > 1}
        self.merges = Merges(self.ids, rank, by_pair=False)
        # Where a run of word marks begins no piece goes on, unless one has such a place inside.
        inner = any(MARK in p.lstrip(MARK) for p in self.ids)
        self._stretch = None if inner else regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        # Ids, as bytes, of stretches without the word mark at their beginning.
        self._known: dict[str, bytes] = {}
        self._bytes = [
            b"" if i in self.control else self.byte_of.get(i, self.texts[i].encode()) for i in ids
        ]
        #: Ids committed where paths meet, and ids that the end of a text commits.
        self.met = self.ended = 0

    def _window(self, text: str) -> Iterator[list[int]]:
        """Ids of a stretch, put out as soon as they are final."""
        width = self.merges.longest
        held: dict[int, str | None] = {0: None}  # boundary -> piece that ends there
        done, end = 0, 0
        for end, piece in enumerate(self.merges.ends(text), 1):
            held[end] = piece
            if end - done >= 2 * width:
                meet = self._meeting(held, done, end, width)
                if meet > done:
                    yield self._ids(held, done, meet)
                    for gone in range(done, meet):
                        del held[gone]
                    done = meet
        if end > done:
            yield self._ids(held, done, end)

    @staticmethod
    def _meeting(held: dict, done: int, end: int, width: int) -> int:
        """The last boundary that is on the paths of all boundaries in the window."""
        live = set(range(max(done, end - width + 1), end + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(max(done, furthest - len(held[furthest])))
        return live.pop()

    def _ids(self, held: dict | list, start: int, stop: int) -> list[int]:
        """Ids of the path that leads from ``stop`` back to ``start``."""
        known, found = self.ids, []
        while stop > start:
            piece = held[stop]
            stop -= len(piece)
            if piece in known:
                found.append(known[piece])
            else:
                found += (self.byte_id[b] for b in reversed(piece.encode()))
        found.reverse()
        return found

    def _committed(self, unmarked: str) -> bytes:
        """Ids between two places where all paths meet, by the pass; remembered."""
        stretch = MARK + unmarked
        if len(stretch) < 2 * self.merges.longest:  # the window holds it all
            found = self._ids(self.merges.last_tokens(stretch), 0, len(stretch))
        else:
            found = [i for part in self._window(stretch) for i in part]
        found = array("i", found).tobytes()
        if len(stretch) <= LONGEST_REMEMBERED:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[unmarked] = found
        return found

    def _stretches(self, marked: str) -> list[str]:
        """The stretches, without the mark that each begins with."""
        if not self._stretch:
            return [marked[1:]]
        found = marked.split(MARK)
        del found[0]
        return [s[1:] for s in self._stretch.findall(marked)] if "" in found else found

    def _meets(self, text: str, start: int) -> int:
        """The first place from ``start`` on where a word begins, or the text's end."""
        at = text.find(MARK, start) if self._stretch else -1
        while 0 < at and text[at - 1] == MARK:
            at = text.find(MARK, at + 1)
        return len(text) if at < 0 else at

    def stream(self, text: str) -> Iterator[array]:
        """Ids of a marked text, put out chunk by chunk; each chunk ends where all paths meet."""
        known, start = self._known, 0
        while start < len(text):
            stop = self._meets(text, start + CHUNK)
            stretches = self._stretches(text[start:stop])
            parts = list(map(known.get, stretches))
            if None in parts:
                for at, part in enumerate(parts):
                    if part is None:
                        own = stretches[at]
                        parts[at] = known.get(own) or self._committed(own)
            found = array("i", b"".join(parts))
            self.met += len(found)
            if stop == len(text):  # all but the last stretch end where paths meet
                ended = len(parts[-1]) // found.itemsize
                self.ended += ended
                self.met -= ended
            yield found
            start = stop

    def encode(self, text: str) -> array:
        found = array("i")
        if text:
            for part in self.stream(MARK + text.replace(" ", MARK)):
                found += part
        return found

    def decode(self, ids: Iterable[int]) -> str:
        joined = b"".join(map(self._bytes.__getitem__, ids))
        text = joined.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, path: str) -> DataFrame:
    """All columns and ``ids``, ``n_ids`` and ``decoded_sha256``, the digest of the text that
    decoding the ids gives."""
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_ids", "decoded_sha256")]
    read, at = with_text(docs, kept)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                flat, ends, digests = array("i"), array("i", [0]), []
                for text in part.column(at).to_pylist():
                    own = pieces.encode(text or "")
                    flat += own
                    ends.append(len(flat))
                    digests.append(hashlib.sha256(pieces.decode(own).encode()).hexdigest())
                ends = np.frombuffer(ends, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(flat, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], ids, pa.array(np.diff(ends).astype(np.int64)),
                     pa.array(digests, pa.string())],
                    [*kept, "ids", "n_ids", "decoded_sha256"],
                )

    schema = docs.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("n_ids", "long")
    return read.mapInArrow(giving_back(over), schema.add("decoded_sha256", "string"))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """All columns and ``text``, decoded from ``ids``; null ids give the empty text."""
    kept = [c for c in rows.columns if c.lower() != "text"]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in batches:
            texts = [pieces.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"]
            )

    return rows.select(*kept).mapInArrow(over, rows.select(*kept).schema.add("text", "string"))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    own = F.sha2(whole(F.col("text")).cast("binary"), 256)
    return coded.select(
        "doc_id", "n_ids", "ids", "decoded_sha256",
        (own == F.col("decoded_sha256")).alias("round_trip"),
    )


QUERIES = {"op5_sentence_pieces": op5_sentence_pieces}
ORACLES: dict[str, str] = {}
