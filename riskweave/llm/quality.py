"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes weighted counts of terms: its words, the shapes of its words, and its position on
a few scales of form (repetition, capitals, signs, length).  Counts go into ``WIDTH`` hashed
columns; each of the three groups is scaled to a weight of its own.  A truncated singular value
decomposition of a labelled sample turns them into ``DIMENSIONS`` latent ones.

The vectors and labels of the sample are broadcast; their number is bounded by the parameter
``sample`` (8192 rows by default, about 2 MB).  Its terms reach the driver without the columns
that are 0.  Every document, in blocks, is multiplied with all of the vectors, and its
``NEIGHBOURS`` nearest vote with weights that grow with the cosine.

Only rows outside the held-out fifth are used for learning.  Label, language, source and id are
not inputs of a score.

Defined cases: a null text is an empty one and is scored by its form like any other; a text
without any similar neighbour gets the mean label; without labels every score is 0.5; null labels
are not learnt from, repeated labels are averaged; a null doc_id counts as held out; repeated rows
come out repeated; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.memory import giving_back
from riskweave.llm.texts import whole, with_text

SAMPLE = 8192
WIDTH = 2048
DIMENSIONS = 64
NEIGHBOURS = 15
SHARPNESS = 8
THRESHOLD = 0.3
BLOCK = 512
VOTERS = 32
REMEMBERED = 150_000
LONGEST_REMEMBERED = 64
WORDS, SHAPES, SCALES = 0.5, 1.0, 1.5
#: Columns of each group of terms.
SCALE_BINS = 12
N_SHAPES = 256
_FORM = "".maketrans(
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "A" * 26 + "9" * 10
)


def _shape(word: str) -> str:
    """Letters as a or A, digits as 9, runs cut to two."""
    out: list[str] = []
    for c in word.translate(_FORM):
        c = c if c.isascii() else ("A" if c.isupper() else "a" if c.isalpha() else "x")
        if out[-2:] != [c, c]:
            out.append(c)
    return "".join(out)


def _scales(text: str, words: list[str], counts: Counter) -> list[float]:
    """Places between 0 and 1 on scales of form."""
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, text)) / size
    signs = size - sum(map(text.count, "etaoinshrdlucmfwypvbgkjqxz ETAOINSHRDLUCMFWYPVBGKJQXZ\n"))
    return [
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        min(1.0, 2 * upper),
        min(1.0, 2 * signs / size),
        len(set(lines)) / len(lines),
        min(1.0, np.log1p(len(words)) / 10),
        min(1.0, letters / n / 16),
        min(1.0, sum(map(text.count, "|*#%$&!")) / n),
        min(1.0, sum(map(text.count, ".,;:?")) / n * 3),
    ]


N_SCALES = 10
HEAD = N_SCALES * SCALE_BINS
N_WORDS = WIDTH - N_SHAPES - HEAD
#: First column, end and weight of each group.
GROUPS = (
    (0, HEAD, SCALES), (HEAD, HEAD + N_SHAPES, SHAPES), (HEAD + N_SHAPES, WIDTH, WORDS),
)


class Terms:
    """Turns texts into rows of weighted counts."""

    def __init__(self) -> None:
        # One number a word takes less room than two in a pair.
        self._columns: dict[str, int] = {}

    def _column(self, word: str) -> int:
        """Columns of a word's shape and of the word, as one number: shape * WIDTH + word."""
        known = self._columns.get(word)
        if known is None:
            lower = word.lower().strip(".,;:!?*#%$&|\"'()")
            shape = HEAD + zlib.crc32(_shape(word).encode()) % N_SHAPES
            known = shape * WIDTH + WIDTH - N_WORDS + zlib.crc32(lower.encode()) % N_WORDS
            if len(self._columns) >= REMEMBERED:
                self._columns.clear()
            if len(word) <= LONGEST_REMEMBERED:
                self._columns[word] = known
        return known

    def rows(self, texts: list[str]) -> np.ndarray:
        found = np.zeros((len(texts), WIDTH), np.float32)
        for row, text in zip(found, texts, strict=True):
            words = text.split()
            counts = Counter(words)
            if counts:
                columns = np.fromiter(map(self._column, counts), np.int64, len(counts))
                n = np.fromiter(counts.values(), np.float32, len(counts))
                row += np.bincount(columns // WIDTH, n, WIDTH).astype(np.float32)
                row += np.bincount(columns % WIDTH, n, WIDTH).astype(np.float32)
            for scale, place in enumerate(_scales(text, words, counts)):
                # Shared between the two nearest bins, so near places give near rows.
                at, part = divmod(place * (SCALE_BINS - 1), 1)
                base = scale * SCALE_BINS + int(at)
                row[base] += 1 - part
                if part:
                    row[base + 1] += part
        found[:, HEAD:] = np.log1p(found[:, HEAD:])
        return found


def _scaled(rows: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rows weighted by the rarity of terms, each group scaled to its weight."""
    rows = rows * rarity
    for start, stop, weight in GROUPS:
        part = rows[:, start:stop]
        norm = np.linalg.norm(part, axis=1, keepdims=True)
        part *= weight / np.where(norm > 0, norm, 1)
    return rows


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def latent_axes(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    wide = min(dimensions + 16, *rows.shape)
    basis = np.random.default_rng(0).standard_normal((rows.shape[1], wide)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turned = np.linalg.svd(rows @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turned.T)[:, :dimensions], np.float32)


class Model(NamedTuple):
    """Term weights, latent axes and the labelled vectors.

    Tasks get the plain tuple of arrays and make the model of it: what is broadcast must not
    name a module that workers would have to import.
    """

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    mean: float

    @classmethod
    def learn(cls, terms: np.ndarray, labels: np.ndarray) -> Model:
        """The model of rows of terms, which are scaled in place, block by block."""
        blocks = [terms[i:i + BLOCK] for i in range(0, len(terms), BLOCK)]
        seen = sum((block > 0).sum(axis=0) for block in blocks)
        rarity = (np.log((1 + len(terms)) / (1 + seen)) + 1).astype(np.float32)
        for block in blocks:
            block[:] = _scaled(block, rarity)
        axes = latent_axes(terms, DIMENSIONS)
        return cls(
            rarity, axes, _unit(terms @ axes), labels.astype(np.float32), float(labels.mean())
        )

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        own = _unit(_scaled(terms, self.rarity) @ self.axes)
        cosines = own @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.empty((len(cosines), k), np.int64)
        for start in range(0, len(cosines), VOTERS):  # the order of all vectors, of few rows
            part = cosines[start:start + VOTERS]
            near[start:start + VOTERS] = np.argpartition(-part, k - 1, axis=1)[:, :k]
        weights = np.clip(np.take_along_axis(cosines, near, 1), 0, 1).astype(np.float64)
        weights = weights ** SHARPNESS
        total = weights.sum(axis=1)
        voted = (weights * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 0, voted, self.mean), 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _packed(rows: np.ndarray) -> list[pa.Array]:
    """Columns and counts of each row's terms; most of a row's ``WIDTH`` columns are 0."""
    filled = [np.flatnonzero(row) for row in rows]
    return [
        pa.array([at.astype(np.uint16).tobytes() for at in filled], pa.binary()),
        pa.array([row[at].tobytes() for row, at in zip(rows, filled, strict=True)], pa.binary()),
    ]


def _unpacked(columns: pa.ChunkedArray, counts: pa.ChunkedArray) -> np.ndarray:
    """The rows of terms again, all columns of them."""
    rows = np.zeros((len(columns), WIDTH), np.float32)
    for row, at, n in zip(rows, columns, counts, strict=True):
        row[np.frombuffer(at.as_py(), np.uint16)] = np.frombuffer(n.as_py(), np.float32)
    return rows


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from at most ``sample`` labelled documents, chosen by a hash of the id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.avg("quality").alias("_quality"))
        .orderBy(F.xxhash64("_labelled"), "_labelled").limit(sample)
    )
    # At most ``sample`` rows of two numbers; repeated documents add no more than their rows.
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled")).groupBy("_labelled").agg(
        F.first("_quality").alias("label"), F.max(whole(F.col("text"))).alias("text")
    ).select("_labelled", "label", "text")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = terms.rows(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_labelled"), batch.column("label"), *_packed(found)],
                ["id", "label", "columns", "counts"],
            )

    schema = "id long, label double, columns binary, counts binary"
    got = rows.mapInArrow(over, schema).toArrow().sort_by("id")
    if not got.num_rows:
        return None
    terms = _unpacked(got.column("columns"), got.column("counts"))
    return Model.learn(terms, got.column("label").to_numpy())


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns and ``score`` for every document."""
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kept = [c for c in docs.columns if c.lower() != "score"]
    read, at = with_text(docs, kept)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, known = Terms(), Model(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                rows = terms.rows([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(kept)], pa.array(known.scores(rows), pa.float64())],
                    [*kept, "score"],
                )

    return read.mapInArrow(giving_back(over), docs.select(*kept).schema.add("score", "double"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """All columns of the documents with ``held_out``, ``score`` and ``predicted``."""
    return score(docs, fit(docs, labels, sample)).withColumns({
        "held_out": held_out(F.col("doc_id")),
        "predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0),
    })


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op1_quality": op1_quality}
ORACLES: dict[str, str] = {}
