"""MinHash near-deduplication with fast similarity sketches.

Sketch.  A text's set of word shingles is sketched in rounds: in each round every shingle is
hashed into one of the sketch's bins, with a value that is larger in later rounds, and a bin keeps
its least value.  Rounds go on until all bins are full; after as many rounds as there are bins,
every shingle goes into each bin in turn, so every bin fills.  Two sets agree in a bin with
probability equal to their Jaccard similarity, with concentration as if the bins were independent,
at a cost of about one pass for sets larger than the sketch.

Candidates.  Texts with equal sets are one class first.  The classes' sketches are cut into
``BANDS`` bands; classes that agree in a whole band share a bucket.  Rows per band are the most
for which a pair at the threshold is missed with probability at most ``MISS``.

Links.  Pairs within a bucket are not made.  First every member meets the bucket's smallest; the
pairs are confirmed on the full sets and linked members get one label.  Only buckets with several
labels go on: in each round more of their members (4, 32, 256, ..., chosen by hash, until all have
been) meet the members with other labels.  Pairs whose sketches agree in fewer bins than a pair at
the threshold does, but for a probability of ``MISS``, go no further.  So in the end every two
members of a bucket are linked through confirmed pairs or have been compared, whatever the
bucket's size, while a bucket of copies costs one comparison per member.

Prefixes.  Buckets still open after ``BAND_TURNS`` rounds hold texts that are alike but not near,
such as a template with many fillings, whose members would meet one by one.  Their classes are
dealt anew: shingles are ordered by the number of these classes that hold them, and a class goes
into the bucket of each of its rarest shingles, as many that two near sets must share one of
theirs (all but the threshold's part of the set, and one more).  What tells two fillings apart is
rare, so they share no bucket, and where a shared shingle stands in both sets bounds how much they
can share at all.  No near pair is lost by this.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; a text
with fewer words than a shingle has its words as its one shingle; rows with equal sets are linked;
null ids come last and a group of null ids has a null component; repeated rows come out repeated;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.components import components
from riskweave.llm.memory import giving_back
from riskweave.llm.scratch import Scratch, sweep
from riskweave.llm.sieve import marked, rows_that_stay
from riskweave.llm.texts import whole

BANDS = 32
MISS = 1e-5
BLOCK_BYTES = 1 << 19
FIRST_PIVOTS, GROWTH = 4, 8
BAND_TURNS = 2

U = np.uint64
_FULL = U(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Near:
    """What counts as near: shingles of ``words`` words, ``percent`` of the union shared."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Sketch bins in a band."""
        share, rows = self.percent / 100, 1
        while (1 - share ** (rows + 1)) ** BANDS <= MISS:
            rows += 1
        return rows

    @property
    def least_bins(self) -> int:
        """Bins in which a pair at the threshold agrees, but for a probability of ``MISS``."""
        bins, share = BANDS * self.rows, self.percent / 100
        below, least = (1 - share) ** bins, 0
        while below <= MISS:
            least += 1
            below += math.comb(bins, least) * share**least * (1 - share) ** (bins - least)
        return least


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin among them."""
    data = _LOWER[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
    sizes = np.array([len(t) + 1 for t in texts])
    begins = np.concatenate([[1], 1 + np.cumsum(sizes)])
    bounds = np.searchsorted(starts, begins)
    if not len(starts):
        return np.empty(0, U), bounds
    lengths = stops - starts
    letters = data[~space].astype(U) + U(1)
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(heads, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), U(0x9E3779B97F4A7C15)))
    hashes = np.add.reduceat(letters * powers[place], heads)
    return mix(hashes + mix(lengths.astype(U))), bounds


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    hashes, bounds = _words(texts)
    found = hashes.copy()
    joined = max(0, len(hashes) - words + 1)
    for i in range(1, words):
        found[:joined] = mix(found[:joined] * U(0xD6E8FEB86659FD93) + hashes[i:i + joined])
    sets = []
    for start, stop in zip(bounds, bounds[1:], strict=False):
        n = stop - start
        if n >= words:
            sets.append(np.unique(found[start:stop - words + 1]))
        elif n:
            short = mix(np.array([n], U))
            for h in hashes[start:stop]:
                short = mix(short * U(0xD6E8FEB86659FD93) + h)
            sets.append(short)
        else:
            sets.append(hashes[:0])
    return sets


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of bins for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    found = np.full((len(sets), bins), _FULL, U)
    flat, items = found.reshape(-1), np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    live = np.arange(len(sets))  # sets with open bins
    for turn in range(2 * bins):
        drawn = mix(items + mix(np.array([turn + 1], U)))
        if turn < bins:
            bin_ = ((drawn >> U(32)) * U(bins) >> U(32)).astype(np.int64)
        else:
            bin_ = turn - bins
        value = (U(turn) << U(32)) | (drawn & U(0xFFFFFFFF))
        np.minimum.at(flat, row * bins + bin_, value)
        open_ = (found[live] == _FULL).any(axis=1)
        if not open_.all():
            live = live[open_]
            if not len(live):
                break
            going = np.isin(row, live)
            items, row = items[going], row[going]
    return found


def band_keys(found: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each band of each sketch."""
    parts = found.reshape(len(found), bands, -1)
    keys = mix(np.broadcast_to(np.arange(bands, dtype=U), parts.shape[:2]) + U(1))
    for i in range(parts.shape[2]):
        keys = mix(keys * U(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys


def _blocks(texts: list[bytes]) -> Iterator[slice]:
    """Slices of about ``BLOCK_BYTES`` of text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BLOCK_BYTES:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


_SKETCHED = """doc_id long, text_hash long, row long, n long, set_a long, set_b long,
    bands array<long>, bins array<tinyint>"""


def _sketch_rows(near: Near):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, n_bins = TaskContext.get().partitionId() << 33, BANDS * near.rows
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for part in _blocks(texts):
                sets = shingle_sets(texts[part], near.words)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                digest = np.zeros((2, len(sets)), U)
                keys, found = np.empty((0, BANDS), U), np.empty((0, n_bins), U)
                if len(full):
                    own = [sets[i] for i in full]
                    heads = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    every = np.concatenate(own)
                    for i in range(2):
                        digest[i, full] = np.add.reduceat(mix(every + U(i + 1)), heads)
                    found = sketches(own, n_bins)
                    keys = band_keys(found, BANDS)
                ends = np.concatenate([[0], np.cumsum(sizes > 0)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(part.start, len(sets)) for c in batch.columns[:2]),
                        pa.array(np.arange(row, row + len(sets))),
                        pa.array(sizes.astype(np.int64)),
                        *(pa.array(d.view(np.int64)) for d in digest),
                        pa.ListArray.from_arrays(
                            pa.array(ends * BANDS, pa.int32()),
                            pa.array(keys.reshape(-1).view(np.int64)),
                        ),
                        # A byte of each bin tells unlike bins apart well enough.
                        pa.ListArray.from_arrays(
                            pa.array(ends * n_bins, pa.int32()),
                            pa.array(found.reshape(-1).astype(np.uint8).view(np.int8)),
                        ),
                    ],
                    ["doc_id", "text_hash", "row", "n", "set_a", "set_b", "bands", "bins"],
                )
                row += len(sets)

    return over


def sketch_table(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, hash of the text, row number, set size, set digest and band keys of every row."""
    text = whole(F.col("text"))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.cast("binary").alias("text"),
    )
    return read.mapInArrow(giving_back(_sketch_rows(near)), _SKETCHED)


def _confirm(near: Near):
    """Pairs (a, b, text_a, text_b) that are near, checked on their full sets."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts_a, texts_b = batch.column(2), batch.column(3).to_pylist()
            kept = []
            for part in _blocks(texts_b):
                sets = shingle_sets(texts_b[part], near.words)
                for i, right in zip(range(part.start, part.stop), sets, strict=True):
                    if last[0] != a[i]:  # rows come sorted by a
                        last = a[i], shingle_sets([texts_a[i].as_py()], near.words)[0]
                    left = last[1]
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    kept.append(100 * both >= near.percent * (len(left) + len(right) - both))
            keep = pa.array(kept, pa.bool_())
            yield batch.select([0, 1]).filter(keep)

    return over


def _shingle_rows(near: Near):
    """(node, n, shingle) of every member of the texts' sets."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, texts = batch.column("node").to_numpy(), batch.column("text").to_pylist()
            for part in _blocks(texts):
                sets = shingle_sets(texts[part], near.words)
                sizes = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(nodes[part], sizes)), pa.array(np.repeat(sizes, sizes)),
                     pa.array(np.concatenate(sets).view(np.int64))],
                    ["node", "n", "shingle"],
                )

    return over


def sieve(
    rows: DataFrame, key: list[str], wanted: DataFrame, wanted_key: list[str],
    n_wanted: int | None = None,
) -> DataFrame:
    """The rows whose key may be wanted, found before they are shuffled."""
    return marked(rows, key, wanted, wanted_key, "_may", n_wanted).where("_may").drop("_may")


class NearGroups:
    """The steps from documents to groups; each step's table is written to the scratch folder."""

    def __init__(self, docs: DataFrame, near: Near, scratch: Scratch):
        self.docs, self.near, self.scratch = docs, near, scratch
        keep = scratch.keep
        self.rows = keep(sketch_table(docs, near), "sketches")
        # Classes of equal sets; a class is named by its first row in order of doc_id.
        first = F.min(F.struct(
            F.col("doc_id").isNull().alias("last"), "doc_id", "row", "text_hash",
        ))
        by_set = self.rows.where("n > 0").groupBy("set_a", "set_b", "n").agg(first.alias("first"))
        self.classes = keep(
            by_set.select("set_a", "set_b", "n", "first.doc_id", "first.text_hash",
                          F.col("first.row").alias("node")),
            "classes",
        )
        self.members = keep(
            self.rows.select("doc_id", "text_hash", "row", "n", "set_a", "set_b").join(
                self.classes.select("set_a", "set_b", "node"), ["set_a", "set_b"], "left"
            ).drop("set_a", "set_b"),
            "members",
        )

    def buckets(self) -> DataFrame:
        """(key, node, n, size, least, least_n) of the classes in buckets with two or more."""
        nodes = self.classes.select("node", "n")
        own = self.rows.select(F.col("row").alias("node"), "bands").join(nodes, "node")
        keys = self.scratch.keep(own.select(F.explode("bands").alias("key"), "node", "n"), "bands")
        shared = keys.groupBy("key").agg(
            F.min(F.struct("node", "n")).alias("least"), F.max("node").alias("most"),
            F.count("*").alias("size"),
        ).where("least.node < most").selectExpr(
            "key", "least.node as least", "least.n as least_n", "size"
        )
        return self.scratch.keep(
            keys.join(self.scratch.keep(shared, "shared"), "key"), "buckets"
        )

    def texts(self, buckets: DataFrame) -> DataFrame:
        """(node, text) of the classes in buckets."""
        nodes = buckets.select("node").distinct()
        wanted = self.classes.join(nodes, "node").select(
            "node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
        )
        wanted = self.scratch.keep(wanted, "wanted")
        text = whole(F.col("text"))
        docs = self.docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"),
            F.xxhash64(text).alias("text_hash"),
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        docs = sieve(docs, ["doc_id", "text_hash"], wanted, ["_id", "_hash"])
        return self.scratch.keep(docs.join(wanted, same).select("node", "text"), "texts")

    def prefix_buckets(self, nodes: DataFrame, texts: DataFrame) -> DataFrame:
        """(key, node, n, size, pos) by the rarest shingles of the nodes.

        ``pos`` is the shingle's place in the node's set, from 0, the rarest first.  Shingles of
        one node alone come first and need no bucket.
        """
        keep, percent = self.scratch.keep, self.near.percent
        own = sieve(texts, ["node"], nodes, ["node"]).join(nodes, "node", "left_semi")
        shingles = giving_back(_shingle_rows(self.near))
        cells = own.mapInArrow(shingles, "node long, n long, shingle long")
        cells = keep(cells.distinct(), "shingles")
        held = cells.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
        common = cells.join(keep(held, "shingle-counts"), "shingle")
        ordered = common.groupBy("node", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared")
        )
        alone = "n - size(shared)"
        length = f"n - ({percent} * n + 99) div 100 + 1"
        prefix = ordered.selectExpr(
            "node", "n", f"{alone} as alone",
            f"slice(shared, 1, cast(greatest(0, {length} - ({alone})) as int)) as prefix",
        )
        placed = prefix.select(
            "node", "n", "alone", F.posexplode("prefix").alias("at", "cell")
        ).selectExpr("cell.shingle as key", "node", "n", "alone + at as pos")
        placed = keep(placed, "prefixes")
        sizes = placed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        return keep(placed.join(keep(sizes, "prefix-sizes"), "key"), "prefix-buckets")

    def _confirmed(self, pairs: DataFrame, texts: DataFrame, turn: int) -> DataFrame:
        """The pairs (a, b) that are near."""
        pivots, n = pairs.select("a").distinct(), pairs.count()
        left = sieve(texts, ["node"], pairs, ["a"], n)
        left = left.join(pivots, left.node == pivots.a, "left_semi")
        left = left.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = sieve(texts, ["node"], pairs, ["b"], n)
        right = right.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        found = both.mapInArrow(giving_back(_confirm(self.near)), "a long, b long")
        # A class whose row is repeated meets a partner several times.
        return self.scratch.keep(found.distinct(), f"links-{turn}")

    def _joined(self, labels: DataFrame, links: DataFrame, turn: int) -> DataFrame:
        """The labels after some more links; only linked labels are worked on again."""
        if not links.limit(1).count():
            return labels
        for side in ("a", "b"):
            own = labels.select(F.col("node").alias(side), F.col("label").alias("own"))
            links = links.join(own, side, "left").withColumn(side, F.coalesce("own", side))
            links = links.drop("own")
        links = self.scratch.keep(links.distinct(), f"label-links-{turn}")
        merged = components(links, self.scratch, f"components-{turn}")
        upper = merged.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        moved = labels.join(upper, "label", "left").select(
            "node", F.coalesce("upper", "label").alias("label")
        )
        fresh = merged.join(labels.select("node"), "node", "left_anti")
        return self.scratch.keep(moved.unionByName(fresh.select("node", "label")), f"all-{turn}")

    def labels(self) -> DataFrame | None:
        """(node, label) of the classes with a link."""
        scratch, buckets = self.scratch, self.buckets()
        texts = self.texts(buckets)
        p = self.near.percent
        # What two sets can share from the places of a shared member on.
        reach = f"{100 + p} * least(n - pos, pivot_n - pivot_pos) >= {p} * (n + pivot_n)"
        first = buckets.where("node <> least").where(
            f"100 * least(n, least_n) >= {p} * greatest(n, least_n)"
        )
        pairs = first.selectExpr("least as a", "node as b").distinct()
        seen = scratch.keep(pairs, "pairs-1")
        links = self._confirmed(seen, texts, 1)
        labels = components(links, scratch, "components-1")
        turn, done, pivots = 1, 0, FIRST_PIVOTS
        active = buckets.selectExpr("key", "node", "n", "size", "0L as pos")
        while True:
            turn += 1
            sweep(scratch.spark)  # the driver still holds what the turn before broadcast
            if turn == BAND_TURNS + 2:
                nodes = scratch.keep(active.select("node").distinct(), "alike")
                active, done, pivots = self.prefix_buckets(nodes, texts), 0, FIRST_PIVOTS
            named = active.join(labels, "node", "left").select(
                "key", "node", "n", "size", "pos", F.coalesce("label", "node").alias("label"),
            )
            named = scratch.keep(named, f"named-{turn}")
            mixed = named.groupBy("key").agg(
                F.min("label").alias("l"), F.max("label").alias("m"), F.max("size").alias("s")
            ).where(f"l < m and s > {done}").select("key")
            mixed = scratch.keep(mixed, f"open-{turn}")
            named = sieve(named, ["key"], mixed, ["key"])
            active = scratch.keep(named.join(mixed, "key"), f"active-{turn}")
            n_active = active.count()
            if not n_active:
                return labels
            # A member's place in its bucket, from 0 up to the bucket's size, by hash.
            bins = self.rows.select(F.col("row").alias("node"), "bins")
            bins = sieve(bins, ["node"], active, ["node"], n_active)
            active = scratch.keep(active.join(bins, "node"), f"sketched-{turn}")
            place = "pmod(xxhash64(key, node), 1048576) / 1048576 * size"
            pivot = active.where(f"{place} >= {done} and {place} < {pivots}").selectExpr(
                "key", "node as pivot", "n as pivot_n", "pos as pivot_pos",
                "label as pivot_label", "bins as pivot_bins",
            )
            # Sketches too unlike for the threshold need no look at the full sets.
            agree = "size(filter(zip_with(bins, pivot_bins, (x, y) -> x = y), same -> same))"
            met = active.join(scratch.keep(pivot, f"pivots-{turn}"), "key").where(
                f"label <> pivot_label and {reach} and {agree} >= {self.near.least_bins}"
            )
            # The smaller node is a, as in the pairs before.
            pairs = met.selectExpr("least(node, pivot) as a", "greatest(node, pivot) as b")
            fresh = pairs.distinct().join(seen, ["a", "b"], "left_anti")
            fresh = scratch.keep(fresh, f"pairs-{turn}")
            labels = self._joined(labels, self._confirmed(fresh, texts, turn), turn)
            seen = seen.unionByName(fresh)
            active = active.select("key", "node", "n", "size", "pos")
            done, pivots = pivots, pivots * GROWTH

    def decide(self) -> DataFrame:
        """doc_id, text_hash, row, n_shingles, component_id and keep_row of every row."""
        scratch = self.scratch
        named = self.classes.join(self.labels(), "node", "left").select(
            "node", "doc_id", F.coalesce("label", "node").alias("label")
        )
        named = scratch.keep(named, "named")
        least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node"))
        heads = scratch.keep(
            named.groupBy("label").agg(least.alias("head")).select("label", "head.*"), "heads"
        )
        by_node = scratch.keep(
            named.select("node", "label").join(
                heads.selectExpr("label", "doc_id as component_id", "node as keep_row"), "label"
            ).drop("label"),
            "by-node",
        )
        alone = F.col("n") == 0
        return self.members.join(by_node, "node", "left").select(
            "doc_id", "text_hash", "row", F.col("n").alias("n_shingles"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.when(alone, F.col("row")).otherwise(F.col("keep_row")).alias("keep_row"),
        )


def near_groups(docs: DataFrame, scratch: Scratch, near: Near = Near()) -> DataFrame:
    return NearGroups(docs, near, scratch).decide()


def keep_one(docs: DataFrame, scratch: Scratch, near: Near = Near()) -> DataFrame:
    """One document row of each group, with all its columns, whatever their names.

    Only rows that may belong to a group of several are shuffled.
    """
    decided = near_groups(docs, scratch, near).select(
        F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
    )
    # Rows alike in id and text have equal sets, so at most one of them stays if any goes.
    by_text = decided.groupBy("of_id", "of_hash").agg(
        F.bool_or("kept").alias("stays"), F.bool_and("kept").alias("all_stay")
    )
    listed = scratch.keep(by_text.where("not all_stay").drop("all_stay"), "some-go")
    return rows_that_stay(docs, listed)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_groups(docs, Scratch(spark, "near-dedup"), Near(words=3, percent=85))
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


QUERIES = {"op9_near_dedup": op9_near_dedup}
ORACLES: dict[str, str] = {}
