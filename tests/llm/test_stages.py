"""Odd columns, workers without the package, families around the threshold, streams of ids."""

from __future__ import annotations

import os
import subprocess
import sys
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from test_operators import plain_sets

from riskweave.llm import (
    chat_format,
    exact_dedup,
    line_dedup,
    memory,
    mixing,
    near_dedup,
    quality,
    sentence_pieces,
    suffix_array,
    suffix_dedup,
)
from riskweave.llm.scratch import Scratch
from riskweave.llm.sieve import SIEVE_BITS, bitmap, marked, n_bits

CLASHING = [
    "_digest", "_n", "_hash", "_words", "_copy", "_rid", "_rhash", "rid", "_drops", "n_lines",
    "N_Dropped", "_kept_id", "_kept_all", "_times", "_id", "_whole_text", "whole_text", "SCORE",
    "IDS", "row", "id", "hash", "may", "_may", "kept_id", "times", "copy", "n", "stays", "digest",
    "passes", "edge", "of_id", "lines", "drops", "_labelled", "_source", "_kept_hash", "_own", "_at",
]
ROWS = [(i, f"text number {i % 7} of some words that are here for the test {i % 7}", "s") for i in range(20)]
ROWS += [(21, None, None), (None, "", "s"), (22, "alone in all the world, and long enough", "t")]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with a column of every name that a stage uses inside."""
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return plain.selectExpr("*", *(f"'{name}' as `{name}`" for name in CLASHING))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(20)],
                                 "doc_id long, quality int, toxic int")


def unchanged(result, docs, new=()):
    assert result.columns[:len(docs.columns)] == docs.columns
    for row in result.collect():
        assert [row[name] for name in CLASHING if name not in new] == [
            name for name in CLASHING if name not in new]


@pytest.mark.parametrize("stage", [exact_dedup.keep_one, near_dedup.keep_one, mixing.repeat])
def test_stages_leave_the_callers_columns_alone(spark, docs, stage):
    result = stage(docs, Scratch(spark, "t"))
    assert result.columns == docs.columns
    unchanged(result, docs)
    assert result.count() > 0


def test_other_operators_leave_the_callers_columns_alone(spark, docs, labels):
    import public_tokenizers

    found = line_dedup.dedup_lines(docs, Scratch(spark, "t"))
    unchanged(found, docs)
    assert found.columns[-3:] == ["n_lines_", "n_dropped_", "kept_text"]
    scored = quality.classify(docs, labels)
    assert "SCORE" not in scored.columns and scored.count() == len(ROWS)
    coded = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    assert "IDS" not in coded.columns and coded.count() == len(ROWS)


def test_exact_stage_keeps_one_of_each_group(spark, docs):
    kept = exact_dedup.keep_one(docs, Scratch(spark, "t")).collect()
    assert sorted((r.text or "") for r in kept) == sorted({t or "" for _, t, _ in ROWS})
    assert {r.doc_id for r in kept} == {*range(7), 21, 22}
    twice = docs.unionByName(docs)
    again = exact_dedup.keep_one(twice, Scratch(spark, "t")).collect()
    assert sorted(map(str, again)) == sorted(map(str, kept))


def test_mixing_does_not_shuffle_texts(spark, docs):
    plan = mixing.repeat(docs, Scratch(spark, "t"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("text", ["'one two three four five'", "concat('a b c d ', id)"])
def test_rows_alike_meet_their_targets(spark, text):
    """1,000 rows a source without ids and of equal size, equal texts or not."""
    rows = spark.range(3000, numPartitions=3).selectExpr(
        "cast(null as long) as doc_id", f"{text} as text", "concat('s', id % 3) as source")
    mixed = mixing.mix(rows, Scratch(spark, "t"))
    for row in mixed.groupBy("source", "target").agg({"*": "count"}).collect():
        own = mixed.where(mixed.source == row.source)
        taken = own.selectExpr("sum(size * times)").first()[0]
        assert abs(taken - row.target) <= 5
    again = mixing.mix(rows, Scratch(spark, "t"))
    columns = ["doc_id", "size", "source", "times"]
    assert sorted(map(str, again.select(columns).collect())) == sorted(
        map(str, mixed.select(columns).collect()))
    repeated = mixing.repeat(rows, Scratch(spark, "t")).count()
    assert repeated == mixed.selectExpr("sum(times)").first()[0]


def test_marks_tell_every_wanted_row(spark):
    rows = spark.range(5000).selectExpr("nullif(id, 7) as id")
    wanted = rows.where("id is null or id % 50 = 3").selectExpr("id as a")
    found = {r.id: r.may for r in marked(rows, ["id"], wanted, ["a"]).collect()}
    assert len(found) == 5000 and all(found[r.a] for r in wanted.collect())
    assert sum(found.values()) < wanted.count() + 20


def test_a_sieve_is_as_large_as_its_keys_need(spark):
    assert n_bits(0) == n_bits(100) == 1 << 20 and n_bits(10**9) == SIEVE_BITS == 1 << 26
    wanted = spark.range(30_000).selectExpr("id as a")
    bits = bitmap(wanted, ["a"], n_bits(30_000)).selectExpr("sum(octet_length(_bits))").first()[0]
    assert bits == 1 << 18  # of 8 MB before
    found = marked(spark.range(300_000), ["id"], wanted, ["a"])
    assert found.where("may and id < 30000").count() == 30_000
    assert found.where("may and id >= 30000").count() < 270_000 / 50


def test_near_dedup_sweeps_between_turns(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(near_dedup, "sweep", seen.append)
    rows = [(i, " ".join(f"w{j}" for j in range(40)) + f" x{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_dedup.keep_one(docs, Scratch(spark, "t")).count() == 1
    assert seen


def test_tasks_give_back_what_arrow_holds(monkeypatch):
    class Pool:
        released = 0

        def release_unused(self):
            Pool.released += 1

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batches = [pa.record_batch({"a": [i]}) for i in range(3)]
    assert list(memory.giving_back(lambda got: (b for b in got))(iter(batches))) == batches
    assert Pool.released == 1


def test_learning_takes_little_more_than_the_terms():
    rng = np.random.default_rng(5)
    terms = np.zeros((4096, quality.WIDTH), np.float32)
    terms[np.arange(4096)[:, None], rng.integers(0, quality.WIDTH, (4096, 150))] = rng.random((4096, 150))
    columns, counts = (pa.chunked_array([x]) for x in quality._packed(terms))
    assert columns.nbytes + counts.nbytes < terms.nbytes / 5
    assert (quality._unpacked(columns, counts) == terms).all()
    seen = (terms > 0).sum(axis=0)
    rarity = (np.log((1 + len(terms)) / (1 + seen)) + 1).astype(np.float32)
    scaled = quality._scaled(terms, rarity)
    axes = quality.latent_axes(scaled, quality.DIMENSIONS)
    tracemalloc.start()
    try:
        model = quality.Model.learn(terms, np.arange(4096) % 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < terms.nbytes  # 1.6 and more times before
    assert (model.rarity == rarity).all() and (model.axes == axes).all()
    assert (model.vectors == quality._unit(scaled @ axes)).all()


# ---------------------------------------------------------------- one long conversation

def test_a_conversation_is_formatted_in_linear_time(spark):
    def seconds(n):
        turns = spark.range(n).selectExpr(
            "1L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
            "repeat('some words ', 18) as text")
        start = time.perf_counter()
        row = chat_format.read_back(chat_format.conversations(turns)).first()
        assert (row.n_turns, row.loss_chars) == (n, n // 2 * 198)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) < 4 * seconds(8_000) + 3


# ---------------------------------------------------------------- suffix arrays

def test_runs_of_many_stretches():
    found = [np.array(o) for o in ([5], [5, 5, 7], [7], [1, 2, 2, 1])]
    assert suffix_dedup._runs(found) == [
        [(0, 1, 5)], [(0, 2, 5), (2, 1, 7)], [(0, 1, 7)], [(0, 1, 1), (1, 2, 2), (3, 1, 1)]]


def test_prefixes_and_names_by_words(monkeypatch):
    rng = np.random.default_rng(4)
    keys = np.concatenate([rng.integers(0, most, 500) for most in (2, 1 << 16, 1 << 17, 1 << 50)])
    assert (suffix_array._order(keys) == np.argsort(keys, kind="stable")).all()
    assert len(suffix_array._order(keys[:0])) == 0
    for scale in (1, 1 << 20):  # symbols that go four to a word, and symbols that do not
        t = np.append(np.tile(rng.integers(1, 4, 60), 5) * scale, 0)
        order = np.array(sorted(range(len(t)), key=lambda i: t[i:].tolist()))
        for most in (1, 4, 7, 50):
            found = suffix_array.permuted_prefixes(t, order, most)
            for a, b in zip(order, order[1:]):
                same = np.cumprod(t[a:a + most][:len(t) - b] == t[b:b + most][:len(t) - a]).sum()
                assert found[b] == same


def test_suffix_order_up_to_a_depth():
    rng = np.random.default_rng(3)
    for n, k, repeats in ((2, 2, 1), (40, 2, 1), (60, 3, 5), (300, 4, 6), (300, 200, 3)):
        for _ in range(20):
            t = np.append(np.tile(rng.integers(1, k + 1, n), repeats), 0)
            for depth in (1, 2, 5, 50):
                got = [tuple(t[i:i + depth]) for i in suffix_array.suffix_array(t, k + 1, depth)]
                assert got == sorted(got) and len(got) == len(t)


# ---------------------------------------------------------------- near copies

def test_a_family_around_the_threshold(spark, monkeypatch):
    """One template with shares of other words from none to a third: equal to brute force."""
    monkeypatch.setattr(near_dedup, "BAND_TURNS", 1)
    rng = np.random.default_rng(7)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(220):
        words = list(base)
        for at in rng.choice(100, rng.integers(0, 16), replace=False):
            words[at] = f"z{rng.integers(0, 40 if i % 2 else 10**6)}"
        rows.append((i, " ".join(words), "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    used = []
    buckets = near_dedup.NearGroups.prefix_buckets
    monkeypatch.setattr(near_dedup.NearGroups, "prefix_buckets",
                        lambda self, *a: used.append(1) or buckets(self, *a))
    near = near_dedup.Near(words=3, percent=85)
    got = near_dedup.near_groups(docs, Scratch(spark, "t"), near).collect()
    sets = plain_sets([t for _, t, _ in rows], 3)
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)))
                label[b] = a
    assert {r.doc_id: r.component_id for r in got} == {i: top(i) for i in range(len(rows))}
    assert used and 1 < len({top(i) for i in range(len(rows))}) < len(rows)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_near_sets_share_a_prefix_shingle(spark, words, percent):
    """The buckets by rarest shingles hold every near pair, in reach of the filter."""
    rng = np.random.default_rng(words)
    texts = [" ".join(f"v{rng.integers(0, 12)}" for _ in range(rng.integers(1, 25)))
             for _ in range(60)]
    texts += [t + " v1 extra" for t in texts[:30]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = near_dedup.NearGroups(docs, near_dedup.Near(words, percent), Scratch(spark, "t"))
    nodes = docs.selectExpr("doc_id as node", "cast(text as binary) as text")
    placed = groups.prefix_buckets(nodes.select("node"), nodes).collect()
    at: dict[int, dict[int, int]] = {}
    for row in placed:
        at.setdefault(row.node, {})[row.key] = row.pos
    sets = plain_sets(texts, words)
    near_pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both and 100 * both >= percent * union:
                near_pairs += 1
                n, m = len(sets[i]), len(sets[j])
                shared = at.get(i, {}).keys() & at.get(j, {}).keys()
                assert any((100 + percent) * min(n - at[i][k], m - at[j][k]) >= percent * (n + m)
                           for k in shared)
    assert near_pairs > 10


# ---------------------------------------------------------------- streams of ids

def test_ids_are_committed_where_paths_meet(spark, sf_dir):
    import public_tokenizers

    pieces = sentence_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    total = sum(len(pieces.encode(r.text or "")) for r in docs)
    assert pieces.met + pieces.ended == total
    assert pieces.met >= 0.99 * total


def test_a_long_text_is_put_out_in_chunks():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentence_pieces.Pieces(path)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    text = "streams of words  that go on\nand   on, ünïcödé 漢字 too " * 20_000
    marked_text = sentence_pieces.MARK + text.replace(" ", sentence_pieces.MARK)
    sizes, found = [], []
    for part in pieces.stream(marked_text):
        sizes.append(len(part))
        found += part
    assert len(sizes) > 10 and max(sizes) <= 2 * sentence_pieces.CHUNK
    assert found == library.encode(text)
    assert len(pieces._known) < 100
    long_word = "x" * 300_000
    assert list(pieces.encode(long_word)) == library.encode(long_word)


# ---------------------------------------------------------------- workers without the package

ALONE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r})
         .getOrCreate())
from riskweave.llm import registry
names = ("op1_quality", "op11_secret_scan", "op12_lexical_search", "op13_source_divergence")
for name in names:
    print(name, len(registry.queries()[name](spark, {sf_dir!r}).collect()))
"""


def test_workers_need_no_package(sf_dir, tmp_path):
    """The driver alone can import the package; workers start in another folder without it."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = ALONE.format(repo=repo, folder=str(tmp_path), sf_dir=sf_dir)
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=600,
                         capture_output=True, text=True, check=False)
    assert run.returncode == 0, run.stderr[-3000:]
    assert "op1_quality 200" in run.stdout
