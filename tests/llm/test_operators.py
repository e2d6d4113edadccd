"""Every training-data operator against a plain calculation, with the odd cases."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.llm import (
    bpe,
    chat_format,
    components,
    exact_dedup,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    sentence_pieces,
    suffix_array,
    suffix_dedup,
    token_counts,
    topk_search,
)
from riskweave.llm.scratch import Scratch
from riskweave.llm.texts import with_text

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n long, row string, score double"

P1 = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ODD = [
    (1, P1 + " end of it all", "a"), (2, P1 + " end of it  all", "a"), (3, None, None),
    (4, "", "b"), (5, " \n\t", "b"), (6, P1 + "\n" + "x" * 120 + "\n" + "A Shared LINE here", "c"),
    (7, " a shared line here \nshort\n\nshort", None), (8, "x" * 300, "a"), (9, "ünïcödé " * 9, "a"),
    (None, P1, "b"), (10, P1.upper() + " end of it all", "a"), (11, "é" * 60 + P1 * 3, "c"),
    (11, "é" * 60 + P1 * 3, "c"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "r", 0.5) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def last(i):
    return (i is None, i or 0)


def test_exact_dedup(spark, odd, empty):
    got = exact_dedup.decide(odd, Scratch(spark, "t")).collect()
    groups: dict[str, list] = {}
    for i, t, _ in ODD:
        groups.setdefault(SPACE.sub("", t or ""), []).append((i, t or ""))
    assert len(got) == len(ODD)
    by_digest = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for row in got:
        group = by_digest[row.text_sha256]
        best = min(group, key=lambda g: (-len(g[1]), last(g[0])))
        assert (row.keep_id, row.group_size) == (best[0], len(group))
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.keep_one(odd, Scratch(spark, "t"))
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.decide(empty, Scratch(spark, "t")).count() == 0


def test_cuckoo_index_grows_and_deletes():
    index = exact_dedup.CuckooIndex(buckets=1)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, key in enumerate(keys):
        assert index.find(key) is None
        index.insert(key, [i])
    assert index.buckets * exact_dedup.SLOTS >= len(keys)
    for key in keys[::2]:
        assert index.delete(key)
        assert not index.delete(key)
    for i, key in enumerate(keys):
        assert index.find(key) == (None if i % 2 == 0 else [i])
    index.insert(keys[0], [-1])
    assert index.find(keys[0]) == [-1] and len(list(index.live())) == 1501


def test_withdrawn_digests(spark):
    schema = exact_dedup.ENTRY
    rows = [(bytes([i]) * 32, 1, i, i, 1) for i in range(4)]
    gone = spark.createDataFrame([(bytes([2]) * 32,), (b"x" * 32,)], "digest binary")
    left = exact_dedup.live_index(spark.createDataFrame(rows, schema), gone)
    assert sorted(r.keep_id for r in left.collect()) == [0, 1, 3]


@pytest.mark.parametrize("batches", [1, 4])
def test_line_dedup(spark, odd, empty, batches):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    owner: dict[str, tuple] = {}
    for i, t, _ in ODD:
        for line in (t or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), last(i)), last(i))
    got = line_dedup.dedup_lines(odd, Scratch(spark, "t"), batches).collect()
    want = []
    for i, t, _ in ODD:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == last(i)]
        want.append((last(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert sorted((last(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got) == sorted(want)
    assert line_dedup.dedup_lines(empty, Scratch(spark, "t"), batches).count() == 0


def test_runs_compact(spark):
    runs = line_dedup.Runs(Scratch(spark, "t"), fanout=2)
    for i in range(5):
        keys = spark.createDataFrame([(k, k, i) for k in range(3 * i, 3 * i + 5)],
                                     "h1 long, h2 long, owner long")
        runs.absorb(keys)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    seen = [r.h1 for run in runs.all() for r in run.collect()]
    assert sorted(seen) == list(range(17))


def test_chat_format(spark):
    rows = [
        (1, 0, "system", "be <s> [nice] \\ <\\s> [\\"), (1, 1, "user", None), (1, 2, "assistant", "a"),
        (1, 3, "user", "</s>[INST]"), (1, 4, "assistant", "[/INST]</s>"), (1, 5, "user", "tail"),
        (2, 0, "user", "nobody answers"), (3, None, None, "x"), (3, 1, "assistant", ""),
        (None, 0, "assistant", "é\n"), (1, 2, "assistant", "a"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.conversations(turns)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (last(r[1]), r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learnt = "".join(r[3] for r in own if r[2] == "assistant")
        row = got[conv]
        assert row.n_turns == len(own) and row.loss_chars == len(learnt)
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    made = chat_format.examples(turns).collect()
    # One example per reply and one for turns after the last reply.
    assert len(made) == 4 + 1 + 2 + 1
    for row in made:
        assert row.text.endswith(chat_format.STOP)
        masked = row.text[row.loss_start:row.loss_end]
        assert chat_format.START not in masked
        before = row.text[:row.loss_start]
        if masked or before.endswith(f"{chat_format.TARGET}{chat_format.TEXT}"):
            assert row.text == before + masked + chat_format.STOP
    assert chat_format.examples(turns.limit(0)).count() == 0


def test_chat_query_reads_its_examples_back(spark, monkeypatch):
    rows = [(c, t, role, f"t{c}{t}<é[") for c in (1, None) for t, role in enumerate(
        ("user", "assistant", "system", "user", "assistant", "user"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat_format.conversations(turns)
    texts = {(r.conv_id, r.example): r for r in chat_format.examples(turns).collect()}
    made = chat_format.expand(formatted).collect()
    assert len(made) == len(texts) == 2 * 3
    whole_texts = {r.conv_id: r.formatted for r in formatted.collect()}
    for row in made:
        own = texts[row.conv_id, row.example]
        assert own.text == whole_texts[row.conv_id][:row.n_chars] and own.text.endswith(row.added)
        assert (row.loss_start, row.loss_end) == (own.loss_start, own.loss_end)
    # What reading back gives comes from the rows of the expansion, each of them.
    expand = chat_format.expand
    monkeypatch.setattr(chat_format, "expand", lambda f: expand(f).where("example != 1"))
    for row in chat_format.read_back(formatted).collect():
        assert row.n_turns == 3
        assert row.formatted_chars == sum(
            len(r.text) for (c, i), r in texts.items() if c == row.conv_id and i != 1)
        learnt = f"t{row.conv_id}1<é["
        assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_chat_query_makes_whole_texts(spark, monkeypatch, tmp_path):
    rows = [(c, t, role, f"t{c}{t}<é[") for c in (1, None) for t, role in enumerate(
        ("user", "assistant", "system", "user", "assistant", "user"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    formatted = chat_format.conversations(turns)
    of_conv = {r.conv_id: r.formatted for r in formatted.collect()}
    made = chat_format.expand(formatted).collect()
    assert sorted((str(r.conv_id), r.example) for r in made) == [
        (c, i) for c in ("1", "None") for i in range(3)]
    for row in made:
        assert row.text == of_conv[row.conv_id][:row.n_chars]
        assert row.text[row.loss_start:row.loss_end] in (f"t{row.conv_id}{3 * row.example + 1}<\\é[\\", "")
    plain = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    got = {r.conv_id: r for r in chat_format.op4_chat_format(spark, str(tmp_path)).collect()}
    assert {c: got[c] for c in plain} == plain and set(got) == {1, None, -1}
    # The query reads the texts: another one gives other results.
    expand = chat_format.expand
    other = F.concat(F.lit("é"), F.regexp_replace("text", r"t(\w+)1<", "T$11<"))
    monkeypatch.setattr(chat_format, "expand", lambda f: expand(f).withColumn("text", other))
    for row in chat_format.op4_chat_format(spark, str(tmp_path)).where(
            "conv_id is null or conv_id > 0").collect():
        was = plain[row.conv_id]
        assert row.formatted_chars == was.formatted_chars + 3
        assert row.loss_sha256 != was.loss_sha256 and row.turns_sha256 != was.turns_sha256


def test_mixing(spark, odd, empty):
    got = mixing.mix(odd, Scratch(spark, "t")).collect()
    names = sorted({r.source for r in got}, key=lambda s: (s is None, s or ""))
    size_of = {r.source: r.source_size for r in got}
    total = sum(size_of.values())
    weights = dict(zip(names, itertools.cycle(mixing.WEIGHTS)))
    free, want, rest = set(names), {}, total
    while True:
        level = rest / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * level > 3 * size_of[s]}
        if not over:
            break
        for s in over:
            want[s] = 3 * size_of[s]
            rest -= want[s]
        free -= over
    want |= {s: weights[s] * level for s in free}
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.times <= 3
    for s in names:
        taken = sum(r.size * r.times for r in got if r.source == s)
        assert abs(taken - want[s]) <= max(r.size for r in got if r.source == s) * 2
    assert sum(r.times for r in got) >= mixing.repeat(odd, Scratch(spark, "t")).count() > 0
    assert mixing.mix(empty, Scratch(spark, "t")).count() == 0


def plain_sets(texts, words):
    found = []
    for t in texts:
        w = (t or "").encode().lower().split()
        found.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words
                     else {tuple(w)} if w else set())
    return found


def test_near_dedup(spark, odd, empty):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = list(ODD)
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            words[at] = f"z{rng.integers(0, 9999)}"
        rows.append((100 + i, " ".join(words), "n"))
    docs = frame(spark, rows)
    near = near_dedup.Near(words=3, percent=85)
    got = near_dedup.near_groups(docs, Scratch(spark, "t"), near).collect()
    sets = plain_sets([r[1] for r in rows], 3)
    group = list(range(len(rows)))
    for _ in rows:
        for a, b in itertools.combinations(range(len(rows)), 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                group[a] = group[b] = min(group[a], group[b])
    least = {}
    for i, row in enumerate(rows):
        least[group[i]] = min(least.get(group[i], last(None)), last(row[0]))
    want = sorted((last(r[0]), len(sets[i]), least[group[i]]) for i, r in enumerate(rows))
    assert sorted((last(r.doc_id), r.n_shingles, last(r.component_id)) for r in got) == want
    kept = near_dedup.keep_one(docs, Scratch(spark, "t"), near)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert near_dedup.near_groups(empty, Scratch(spark, "t"), near).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2**63, 700).astype(np.uint64)
    a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 150).astype(np.uint64)]))
    b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, 150).astype(np.uint64)]))
    found = near_dedup.sketches([a, b, a[:1], a[:5]], 512)
    assert (found != near_dedup._FULL).all()
    assert abs((found[0] == found[1]).mean() - 0.7) < 0.08


def test_sieve_loses_no_wanted_row(spark):
    rows = spark.range(20_000).selectExpr("nullif(id, 7) as node", "id as text")
    wanted = rows.where("node is null or node % 100 = 3").selectExpr("node as a", "text as h")
    found = near_dedup.sieve(rows, ["node", "text"], wanted, ["a", "h"]).collect()
    must = {(r.a, r.h) for r in wanted.collect()}
    assert must <= {(r.node, r.text) for r in found} and len(found) < len(must) + 50
    assert not near_dedup.sieve(rows, ["node"], wanted.limit(0), ["a"]).count()


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(40, 50), (60, 50), (70, 71), (71, 70)]
    frame_ = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.label for r in components.components(frame_, Scratch(spark, "t"), "c").collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 50: 40, 60: 40, 70: 70, 71: 70}


def test_suffix_array():
    rng = np.random.default_rng(3)
    for trial in range(150):
        t = np.append(rng.integers(1, rng.choice([2, 3, 200]) + 1, rng.integers(0, 60)), 0)
        t = t if trial % 2 else np.append(np.tile(t[:-1], 3), 0)
        want = sorted(range(len(t)), key=lambda i: list(t[i:]))
        for k in (258, 5000):
            assert list(suffix_array.suffix_array(t, k)) == want


def test_suffix_dedup(spark, odd, empty):
    rows = [*ODD, (20, "q" * 49, "a"), (21, "q" * 49, "a"), (22, "start " + P1 + "?", "b")]
    owner: dict[bytes, tuple] = {}
    texts = [(last(i), (t or "").encode()) for i, t, _ in rows]
    for i, data in texts:
        for p in range(len(data) - 49):
            owner[data[p:p + 50]] = min(owner.get(data[p:p + 50], i), i)
    want = []
    for i, data in texts:
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if owner[data[p:p + 50]] < i:
                gone[p:p + 50] = [True] * 50
        spans = sum(g and not b for g, b in zip(gone, [False, *gone]))
        want.append((i, len(data), sum(gone), spans, bytes(itertools.compress(data, (not g for g in gone)))))
    got = suffix_dedup.remove_repeats(frame(spark, rows), Scratch(spark, "t")).collect()
    assert sorted((last(r[0]), *r[1:4], bytes(r[4])) for r in got) == sorted(want)
    assert suffix_dedup.remove_repeats(empty, Scratch(spark, "t")).count() == 0


def test_hot_anchors_are_dealt_by_strings(spark, monkeypatch):
    rows = [(i, f"{i} " + P1 + f" {i}", "a") for i in range(12)]
    plain = suffix_dedup.remove_repeats(frame(spark, rows), Scratch(spark, "t")).collect()
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    hot = suffix_dedup.remove_repeats(frame(spark, rows), Scratch(spark, "t")).collect()
    assert sorted(map(tuple, hot)) == sorted(map(tuple, plain))


def test_stretches_go_in_rounds(spark, monkeypatch):
    rows = [(i, f"{i} " + P1 + f" {i}", "a") for i in range(-2, 10)] + [(None, P1 + "!", "a")]
    plain = suffix_dedup.remove_repeats(frame(spark, rows), Scratch(spark, "t")).collect()
    monkeypatch.setattr(suffix_dedup, "ROOM", 0.5)
    for hot in (suffix_dedup.HOT, 1):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        scratch = Scratch(spark, "t")
        got = suffix_dedup.remove_repeats(frame(spark, rows), scratch).collect()
        assert sorted(map(str, got)) == sorted(map(str, plain))
        tables = os.listdir(scratch.folder.removeprefix("file://"))
        assert 1 < len(tables) < 50 and all(t.startswith("owners") for t in tables)


def test_stretches_are_sent_packed():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(2_000)]
    texts = [" ".join(rng.choices(words, k=400)).encode() for _ in range(100)]
    found = suffix_dedup.Stretches(texts, 50)
    shorts = suffix_dedup._pack(np.unique(suffix_dedup._short(found.anchor)), np.uint32)
    docs = pa.table({"rid": [-7, *range(1, 100)], "block": [0] * 100, "text": texts})
    sent = suffix_dedup._stretch_rows(50, 4)(docs, pa.table({"anchors": [shorts], "hot": [b""]}))
    rows = sent.drop_columns(["shard", "block"]).to_pylist()
    n = sum(len(suffix_dedup._unpack(r["sizes"], np.int32)) for r in rows)
    assert n == len({d for *_, d in found.units(np.arange(len(found.start)), set(), 50)})
    # As Spark compresses them; 67 bytes of text and 29 of numbers each.
    assert sum(len(pa.compress(x, "lz4", asbytes=True)) for r in rows for x in r.values()) < 50 * n
    least, beyond = (suffix_dedup._unpack(x, np.int64) for x in suffix_dedup._least_and_beyond(
        [[-5, suffix_dedup.LAST], [7, 7]]))
    assert least.tolist() == [-5, 7]
    assert (least + beyond).tolist() == [suffix_dedup.LAST, 7]


def test_token_counts(spark, odd, empty):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = token_counts.count_tokens(odd, path, 10).collect()
    for row, (i, t, _) in zip(got, ODD, strict=True):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert tuple(row) == (i, len((t or "").encode()), n, n > 10)
    counter = token_counts.PrefixCounter(path)
    text = "don't  stop \n\n<|endoftext|> 12ab é　中文 we'll"
    ends, counts = counter.prefixes(text)
    for n in range(len(text) + 1):
        want = len(library.encode(text[:n], add_special_tokens=False).ids)
        assert counter.at(text, ends, counts, n) == want
    for budget in range(12):
        length = counter.fitting(text, ends, counts, budget)
        assert len(library.encode(text[:length], add_special_tokens=False).ids) <= budget
    assert token_counts.count_tokens(empty, path).count() == 0


def test_sentence_pieces(spark, odd, empty, monkeypatch):
    library = pytest.importorskip("sentencepiece")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("piece_bpe_32k.model")
    model = library.SentencePieceProcessor(model_file=path)
    coded = sentence_pieces.encode(odd, path)
    for row, (_, t, _) in zip(coded.collect(), ODD, strict=True):
        assert row.ids == model.encode(t or "", num_threads=1)
        assert row.decoded_sha256 == hashlib.sha256(model.decode(row.ids).encode()).hexdigest()
    back = sentence_pieces.decode(coded, path).collect()
    assert [r.text for r in back] == [t or "" for _, t, _ in ODD]
    pieces = sentence_pieces.Pieces(path)
    text = "▁" + (P1 + "ab" * 90 + "\n\n中 x").replace(" ", "▁")
    monkeypatch.setattr(sentence_pieces, "CHUNK", 8)
    parts = list(pieces.stream(text))
    assert len(parts) > 1 and len(list(pieces._window("ab" * 90))) > 1 and [i for p in parts for i in p] == model.encode(text[1:].replace("▁", " "))
    assert sentence_pieces.encode(empty, path).count() == 0


def test_tasks_get_a_text_once(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, 7)], "doc_id long, Text string, score long")
    read, at = with_text(docs, docs.columns)
    assert read.columns == docs.columns and at == 1
    read, at = with_text(docs, ["doc_id"])
    assert at == 1 and [r[1] for r in read.collect()] == ["a", ""]
    codes = docs.select("doc_id", F.col("doc_id").alias("text"))
    read, at = with_text(codes, codes.columns)
    assert at == 2 and len(read.columns) == 3
    plan = quality.score(docs, quality.Model.learn(quality.Terms().rows(["a", "b c"] * 9), np.ones(18)))
    assert [r.score for r in plan.collect()] == [1, 1] and plan.columns == ["doc_id", "Text", "score"]


def test_pass_looks_at_few_tokens():
    letters, words = "abcd", ("ab", "cd", "abcd")
    rank = {w: i for i, w in enumerate(words)}
    merges = bpe.Merges([*letters, *words], rank, by_pair=False)
    assert merges.last_tokens("xabcdab") == [None, "x", "a", "ab", "c", "abcd", "a", "ab"]
    assert [*merges.ends("xabcdab")] == merges.last_tokens("xabcdab")[1:]
    # A unit is the last token where no longer one is, so none is looked up.
    assert len(merges._ending) == len(words)
    units = bpe.Merges(letters, {}, by_pair=False)
    assert units.last_tokens("abx") == [None, *units.ends("abx")] == [None, "a", "b", "x"]


def test_ids_go_out_by_few_rows(spark, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    pieces = sentence_pieces.Pieces(public.path("piece_bpe_32k.model"))
    assert pieces._stretches("▁a▁▁b▁") == ["a", "▁b", ""] and pieces._stretches("▁a▁b") == ["a", "b"]
    again = pieces.encode("ab  cd ab")
    assert list(again) == list(pieces.encode("ab  cd ab")) and all(
        isinstance(ids, bytes) for ids in pieces._known.values())
    monkeypatch.setattr(sentence_pieces, "BLOCK", 2)
    docs = spark.createDataFrame([(i, "word " * i) for i in range(7)], "doc_id long, text string")
    rows = sentence_pieces.encode(docs.coalesce(1), public.path("piece_bpe_32k.model")).collect()
    assert [(r.doc_id, r.ids) for r in rows] == [(i, list(pieces.encode("word " * i))) for i in range(7)]
    assert all(r.n_ids == len(r.ids) for r in rows)


def test_topk_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist(), "x") for i in range(60)]
    rows += [(60, None, "x"), (61, [1.0, None], "x"), (62, [float("nan")], "x"), (63, [], "x"),
             (64, [float("inf")], "x"), (65, rows[0][1], "x"), (0, rows[0][1], "x"), (None, rows[1][1], "x")]
    vectors = topk_search.integer_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string"))
    got = topk_search.search(vectors.where("vec_id % 10 = 0"), vectors).collect()
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {i: v for i, v in usable if i is not None and i % 10 == 0}.items():
        found = [(-sum(a * b for a, b in zip(v, w)), last(i), i) for i, w in usable if i != q]
        want += [(q, r, i, -s) for r, (s, _, i) in enumerate(sorted(found)[:5], 1)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert topk_search.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_quality(spark, sf_dir, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, sample=100)
    assert len(model.labels) <= 100
    scored = quality.classify(docs, labels)
    assert scored.columns[:len(docs.columns)] == docs.columns
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.85
    # Scores are those of a plain search over all labelled vectors.
    texts = [r.text for r in rows[:20]]
    terms = quality.Terms().rows(texts)
    own = quality._unit(quality._scaled(terms, model.rarity) @ model.axes)
    for one, fast in zip(own, model.scores(terms), strict=True):
        cosine = model.vectors @ one
        near = np.argsort(-cosine)[:quality.NEIGHBOURS]
        weight = np.clip(cosine[near], 0, 1).astype(float) ** quality.SHARPNESS
        assert fast == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=0.1)
    odd = frame(spark, ODD)
    assert all(0 <= r.score <= 1 for r in quality.classify(odd, labels.limit(0)).collect())
    assert quality.classify(odd.select("doc_id", "text"), labels).count() == len(ODD)
    assert quality.classify(empty, labels).count() == 0


@pytest.mark.parametrize("text", [
    "", "Ab É", "Ab c" * 1500, "Abcdefg\n" * 1250, "a" * 9000 + "B" * 3000, ("x" * 4999 + "É") * 3,
])
def test_capitals_are_counted_over_the_whole_text(text):
    words = text.split()
    share = sum(c.isupper() for c in text) / max(1, len(text))
    assert quality._scales(text, words, quality.Counter(words))[3] == min(1, 2 * share)


def test_shape_is_that_of_the_whole_word():
    assert quality._shape("ab" * 16 + "C9é中") == "aaA9aa"
    long = "x" * 40 + "=" * 3 + "Q7" * 2000
    assert quality._shape(long) == "aa==" + "A9" * 2000
    terms = quality.Terms()
    same, other = terms.rows([f"short {long}", f"short {long[:32]}"])
    shapes = slice(quality.HEAD, quality.HEAD + quality.N_SHAPES)
    assert (same[shapes] != other[shapes]).any()
    assert long not in terms._columns and "short" in terms._columns


def test_token_counts_of_every_prefix():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    counter = token_counts.PrefixCounter(path)
    rng = np.random.default_rng(5)
    parts = ["a", " ", "\n", "\t", "'", "'re", "'ll", "don't", "!", "12", "é", "中文", "\u3000", "\x1c",
             "<|endoftext|>", "<|end", "hello", "Word", "▁", "e\u0301", "\U0001f600"]
    texts = ["a\n\nb", "", *("".join(rng.choice(parts, 14)) for _ in range(150))]
    for text in texts:
        _, counts = counter.prefixes(text)
        want = [len(library.encode(text[:n], add_special_tokens=False).ids)
                for n in range(len(text) + 1)]
        assert counts == want
        assert counter.count(text) == want[-1]
        for budget in range(max(want) + 2):
            longest = max(n for n, c in enumerate(want) if c <= budget)
            assert counter.fitting(text, [], counts, budget) == longest


def test_token_queries_equal_the_libraries(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    library = pytest.importorskip("sentencepiece")
    public = pytest.importorskip("public_tokenizers")
    docs = [(i, t) for i, t, _ in ODD]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    counts = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    pieces = library.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    want6, want5 = [], []
    for i, t in docs:
        text = t or ""
        n = len(counts.encode(text, add_special_tokens=False).ids)
        want6.append((i, len(text.encode()), n, n > 512))
        ids = pieces.encode(text, num_threads=1)
        digest = hashlib.sha256(pieces.decode(ids).encode()).hexdigest()
        same = digest == hashlib.sha256(text.encode()).hexdigest()
        want5.append((i, len(ids), ids, digest, same))
    got = token_counts.op6_token_counts(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want6, key=str)
    got = sentence_pieces.op5_sentence_pieces(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want5, key=str)


def test_near_stage_of_the_pipeline(spark):
    import corpus_pipeline

    rng = np.random.default_rng(2)
    rows = []
    for i in range(40):
        words = [f"w{i % 4}x{n}" for n in range(120)]
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            words[at] = f"z{rng.integers(0, 9999)}"
        rows.append((i, " ".join(words), "n"))
    sets = plain_sets([r[1] for r in rows], 5)
    group = list(range(len(rows)))
    for _ in rows:
        for a, b in itertools.combinations(range(len(rows)), 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[a] = group[b] = min(group[a], group[b])
    kept = corpus_pipeline.near_dedup_stage(spark, frame(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(group))
    assert 4 < len(kept) < len(rows)
