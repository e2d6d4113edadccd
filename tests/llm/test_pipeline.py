"""The pipeline's stages and the queries with SQL counterparts."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import duckdb
import pytest
from test_operators import plain_sets

from riskweave.llm import quality, registry
from riskweave.llm.scratch import Scratch


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    with duckdb.connect() as con:
        for table in ("documents", "embeddings", "conversations", "benchmark"):
            con.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
        want = con.sql(registry.oracle_sql()[name])
        names, rows = want.columns, want.fetchall()
    got = registry.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    plain = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows]
    own = [tuple(round(v, 6) if isinstance(v, float) else v for v in r)
           for r in got.select(*names).collect()]
    assert sorted(own, key=str) == sorted(plain, key=str)


def test_stages_hand_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *early, (_, final) = corpus_pipeline.STAGES
    for _, stage in early:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        assert 0 < got.select("doc_id").distinct().count() <= docs.count()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for row in final(spark, docs, sf_dir).collect():
        assert row.n_ids == len(row.ids)
        assert row.decoded_sha256 == hashlib.sha256(by_id[row.doc_id].encode()).hexdigest()


def plain_near(rows, words=5, percent=80):
    """Rows left when of near copies the one with the smallest id stays."""
    sets = plain_sets([r[1] for r in rows], words)
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return [r for i, r in enumerate(rows) if top(i) == i]


def test_the_whole_pipeline_equals_a_plain_calculation(spark, sf_dir, tmp_path):
    """Over a fixture of copies, near copies and junk; the classifier's own decisions are taken."""
    import public_tokenizers
    import sentencepiece

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs][:90]
    rows += [(1000 + i, r[1].replace(" ", "  "), *r[2:]) for i, r in enumerate(rows[:15])]
    rows += [(2000 + i, r[1] + " and one word more", *r[2:]) for i, r in enumerate(rows[:15])]
    rows += [(3000, "", "en", "src1", 0), (3001, " \n", "en", "src1", 2)]
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    accepted = {r.doc_id for r in quality.classify(table, labels).where("predicted = 1").collect()}
    assert 20 < len(accepted) < len(rows)
    groups: dict[str, list] = {}
    for row in rows:
        if row[0] in accepted:
            groups.setdefault("".join(row[1].split()), []).append(row)
    left = sorted(min(g, key=lambda r: (-len(r[1]), r[0])) for g in groups.values())
    left = plain_near(left)
    with duckdb.connect() as con:
        con.sql("create table documents (doc_id bigint, text varchar, source varchar)")
        con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in left])
        mixed = con.sql(registry.oracle_sql()["op8_mixing"]).fetchall()
        names = con.sql(registry.oracle_sql()["op8_mixing"]).columns
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r[0]: r[1] for r in left}
    want = []
    for row in (dict(zip(names, m, strict=True)) for m in mixed):
        ids = model.encode(text[row["doc_id"]])
        digest = hashlib.sha256(model.decode(ids).encode()).hexdigest()
        want += [(row["doc_id"], ids, digest)] * (row["taken"] // max(1, row["size"]))
    # How often a text without words is taken changes no target.
    sized = [(r.doc_id, r.ids, r.decoded_sha256) for r in got if text[r.doc_id].split()]
    assert sorted(sized) == sorted(want)


def test_stage_tables_go_when_their_result_is_written(spark, tmp_path):
    with Scratch.cleared():
        inner = Scratch(spark, "inner")
        inner.keep(spark.range(3), "t")
        path = inner.path("t")
        assert spark.read.parquet(path).count() == 3
    outer = Scratch(spark, "outer")
    outer.keep(spark.range(3), "t")
    outer.drop("t")
    for gone in (path, outer.path("t")):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(gone)
