"""From raw documents to token ids: five stages, each one operator of ``riskweave.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame; its result is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of ``docs``,
whatever their names.  A null text is an empty one in every stage, and an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import exact_dedup, mixing, near_dedup, quality, sentence_pieces
from riskweave.llm.scratch import Scratch, sweep

#: SQL has neither the classifier nor the tokenizer.  A test compares ``run`` with a plain calculation.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts: a score of 0.3 or more, of which ties are part.

    An empty text is judged by its form like any other.  Without labels all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).where("predicted = 1").select(*docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space.

    The one with most code points stays, then the smallest doc_id (null last), then one of
    repeated rows.  All empty texts are one group.
    """
    return exact_dedup.keep_one(docs, Scratch(spark, "pipeline-exact"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8 or more.

    The smallest doc_id stays, null last.  Texts without words are no copies of anything and stay.
    """
    sweep(spark)
    return near_dedup.keep_one(docs, Scratch(spark, "pipeline-near"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it, 0 to 3 times.

    A null source is a source.  Texts without words count nothing and go when their source has
    no words at all; rows alike are taken in such numbers as the target needs.
    """
    sweep(spark)
    return mixing.repeat(docs, Scratch(spark, "pipeline-mixing"))


def sentence_piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids and the digest of the text decoded from them.

    An empty text has no ids; repeated rows come out repeated.
    """
    import public_tokenizers

    sweep(spark)  # the executors still hold what the stages before broadcast
    used = docs.select("doc_id", "source", "text")
    coded = sentence_pieces.encode(used, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "source", "n_ids", "ids", "decoded_sha256")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("sentence_pieces", sentence_piece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result but the last goes to the shared folder.

    A stage's own tables, and the result before it, are deleted when its result is written.
    """
    scratch, before = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with Scratch.cleared():
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
