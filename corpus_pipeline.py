"""From raw documents to token ids: quality, near copies, repeated passages, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last one return the columns
of documents. run() writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import mixing, near_copies, pu_quality, repeats, word_bpe
from folio.llm.shared import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like any other, null doc_ids and repeated rows too; each row stands for itself. All
    columns stay as they are, those named like the classifier's results included. An empty table stays empty, and
    without a label that can be learnt from every document stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    names = ("__held_out", "__score", "__predicted")
    return pu_quality.score(docs, pu_quality.train(docs, labels), names).filter("__predicted = 1").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest doc_id.

    Null and empty texts and rows without a doc_id are like nothing and stay. Of rows that share an id, each different text
    counts; equal rows are one document. Texts may be of any length; all columns stay as they are. An empty table stays
    empty."""
    return near_copies.one_of_each(docs, near_copies.classes(docs))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start earlier elsewhere are cut out; n_chars follows. No document goes.

    A null text becomes an empty one. Rows that share an id start at the same places, so they take nothing from each other
    where those are equal. Texts may be of any length; other columns stay as they are. An empty table stays empty."""
    out = repeats.clean_texts(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it.

    Null sources are one source; null and empty texts have no words and stay while a pass reaches them. Rows that repeat
    are taken one by one. All columns stay as they are. An empty table stays empty."""
    return mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's token ids, and the digest of what they decode to.

    A null text counts as empty and has no ids. Null ids and repeated rows don't matter; texts may be of any length; columns
    other than doc_id, lang and source go. An empty table gives an empty result."""
    return word_bpe.encode(docs, word_bpe.default_path(), ["doc_id", "lang", "source"])


STAGES = [("quality", quality), ("near_copies", near), ("repeats", passages), ("mixing", mixed), ("bpe", tokens)]

#: SQL can express neither the training of the classifier nor BPE; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
