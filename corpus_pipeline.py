"""A training corpus from documents: every stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, near_dup, quality_model, substring_dedup
from tidemark.llm.queries import remainder
from tidemark.llm.work import saved, table, text_key, without


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Every row is judged by its own text, null as empty; repeated rows, null ids and all columns stay as
    they are; an empty table stays empty.
    """
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"), "quality", remainder(5) == 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8.

    Rows without words or with a null doc_id stay.  Of rows that share a doc_id each is judged by its
    own text; repeated rows of the document that is kept stay together.
    """
    docs, key = text_key(docs)
    return without(docs, near_dup.near_duplicates(docs, by=(key,)).where("not kept"), key)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller ids hold; n_chars, if there, follows the text.

    Texts that lose all words stay as empty texts; null texts, null ids, repeated rows and other columns
    stay as they are.
    """
    out = substring_dedup.dedup_substrings(docs, text_out=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage near a benchmark item.

    Every row is judged by its own text, rows with a null doc_id too; null and empty texts stay.
    """
    docs, key = text_key(docs)
    return without(docs, decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), by=("doc_id", key)), key, native=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document that is left: 0 of texts without words; a null source is one of its own."""
    rows = mixing.mix(docs, F.array("source"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
]

#: A fitted classifier and seeded hashes are beyond SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
