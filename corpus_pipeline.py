"""From raw documents to packed training sequences.

STAGES holds (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written and read again as the next one's
docs.  All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitstop.llm import langid, mixing, ngram_join, packing, sentence_spans
from pitstop.llm.queries import tokenizer_path
from pitstop.llm.scratch import FREES_MEMORY, stage, with_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from docs.
    Texts that are null or have no letter are not recognised and go; rows that
    come again are judged alike and all stay or go; a null lang teaches
    nothing; an empty table gives no rows."""
    return langid.accepted_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram join links: that with the
    smallest id, null last.  Rows that come again are such a group; a text
    without a word (null, empty, blank) links with nothing and stays; an empty
    table gives no rows."""
    return ngram_join.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that came before, by id (null last), then
    text; documents that lose all their words go.  Texts without a word (null,
    empty) have nothing to lose and stay; an empty table gives no rows."""
    return sentence_spans.without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each time a document is
    taken.  A null source is a source; texts without a word (null, empty) have
    nothing to take and go; rows that come again are taken one after another,
    so the budget is met; an empty table gives no rows."""
    return mixing.mixed_rows(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, with their token ids (ids_bytes, little-endian
    unsigned 32-bit) and their places in sequences of 1024; ``doc_row`` tells
    the times apart that the mixture takes one document.  A null text is an end
    id alone; an empty table gives no rows."""
    return packing.pack_documents(docs, tokenizer_path(), with_bytes=True, with_rows=True)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]
STAGES = [(name, with_package(function, FREES_MEMORY)) for name, function in STAGES]

# A trained model, links and a tokenizer are beyond SQL; a test holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
