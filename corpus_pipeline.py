"""Corpus pipeline: language ID, near duplicates, repeated passages, mixing, packing.

``STAGES`` are (name, function) pairs; each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and reread as the next stage's
``docs``.  All stages but the last return the columns of ``documents``; rows are
told apart by position, so null ids and repeated rows pass through.  Texts are read
whole, of any length.  An empty table stays empty through all stages.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from csvforge.llm.common import Workspace, table
from csvforge.llm.jaccard import one_of_each
from csvforge.llm.language import keep_identified
from csvforge.llm.mixing import mixed_rows
from csvforge.llm.packing import pack_documents
from csvforge.llm.paragraphs import remove_repeats

LEAST_SHARE = 0.5             # part of a document's words that must be in one language
MIX_SHARE = (9, 10)           # budget of the mix: part of the tokens that arrive


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or without one that holds half their words, go.

    A null, empty or letterless text has no language and goes.  Repeated rows share their
    label and fate.  Without any labelled row no document has a language."""
    return keep_identified(docs, least=LEAST_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at Jaccard 0.8 stays.

    Null and empty texts are linked with nothing and stay.  Of equal or linked rows the one
    that is read first stays (ties of ids included)."""
    return one_of_each(docs, k=5, num=8, den=10)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat an earlier one are cut out.

    The first place read keeps a passage.  A document whose text repeats as a whole keeps
    its row with what is left; null, empty and short texts pass as they are."""
    return remove_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at most once, by the target weights of domains and languages.

    Null languages and sources are leaves of their own; texts without words cost nothing.
    Repeated rows stand side by side in the order and are taken or left together."""
    return mixed_rows(docs, max_epochs=1, share=MIX_SHARE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place.

    A null or empty text is one piece, the end id alone; only documents longer than a
    sequence are cut; repeated rows are packed as often as they occur."""
    return pack_documents(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None             # learned labels and tokenizer ids are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return ws.finish(stage(spark, docs, sf_dir))
