"""From documents to tokens: language, exact copies, near copies, benchmark passages, encoding.

Each stage is a function of (spark, docs, sf_dir); what it returns is written and
read again before the next one starts.  All but the last return the columns of
``documents``.  The language machines are fitted on the documents that the stage
gets, and no stage but the fourth reads another table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.frames import saved, table
from quarry.llm.op04_decontaminate import decontaminate
from quarry.llm.op05_bpe import encode_documents
from quarry.llm.op08_jaccard import keep_one
from quarry.llm.op09_language import accepted
from quarry.llm.op10_exact import drop_copies
from quarry.runtime import reachable

#: SQL can't express the machines, the trie join, the fingerprints or the encoding.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is decided with enough margin.

    Null and empty texts, and texts without a letter, have no language and go.  Rows
    with a null id, source or count, repeated rows and columns of any name stay as
    they are; where no row has a ``lang`` there is nothing to fit on, and all go.
    """
    reachable(spark)
    return accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of equal normalised texts.

    Null ids come after all others, null texts all stay, empty texts equal each
    other, and of rows that agree in text and id one stays.
    """
    reachable(spark)
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group that links of n-gram Jaccard similarity connect.

    Rows without an id, or without a word in their text, stay; rows that share an id
    stay or go together.
    """
    reachable(spark)
    return keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Rows without an id or a word stay; with an empty benchmark all do; rows that share
    an id stay or go together.
    """
    reachable(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), within=True)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document that is left: a row a row, null for a null text, none for an empty one."""
    reachable(spark)
    return encode_documents(docs)


STAGES = [
    ("language", language),
    ("exact copies", exact_copies),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
