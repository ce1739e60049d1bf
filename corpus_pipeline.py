"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote as Parquet and, but for the last, returns the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookweave.llm import decontaminate as leaks
from bookweave.llm.common import stored, table
from bookweave.llm.jaccard import one_of_each
from bookweave.llm.language import in_a_language
from bookweave.llm.line_dedup import dedup_lines
from bookweave.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language.

    Those are null, empty and blank texts, texts without a letter, and texts of 64 letters or more that parse no better
    than random letters in any language. Whole texts are parsed, however long. Repeated rows are treated alike; ties
    between languages keep a text. An empty table, or one from which nothing can be learnt, gives an empty result. All
    columns of docs are kept, whatever their names.
    """
    return in_a_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of texts; a text of which nothing is left goes.

    Of equal runs of three lines the first by (doc_id, line) stays. Rows that share a doc_id, or have none, are one
    document. Null and empty texts have nothing to cut and stay. Whole texts are looked at, however long. n_chars follows
    the text where it is cut, if there is such a column; the other columns are kept, but for lines_removed, which this
    stage uses. An empty table gives an empty result.
    """
    docs = docs.drop("lines_removed")
    cut = dedup_lines(docs).filter((F.col("lines_removed") == 0) | (F.trim("text") != ""))
    chars = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return cut.select(*(chars.alias(c) if c == "n_chars" else c for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five words a shingle, similarity 0.8.

    It is the one with the smallest (doc_id, text hash). Of equal rows one stays; different texts under one doc_id stay
    both unless they link. Rows without doc_id and texts without a word stay all. Whole texts are compared. An empty
    table gives an empty result; all columns are kept, whatever their names.
    """
    return one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts with a passage of the benchmark: 14 tokens of which three in four are equal, or a whole short item.

    Each row's text counts for itself, with or without doc_id; null and empty texts stay, as do all if the benchmark is
    empty. Whole texts are searched. Repeated rows go or stay together. An empty table gives an empty result; all columns
    are kept, whatever their names.
    """
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens; a row per piece.

    Null and empty texts are one token. Longer texts than a sequence are cut. Repeated rows are packed each; which of
    equally long pieces goes where is drawn. An empty table gives an empty result; other columns are left behind.
    """
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Predictions, links by count vectors and the packing can't be put in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
