"""The corpus pipeline: stages over `documents`, each one a dealt operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import bpe, linededup, mixing, quality, simhash
from gridspark.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def choose_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance sample go, others stay as they are.

    Null and empty texts weigh 0; texts of any length are read whole; of rows
    that repeat a doc_id all stay if one does. An empty table gives no rows; other
    columns are dropped.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select(docs, labels).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are deleted; every document
    stays, with n_chars counted anew.

    Null text stays null, with n_chars null; a text of which nothing is left is
    empty. Rows equal in id and text are one document. Whole texts are compared;
    an empty table gives no rows; other columns are dropped.
    """
    out = linededup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest doc_id.

    Null text is as empty, and texts without words are one group; rows that share
    the smallest doc_id all stay, a null doc_id only in a group without others.
    Whole texts are read; an empty table gives no rows; other columns are dropped.
    """
    return simhash.dedup(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated until sources have their targets.

    Null and empty texts have no words; a null source is one of its own; rows that
    repeat a doc_id are taken alike. Whole texts are counted; an empty table gives
    no rows; other columns are dropped.
    """
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of them and of their decoding.

    Null and empty texts have no tokens; repeated rows and ids give a row each.
    Whole texts are encoded; an empty table gives no rows.
    """
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality classifier", choose_quality),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The stages hash with functions that DuckDB lacks and train a classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
