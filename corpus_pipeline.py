"""The corpus pipeline: documents that pass the quality rules, without boilerplate lines and near-duplicates, mixed to target weights and packed.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. Between
stages the table is written as Parquet and read again. A text that a stage changes gets its n_chars anew.

Cases. A null or blank text has too few words and goes in the first stage, as every text of under 50 words does. Null
ids, languages and sources are values like others; a null source is one source of its own. Repeated rows are judged
each; of them one stays as a class of near-duplicates, the one with the least doc_id, then text hash. Mixing makes
copies of a row that are equal in every column, so their packed pieces are interchangeable. A column ``copy`` or
``mean_rate`` of the documents is replaced when they are mixed; other extra columns are carried up to packing. Empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import lines, mixing, neardup, packing, quality
from placeforge.llm._common import materialize, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizers and BagMinHash are beyond SQL; tests/llm/test_pipeline.py holds each stage's rows and run() against plain Python.
ORACLE_SQL = None
