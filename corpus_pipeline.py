"""The corpus pipeline: five operators of ``panelscore.llm`` in a row over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread as the next
stage's ``docs``. The first four keep whole rows of ``documents``; the last adds the mix.

=====================  =====================================================================================
quality                drops rows whose probability of quality 1 is under ``subwords.THRESHOLD`` (0.7)
toxicity               drops rows whose probability of severity 1 or more is ``ordinal.TOXIC_AT`` (0.4) or higher
near_duplicates        keeps one row of each group of fingerprints linked at 2 bits or fewer (3-word shingles)
decontamination        drops rows that hold a benchmark item within 20 % word edits
mixing                 drops rows the mix takes no word of; adds size, source_size, target, taken and pieces
=====================  =====================================================================================

Nulls, empty texts, repeated rows, empty tables and very long texts: as stated in each module. Further columns are kept whatever their names: inner
columns take names that the table does not have. The
classifiers learn from the labels in ``sf_dir`` and the documents of their own input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.llm import cgk, mixing, ordinal, simhash, subwords
from panelscore.llm.common import free_name, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name(docs.columns, "_score")
    return subwords.scored(spark, docs, table(spark, sf_dir, "labels"), score).where(F.col(score) >= subwords.THRESHOLD).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grade = free_name(docs.columns, "_toxicity")
    return ordinal.graded(spark, docs, table(spark, sf_dir, "labels"), grade).where(F.col(f"{grade}.p_any") < ordinal.TOXIC_AT).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cgk.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix_columns(docs.columns)[3]
    return mixing.mixed(spark, docs).where(F.col(taken) > 0)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mix)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
