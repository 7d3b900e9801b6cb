"""From raw documents to a mixed training schedule, in five stages.

Every stage works on all rows its predecessor kept, and its result is written and read again before the next.

1. language ID: rejects texts without letters and texts in which no language has two fifths of the letters
2. line dedup: takes lines out that repeat an earlier one; a text that loses its last line with words goes
3. MinHash near-dedup: of each class of near-duplicate documents the one with the smallest id stays
4. benchmark decontamination: contaminated documents go
5. mixing: the remaining documents are drawn by temperature weights of their sources

Rows with a null id pass the third stage; an empty table gives an empty schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkprint.llm.decontaminate import contaminated, contamination
from inkprint.llm.language import identify, train
from inkprint.llm.linededup import dedup_lines
from inkprint.llm.mixing import mix
from inkprint.llm.neardup import near_duplicates
from inkprint.session import materialize

MIN_LANGUAGE_SHARE = 0.4
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = F.col("language")
    keep = (found["lang"] != "und") & (found["score"] >= MIN_LANGUAGE_SHARE)
    return identify(docs, train(docs)).where(keep).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, benchmark).where(~contaminated()).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
