"""Training-data pipeline over the documents table: five stages, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept.  Each takes (spark, docs, sf_dir)
and returns the columns of documents, but for the last, which returns the encoded rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crewspark.llm.bpe import encode_documents
from crewspark.llm.common import ship_package, stage, table
from crewspark.llm.decontaminate import drop_contaminated
from crewspark.llm.language import keep_known_languages
from crewspark.llm.minhash import keep_one_of_each
from crewspark.llm.quality import keep_good

STAGES = [
    ("quality", keep_good),
    ("language", keep_known_languages),
    ("near_dedup", keep_one_of_each),
    ("decontaminate", drop_contaminated),
    ("encode", encode_documents),
]

#: The classifiers cannot be expressed in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over the documents of ``sf_dir``."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
