"""The corpus pipeline: five stages, each written as Parquet and read again as
the documents of the next one.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns the packing of what is left. ``ORACLE_SQL`` is
None: neither trained models nor SimHash can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trafficlens.llm import queries as q
from trafficlens.llm.common import stored, table

STAGES = [
    ("language", q.keep_language),
    ("toxicity", q.drop_toxic),
    ("near_duplicates", q.drop_near_duplicates),
    ("decontamination", q.drop_leaks),
    ("packing", q.pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
