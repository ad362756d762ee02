"""A corpus made ready for training: the stages in order, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftline.llm import stages
from siftline.llm.tables import stored, table

STAGES = [
    ("quality rules", stages.quality_rules),
    ("near duplicates", stages.near_duplicates),
    ("decontamination", stages.decontaminate),
    ("mixing", stages.mix_sources),
    ("sharding", stages.shard_documents),
]

# Components and greedy tiling are iterative. tests/llm/test_stages.py holds run() stage by stage to plain
# versions or to the laws of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
