"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.session import drop_scratch, durable, scratch_path, scratch_scope

#: Name and function of each stage; a function takes (spark, docs, sf_dir).
STAGES = [
    ("quality_rules", stages.clean_lines),
    ("line_dedup", stages.drop_repeated_lines),
    ("near_dedup", stages.drop_near_duplicates),
    ("substring_dedup", stages.cut_repeated_passages),
    ("packing", stages.pack_sequences),
]

#: Alignment and packing cannot be said in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the whole of ``documents``; each result is a table that the next one reads.

    A stage's working tables go when its result is written, and its input with them.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            docs = durable(stage(spark, docs, sf_dir), path)
        drop_scratch(spark, read)
        read = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
