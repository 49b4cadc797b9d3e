"""The operators as stages of a corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, near_dedup, packing, quality_rules, substring_dedup


def with_text(done: DataFrame, docs: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` with a new text, and ``n_chars`` after it where there is one."""
    changed = {"text": text.cast("string")}
    out = done.withColumns(changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    judged = quality_rules.apply_rules(docs)
    return with_text(judged.where("kept"), docs, F.col("kept_text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller document holds; an empty one stays as an empty text."""
    return with_text(line_dedup.dedup_lines(docs), docs, F.col("kept_text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every near-duplicate class."""
    classes = near_dedup.near_classes(docs.select("doc_id", "text"))
    return near_dedup.keep_one(docs, classes).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 13 words and more that a smaller document holds.

    A document that loses words has its other words joined by one space; others
    keep their text as it is.
    """
    done = substring_dedup.dedup_substrings(docs)
    return with_text(done, docs, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place in it."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(packing.pieces_of(docs, path, 2048), 2048)
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
