"""Line deduplication: lines that several documents hold stay in the first of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .common import SPACES, ascii_lower, text_key, two_hashes, without

RESULT = ["n_lines", "n_dropped", "kept_text"]


def line_key(line: Column) -> Column:
    """The normalised line: stripped at both ends, A to Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame,
    min_length: int = 10,
    min_documents: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Drop repeated lines; adds ``n_lines``, ``n_dropped`` and ``kept_text``.

    Texts are exploded into lines; distinct documents are counted per hash of
    the normalised line (map-side combined, 128 bits); a line whose key has at
    least ``min_length`` code points and is in at least ``min_documents``
    documents is dropped everywhere but in the smallest document that holds it;
    the rest is put together by position.  A text is moved once, when its
    dropped positions are joined to it; hot lines are spread by Spark's skew
    join, as both joins are plain equi-joins.

    A null text counts as one empty line and is kept as the empty text.  Rows
    without a document number hold no line for others and lose none.  Rows that
    repeat a number count as the same document; each is treated by its own text.
    """
    docs = without(docs, RESULT)
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    h1, h2 = two_hashes(F.col("key"), "line")
    found = (
        docs.where(F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("doc"), text_key(text).alias("row"), F.posexplode(lines).alias("pos", "line"))
        .select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_length)
        .select("doc", "row", "pos", h1.alias("h1"), h2.alias("h2"))
    )
    if min_documents == 2:
        repeated = found.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    else:
        per_document = found.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        repeated = (
            per_document.groupBy("h1", "h2")
            .agg(F.min("doc").alias("first"), F.count("*").alias("n"))
            .where(F.col("n") >= min_documents)
        )
    # A table of its own: beside an aggregate Spark could not split the hot lines of the join.
    repeated = durable(repeated.select("h1", "h2", "first"))
    dropped = (
        found.join(repeated, ["h1", "h2"])
        .where(F.col("doc") > F.col("first"))
        .groupBy("doc", "row")
        .agg(F.collect_list("pos").alias("dropped"))
    )
    # the input travels as one struct, so that its columns may have any names
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input"), F.col(doc_id).alias("doc"), text_key(text).alias("row")
    )
    own = F.col(f"input.`{text}`")
    positions = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(positions, F.col("dropped")), lambda i: F.get("lines", i))
    return (
        whole.join(dropped, ["doc", "row"], "left")
        .withColumn("lines", F.split(F.coalesce(own, F.lit("")), "\n", -1))
        .withColumn("kept", F.when(F.col("dropped").isNotNull(), kept))
        .select(
            "input.*",
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce(F.array_join("kept", "\n"), own, F.lit("")).alias("kept_text"),
        )
    )
