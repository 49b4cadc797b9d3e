"""Samples of a fixed size per group that depend on the rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.columns import hash_number
from ..session import durable

#: Bits of the hash, and how many of them each pass looks at.
_BITS, _STEP = 52, 12


def hash_sample(
    df: DataFrame, size: int, key: Column, by: Sequence[str] = (), seed: int = fixed.SEED, max_rows: int = 100_000
) -> DataFrame:
    """Up to ``size`` rows of every group of ``by``: those whose keys have the smallest hashes.

    The same rows are drawn whatever the partitioning, and a sample of a larger
    size holds that of a smaller one.  No group is sorted: rows are counted per
    group and range of hashes, map-side combined, which tells the range in which a
    group's sample ends.  All rows under it are drawn; only the rows of that range
    are ranked, by hash and key, after it has been cut finer while it holds more
    than ``max_rows``.  A null group is one of its own; smaller groups are drawn
    whole; of rows that repeat a key any may be drawn.
    """
    if size < 1:
        return df.where("false")
    group = F.struct(*[F.col(f"`{c}`") for c in by], F.lit(0).alias("all"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), group.alias("of"), key.alias("key"))
    rows = rows.withColumns({"of": F.xxhash64(F.to_json("of", {"ignoreNullFields": "false"})), "hash": hash_number(F.col("key"), seed).cast("long")})
    ahead = Window.partitionBy("of").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)

    def cell(depth: int) -> Column:
        return F.shiftright("hash", max(0, _BITS - _STEP * depth))

    depth = 1
    counts = rows.groupBy("of", cell(depth).alias("cell")).agg(F.count("*").alias("n")).withColumn("need", F.lit(size).cast("long"))
    while True:
        upto = F.sum("n").over(ahead)
        # the range that reaches the size: what it still has to give, and where it begins
        ends = durable(
            counts.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            .select("of", "cell", "n", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))
        )
        most = ends.agg(F.max("n")).first()[0] or 0
        if most <= max_rows or _STEP * depth >= _BITS:
            break
        inside = rows.select("of", cell(depth).alias("outer"), cell(depth + 1).alias("cell"))
        counts = (
            inside.groupBy("of", "outer", "cell")
            .agg(F.count("*").alias("n"))
            .join(ends.select("of", F.col("cell").alias("outer"), "need"), ["of", "outer"])
            .select("of", "cell", "n", "need")
        )
        depth += 1
    placed = rows.withColumn("cell", cell(depth)).join(
        ends.select("of", F.col("cell").alias("last"), "need"), "of", "left"
    )
    under = placed.where(F.col("last").isNull() | (F.col("cell") < F.col("last"))).select("row")
    rank = F.row_number().over(Window.partitionBy("of").orderBy("hash", "key"))
    at_end = placed.where(F.col("cell") == F.col("last")).withColumn("rank", rank).where(F.col("rank") <= F.col("need")).select("row")
    return under.union(at_end).select("row.*")
