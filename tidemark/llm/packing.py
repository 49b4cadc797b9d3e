"""Best-fit packing of token sequences in rounds: local packing, then underfull bins as items."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .tokens import Encoder

PIECE = "struct<id:long,row:long,piece:int,start:long,length:int,ids_crc32:long>"
BINS = f"bin long, fill int, members array<{PIECE}>"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the fullest bin that still holds it.

    Bins are kept by free space; ties go to the bin opened first.
    """
    order = np.argsort(-sizes, kind="stable")
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []
    for i in order.tolist():
        size = int(sizes[i])
        at = bisect_left(free, (size, -1))
        if at < len(free):
            space, b = free.pop(at)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if space > size:
            insort(free, (space - size, b))
    return bins


def pieces_of(
    docs: DataFrame, path: str, capacity: int, doc_id: str = "doc_id", text: str = "text", end_id: int = 0
) -> DataFrame:
    """Token pieces of every document: ``id, row, piece, start, length, ids_crc32``.

    ``row`` tells rows apart that repeat a number.  A null text is empty: one
    piece that holds ``end_id`` alone.

    A document longer than ``capacity`` is cut from its end on, so only its first
    piece is shorter than ``capacity``.
    """
    encoder = Encoder(path)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, row, one in zip(batch["id"], batch["row"], batch["t"], strict=True):
                ids = np.append(encoder.ids(one or ""), np.uint32(end_id)).astype("<u4")
                head = len(ids) % capacity or capacity
                edges = [0, *range(head, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    out.append((doc, row, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            yield pd.DataFrame(out, columns=["id", "row", "piece", "start", "length", "ids_crc32"]).astype(
                {"id": "Int64", "row": "int64"}
            )

    source = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("t")
    )
    return source.mapInPandas(cut, "id long, row long, piece int, start long, length int, ids_crc32 long")


def pack(
    pieces: DataFrame,
    capacity: int = 2048,
    nearly_full: int | None = None,
    group_items: int = 50_000,
    fan_in: int = 8,
) -> DataFrame:
    """Pack pieces into bins of ``capacity``; adds ``sequence_id`` and ``offset``.

    Pieces are dealt to groups of about ``group_items`` by a hash (so the groups
    are even and a repeated task packs the same way) and packed best-fit
    decreasing in each.  Bins filled to ``nearly_full`` (default: capacity less
    one 64th) are final.  The others are items of the next round, in which
    ``fan_in`` groups meet; the last round has one group.

    Best-fit leaves at most one bin of a group half empty, and only a half-empty
    bin can go into another.  So a group of a later round has at most ``fan_in``
    items that move, and of bins that are filled alike at most ``fan_in`` a round
    can take one in.  Of those only as many are passed on as the rounds to come
    could use: the result needs no others, and a group's size has a bound that
    does not depend on the input.

    Each round is a table in shared storage.  An empty input gives an empty result.
    """
    limit = capacity - capacity // 64 if nearly_full is None else nearly_full
    pieces = durable(pieces)
    total = pieces.where(F.col("length") < capacity).count()
    groups = max(1, -(-total // group_items))

    def packer(rounds: int):
        """Packs a group; ``rounds`` are still to come."""

        def run(items: pd.DataFrame) -> pd.DataFrame:
            items = items.sort_values(["fill", "bin"], ascending=[False, True], kind="stable").reset_index(drop=True)
            fills, bins, members = items["fill"].to_numpy(), items["bin"].tolist(), items["members"].tolist()
            out, alike = [], Counter()
            for packed in best_fit(fills, capacity):
                fill = int(fills[packed].sum())
                alike[fill] += 1
                is_open = fill < limit and alike[fill] <= fan_in * rounds
                out.append((int(items["grp"][0]), bins[packed[0]], fill, [m for i in packed for m in members[i]], is_open))
            return pd.DataFrame(out, columns=["grp", "bin", "fill", "members", "open"])

        return run

    schema = "grp long, " + BINS + ", open boolean"
    key = F.xxhash64("id", "row", "piece")
    items = pieces.where(F.col("length") < capacity).select(
        F.pmod(key, F.lit(groups)).alias("grp"),
        F.xxhash64(F.lit("bin"), "id", "row", "piece").alias("bin"),
        F.col("length").alias("fill"),
        F.array(F.struct("id", "row", "piece", "start", "length", "ids_crc32")).alias("members"),
    )
    final = [
        pieces.where(F.col("length") == capacity).select(
            F.xxhash64(F.lit("bin"), "id", "row", "piece").alias("bin"),
            F.col("length").alias("fill"),
            F.array(F.struct("id", "row", "piece", "start", "length", "ids_crc32")).alias("members"),
        )
    ]
    while True:
        rounds, left = 0, groups
        while left > 1:
            rounds, left = rounds + 1, -(-left // fan_in)
        bins = durable(items.groupBy("grp").applyInPandas(packer(rounds), schema))
        final.append(bins.where("not open").select("bin", "fill", "members"))
        if groups == 1:
            break
        groups = -(-groups // fan_in)
        items = bins.where("open").select(F.floor(F.col("grp") / fan_in).alias("grp"), "bin", "fill", "members")
    done = final[0]
    for more in final[1:]:
        done = done.unionByName(more)
    lengths = F.transform("members", lambda m: m["length"])
    placed = done.select(
        F.col("bin").alias("sequence_id"), "members", lengths.alias("lengths")
    ).select("sequence_id", "lengths", F.posexplode("members").alias("place", "m"))
    offset = F.aggregate(F.slice("lengths", F.lit(1), F.col("place")), F.lit(0).cast("long"), lambda a, x: a + x)
    return placed.select("m.*", "sequence_id", offset.alias("offset"))
