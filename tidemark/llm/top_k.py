"""Exact search for the largest inner products, with bounds from a table of distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

#: Rows of a tile: evaluated together or not at all.
TILE_ROWS = 256
#: Distances are bounded with this share of the largest norm as room for rounding.
ROOM = 1e-6
_HITS = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, and only finite components."""
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )


def matrix(rows, width: int, kind=np.float64) -> np.ndarray:
    """Vectors as rows of one matrix; missing components count as zero."""
    out = np.zeros((len(rows), width), dtype=kind)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def exact_kind(norm: float):
    """The type in which products of vectors of this squared length are exact, partial sums included."""
    if norm < 2.0**24:
        return np.float32
    if norm < 2.0**53:
        return np.float64
    if norm < 2.0**63:
        return np.int64
    raise ValueError("vectors whose scaled squared length is beyond 2^63 have no 64-bit scores")


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots: each next one is the sampled vector farthest from those chosen."""
    chosen = [0]
    far = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(count, len(sample)):
        best = int(far.argmax())
        if far[best] == 0:
            break
        chosen.append(best)
        far = np.minimum(far, np.linalg.norm(sample - sample[best], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


class Best:
    """The ``k`` best ``(score, id)`` of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.query, self.score, self.ids = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = np.append(self.query, query), np.append(self.score, score), np.append(self.ids, ids)
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, dtype=np.int64)
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kept = place < self.k
        self.query, self.score, self.ids = query[kept], score[kept], ids[kept]
        last = place[kept] == self.k - 1
        self.floor[self.query[last]] = np.maximum(self.floor[self.query[last]], self.score[last])


def search(ids, x, d, own, q, dq, floor, k: int, room: float) -> tuple[Best, int]:
    """Top ``k`` of a block for queries with known lowest scores ``floor``; also the pairs evaluated.

    ``d`` and ``dq`` are distances to the pivots.  Rows are cut to tiles of near
    ones.  A query is at least as far from all rows of a tile as its distance to
    any pivot is outside of theirs, which bounds its scores.  Tiles are evaluated
    in the order of their best bounds, for the queries whose bound reaches their
    ``k``-th score, until none does.
    """
    order = np.lexsort((ids, d.min(axis=1), d.argmin(axis=1)))
    ids, x, d = ids[order], x[order], d[order]
    begin = np.arange(0, len(ids), TILE_ROWS)
    low, high = np.minimum.reduceat(d, begin) - room, np.maximum.reduceat(d, begin) + room
    wide = x.astype(np.float64)
    longest = np.maximum.reduceat((wide * wide).sum(axis=1), begin)
    lengths = (q.astype(np.float64) ** 2).sum(axis=1)
    bounds = np.empty((len(begin), len(q)))
    for t in range(len(begin)):
        away = np.maximum(dq - room - high[t], low[t] - dq - room).max(axis=1)
        bounds[t] = (lengths + longest[t] - np.maximum(away, 0) ** 2) / 2
    bounds = np.floor(bounds * (1 + 1e-12) + 1e-6)
    found, evaluated = Best(len(q), k, floor), 0
    waiting = [(np.empty(0, dtype=np.int64),) * 3]
    held = 0
    for t in np.argsort(-bounds.max(axis=1, initial=-np.inf), kind="stable").tolist():
        asking = np.flatnonzero(bounds[t] >= found.floor)
        if not len(asking):
            continue
        tile = slice(begin[t], begin[t] + TILE_ROWS)
        scores = q[asking] @ x[tile].T
        evaluated += scores.size
        who, where = np.nonzero(scores >= found.floor[asking][:, None])
        hit = (asking[who], scores[who, where].astype(np.int64), ids[tile][where])
        fresh = hit[2] != own[hit[0]]
        waiting.append(tuple(part[fresh] for part in hit))
        held += len(waiting[-1][0])
        if held > k * len(q):
            found.add(*(np.concatenate(part) for part in zip(*waiting, strict=True)))
            waiting, held = [], 0
    if waiting:
        found.add(*(np.concatenate(part) for part in zip(*waiting, strict=True)))
    return found, evaluated


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    pivots: int = 64,
    block_rows: int = 8192,
    query_rows: int = 4096,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` best rows for each query: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``; the score is the inner product, an
    exact integer.

    1. Pivot table: every row is written with its distances to all pivots, and
       dealt to blocks of near rows (by its nearest pivot; large cells are cut by a
       hash, small neighbours put together).  Queries are dealt to groups alike.
    2. Each block is searched for its own queries, which gives every query a
       ``k``-th score to start from.
    3. Blocks and groups are reduced to the ranges of their distances.  A block is
       sent only to groups of which some query could find that score in it; there
       tiles of the block are bounded for each query and evaluated, by one
       matrix product, in the order of their bounds until none reaches the
       ``k``-th score (see :func:`search`).

    The best of the blocks are merged.  A task holds one block and one group of
    bounded size, however many rows are alike.

    Pivots are picked from a sample of ``16 * pivots`` rows; they affect the work
    and not the result.  Ties go to the smaller number.  Vectors that are null or
    hold null or non-finite components take no part; shorter ones are filled with
    zeros; rows without a number take no part.  Of rows that repeat a number, all
    are candidates and the smallest vector asks.  Queries with fewer other rows
    than ``k`` get all.  Products are taken in a type that holds them exactly;
    squared lengths beyond 2^63 are an error.
    """
    spark = vectors.sparkSession
    x = F.col(vector)
    ready = vectors.where(F.col(vec_id).isNotNull() & usable(x)).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double")).alias("v"),
        is_query.alias("asks"),
    )
    facts = ready.agg(
        F.max(F.size("v")).alias("width"), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("norm")
    ).first()
    if facts["width"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, norm = facts["width"], facts["norm"]
    kind, room = exact_kind(norm * (1 + 1e-9)), ROOM * norm**0.5
    sample = ready.select("id", "v").orderBy(F.xxhash64("id"), "v").limit(16 * pivots).collect()
    corners = spread(matrix([r["v"] for r in sample], width), pivots)
    count = len(corners)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = distances(matrix(batch["v"], width), corners)
                yield batch.assign(near=d.argmin(axis=1).astype("int32"), d=list(d))

    table = durable(ready.mapInPandas(placed, "id long, v array<double>, asks boolean, near int, d array<double>"))
    queries = durable(table.where("asks").groupBy("id").agg(F.min(F.struct("v", "near", "d")).alias("q")).select("id", "q.*"))
    table = dealt(table, "b", block_rows, count, corners)
    queries = dealt(queries, "g", query_rows, count, corners)

    def columns(rows: pd.DataFrame):
        if not len(rows):
            return rows["id"].to_numpy(dtype=np.int64), np.zeros((0, width), kind), np.zeros((0, count))
        return rows["id"].to_numpy(), matrix(rows["v"], width).astype(kind), np.stack(rows["d"])

    def start(key, rows: pd.DataFrame) -> pd.DataFrame:
        asking = rows[rows["asks"]]
        own, q, dq = columns(asking)
        found, _ = search(*columns(rows), own, q, dq, np.full(len(own), -np.inf), k, room)
        return pd.DataFrame({"id": own, "floor": found.floor})

    # rows that repeat a number ask in several blocks: the largest score that k rows reach holds for the one that asks
    # only if there is one such row
    once = table.where("asks").groupBy("id").agg(F.count("*").alias("n")).where("n = 1").select("id")
    floors = (
        table.groupBy("b").applyInPandas(start, "id long, floor double").join(once, "id", "left_semi")
    )
    queries = durable(queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))

    def ranges(rows: DataFrame, key: str, *more: Column) -> DataFrame:
        ends = [f(F.get("d", F.lit(i))) for f in (F.min, F.max) for i in range(count)]
        length = F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
        return rows.groupBy(key).agg(
            F.array(*ends[:count]).alias("low"), F.array(*ends[count:]).alias("high"), length.alias("length"), *more
        )

    groups = durable(ranges(queries, "g", F.min("floor").alias("floor")))
    most = groups.agg(F.max("g")).first()[0]
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = ranges(table, "b").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(most))))
    gap = F.zip_with(F.col("x.low"), F.col("y.high"), lambda a, b: a - b), F.zip_with(F.col("y.low"), F.col("x.high"), lambda a, b: a - b)
    away = F.greatest(F.array_max(gap[0]), F.array_max(gap[1]), F.lit(2 * room)) - 2 * room
    bound = (F.col("x.length") + F.col("y.length") - away * away) / 2
    pairs = durable(
        blocks.alias("x").join(groups.alias("y"), "g").where(bound * (1 + 1e-12) + 1e-6 >= F.col("y.floor")).select("b", "g")
    )

    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if block.empty or asking.empty:
            return pd.DataFrame(columns=["query_id", "vec_id", "score"], dtype="int64")
        own, q, dq = columns(asking)
        found, _ = search(*columns(block), own, q, dq, asking["floor"].to_numpy(), k, room)
        return pd.DataFrame({"query_id": own[found.query], "vec_id": found.ids, "score": found.score})

    candidates = table.select("b", "id", "v", "d").join(pairs, "b")
    asking = queries.select("g", "id", "v", "d", "floor").join(pairs, "g")
    hits = candidates.groupBy("b", "g").cogroup(asking.groupBy("b", "g")).applyInPandas(meet, _HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def dealt(rows: DataFrame, name: str, size: int, count: int, corners: np.ndarray) -> DataFrame:
    """Add ``name``, a block of about ``size`` rows whose nearest pivots are the same or neighbours.

    Cells are taken along a chain of near pivots.  The number of rows of each
    cell, a few counts, decides which are put together and which are cut by a hash.
    """
    held = {r["near"]: r["n"] for r in rows.groupBy("near").agg(F.count("*").alias("n")).collect()}
    chain, left = [0], set(range(1, count))
    while left:
        chain.append(min(left, key=lambda p: float(np.linalg.norm(corners[p] - corners[chain[-1]]))))
        left.remove(chain[-1])
    first, pieces, number, filled = [0] * count, [1] * count, -1, size
    for cell in chain:
        n = held.get(cell, 0)
        if n > size:
            first[cell], pieces[cell] = number + 1, -(-n // size)
            number, filled = number + pieces[cell], size
        elif n:
            if filled + n > size:
                number, filled = number + 1, 0
            first[cell], filled = number, filled + n
    of_cell = [F.element_at(F.array(*map(F.lit, values)), F.col("near") + 1) for values in (first, pieces)]
    return rows.withColumn(name, (of_cell[0] + F.pmod(F.xxhash64("id", "v"), of_cell[1])).cast("int"))
