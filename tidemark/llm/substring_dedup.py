"""Substring deduplication: repeats of at least ``length`` words stay in the first document only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, durable, scratch_path
from .common import over_text, steps, text_key, without
from .words import PLACES, Words, grams, mixed, signed, starts

#: Occurrences that one Arrow batch holds.
CHUNK = 1 << 16

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("repeats", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("kept_text", T.StringType()),
    ]
)


def seeds_of(hashes: np.ndarray, bounds: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts, and the place of the seed that each window selects.

    Winnowing: a window selects the first of its smallest ``seed``-word hashes,
    so equal windows select equal seeds, wherever they stand.
    """
    begin = np.flatnonzero(starts(bounds, length))
    if not len(begin):
        return begin, begin
    values = grams(hashes, seed)
    span = length - seed + 1
    best, at = values[begin], np.zeros(len(begin), dtype=np.int64)
    for i in range(1, span):
        other = values[begin + i]
        less = other < best
        best = np.where(less, other, best)
        at[less] = i
    return begin, begin + at


class Side:
    """Word hashes on one side of many anchors, the word next to the anchor first, as an Arrow column of bytes."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.begin = np.cumsum(sizes) - sizes

    @classmethod
    def read(cls, column) -> Side:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        values = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.empty(0, np.uint8)
        return cls(np.frombuffer(values.tobytes(), np.uint64), np.diff(ends).astype(np.int64) // 8)

    @classmethod
    def around(cls, hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray, step: int) -> Side:
        """``sizes`` words from the places ``first`` on, read to the right (1) or to the left (-1)."""
        begin = np.cumsum(sizes) - sizes
        inside = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
        return cls(hashes[np.repeat(first, sizes) + step * inside], sizes)

    def column(self) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(self.sizes) * 8]).astype(np.int32)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.values))]
        return pa.Array.from_buffers(pa.binary(), len(self.sizes), buffers)

    def table(self, width: int) -> np.ndarray:
        """One row per anchor; places beyond its words are 0."""
        out = np.zeros((len(self.sizes), width), np.uint64)
        held = np.arange(width)[None, :] < self.sizes[:, None]
        out[held] = self.values
        return out

    def part(self, rows: np.ndarray, skip: np.ndarray, end: np.ndarray) -> Side:
        """Words ``skip`` to ``end`` of the anchors ``rows``."""
        return Side.around(self.values, self.begin[rows] + skip, end - skip, 1)


def agreeing(ours: Side, other: Side, width: int) -> np.ndarray:
    """How many words from the anchor on are equal on both."""
    inside = np.arange(width)[None, :] < np.minimum(ours.sizes, other.sizes)[:, None]
    return np.logical_and.accumulate((ours.table(width) == other.table(width)) & inside, axis=1).sum(axis=1)


#: An occurrence of an anchor: the windows that chose it begin ``low`` to ``high`` words before it.  ``known_left`` and
#: ``known_right`` words beside the anchor are part of ``key``; ``left`` and ``right`` hold the further words of these windows.
OCCURRENCE = (
    "key long, doc long, row long, at int, low int, high int, known_left int, known_right int, left binary, right binary"
)


def extend(batch: pa.RecordBatch, reach: int) -> pa.RecordBatch:
    """Follow every occurrence of a batch to both sides against the leader of its key.

    Returns the stretches of window starts that agree (``begin`` to ``end``, for
    documents above the leader's) and, where a third occurrence may agree with
    it, the other windows as occurrences of longer keys: those that differ on
    the right by their first differing word there, the others by that on the
    left.  Equal windows get equal keys, as they meet the same leader.
    """
    def numbers(name):
        return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)

    low, high, at = numbers("low"), numbers("high"), numbers("at")
    known_left, known_right = numbers("known_left"), numbers("known_right")
    left, right = Side.read(batch.column("left")), Side.read(batch.column("right"))
    to_left = known_left + agreeing(left, Side.read(batch.column("lead_left")), reach)
    to_right = known_right + agreeing(right, Side.read(batch.column("lead_right")), reach)
    key = np.ascontiguousarray(numbers("key")).view(np.uint64)
    least, most = np.maximum(low, reach - to_right), np.minimum(high, to_left)
    hit = np.flatnonzero((least <= most) & (numbers("doc") > numbers("lead_doc")))
    open_ = numbers("several") > 0
    by_right = np.flatnonzero(open_ & (low < reach - to_right))
    by_left = np.flatnonzero(open_ & (np.maximum(least, to_left + 1) <= high))
    ends = np.minimum(high, reach - to_right - 1)[by_right]
    from_left = np.maximum(least, to_left + 1)[by_left]

    def longer(rows, side, words, place, known):
        word = words.values[words.begin[rows] + (place - known)[rows]]
        return signed(mixed(key[rows] * PLACES[0][0] + word * PLACES[0][1] + (2 * place[rows] + side).astype(np.uint64)))

    none = pa.nulls(len(hit))
    picked = pa.array(np.concatenate([hit, by_right, by_left]))
    sides = [
        pa.concat_arrays([none.cast(pa.binary()), a.column(), b.column()])
        for a, b in (
            (
                left.part(by_right, 0 * by_right, np.maximum(ends - known_left[by_right], 0)),
                left.part(by_left, (to_left + 1 - known_left)[by_left], (high - known_left)[by_left]),
            ),
            (
                right.part(by_right, (to_right + 1 - known_right)[by_right], (reach - low - known_right)[by_right]),
                right.part(by_left, 0 * by_left, np.maximum(reach - from_left - known_right[by_left], 0)),
            ),
        )
    ]

    def whole(of_hits, of_right, of_left, kind=pa.int32()):
        parts = [none.cast(kind) if of_hits is None else pa.array(of_hits).cast(kind)]
        parts += [pa.nulls(n, kind) if x is None else pa.array(x).cast(kind) for x, n in ((of_right, len(by_right)), (of_left, len(by_left)))]
        return pa.concat_arrays(parts)

    columns = {
        "key": whole(None, longer(by_right, 1, right, to_right, known_right), longer(by_left, 0, left, to_left, known_left), pa.int64()),
        "doc": batch.column("doc").take(picked),
        "row": batch.column("row").take(picked),
        "at": batch.column("at").take(picked),
        "low": whole(None, low[by_right], from_left),
        "high": whole(None, ends, high[by_left]),
        "known_left": whole(None, known_left[by_right], to_left[by_left] + 1),
        "known_right": whole(None, to_right[by_right] + 1, known_right[by_left]),
        "left": sides[0],
        "right": sides[1],
        "begin": whole((at - most)[hit], None, None),
        "end": whole((at - least)[hit], None, None),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = batch.column("t").to_pylist()
        for part in steps(texts):
            yield batch.slice(part.start, part.stop - part.start), texts[part]


def dedup_substrings(
    docs: DataFrame,
    length: int = 13,
    seed: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Remove word sequences of at least ``length`` words that a smaller document holds too.

    Adds ``n_words``, ``n_removed``, ``repeats`` (maximal removed runs as
    ``[first word, end]``) and ``kept_text`` (the other words, joined by one
    space).

    1. Anchors: every window of ``length`` words selects its smallest
       ``seed``-word hash.  Anchors found in more than one document are the
       seeds; their documents are counted with map-side combination.
    2. Extension: every occurrence of a seed is joined with one other, that of
       the smallest document (the leader), and followed to both sides word by
       word (64-bit hashes), as far as windows reach that selected the seed.
       Windows that agree are in the leader's document.  The others meet each
       other again under a longer key, the seed with the word that differed, and
       the smallest document of that leads.  A window has ``length - seed``
       words beside its seed and each round settles one more, so rounds end.
    3. Stretches that agree are united to maximal repeats and cut out of the
       text.

    Every occurrence is in one pair a round, so pairs grow with the text and not
    with the square of a passage's frequency.  All joins are equi-joins, which
    Spark can split where one key holds a large part of the rows.

    Null and empty texts have no words and give the empty text.  Rows without a
    document number neither lose words nor take any from others; rows that
    repeat a number never take words from each other.
    """
    spark = docs.sparkSession
    docs = without(docs, RESULT.names)
    source = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc"), text_key(text).alias("row"), F.col(text).cast("binary").alias("t")
    ).where("t is not null")

    def anchors(batches):
        for batch, texts in _batches(batches):
            words = Words.of(texts)
            hashes = words.hashes()
            begin, place = seeds_of(hashes, words.bounds, length, seed)
            place = np.unique(place)
            owner = words.owners()[place]
            pairs = np.stack([owner, signed(grams(hashes, seed)[place])], axis=1) if len(place) else np.empty((0, 2), np.int64)
            pairs, count = np.unique(pairs, axis=0, return_counts=True)
            picked = batch.select(["doc", "row"]).take(pa.array(pairs[:, 0]))
            columns = [*picked.columns, pa.array(pairs[:, 1]), pa.array(count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "row", "anchor", "n"])

    anchor_path = scratch_path(spark, "anchors")
    found = durable(source.mapInArrow(anchors, "doc long, row long, anchor long, n int"), anchor_path)
    # Leaders are unique: rows that repeat a number differ in the hash of their text, equal rows are read once.
    shared = (
        found.groupBy("anchor")
        .agg(F.min(F.struct("doc", "row")).alias("lead"), F.max("doc").alias("last"), F.sum("n").alias("n"))
        .where("lead.doc < last")
    )
    # Tables of their own: beside an aggregate Spark could not split the hot side of the join.
    shared = durable(shared.select("anchor", "lead", (F.col("n") > 2).alias("several")))
    leads = (F.col("doc") == F.col("lead.doc")) & (F.col("row") == F.col("lead.row"))
    seeds = durable(
        found.drop("n").join(shared, "anchor")
        .groupBy("doc", "row")
        .agg(
            F.collect_set("anchor").alias("anchors"),
            F.collect_set(F.when(leads, F.col("anchor"))).alias("leading"),
            F.collect_set(F.when(leads & F.col("several"), F.col("anchor"))).alias("open"),
        )
    )
    drop_scratch(spark, [anchor_path])
    reach = length - seed

    def occurrences(batches):
        for batch, texts in _batches(batches):
            words = Words.of(texts)
            hashes = words.hashes()
            begin, place = seeds_of(hashes, words.bounds, length, seed)
            place, first, count = np.unique(place, return_index=True, return_counts=True)
            if not len(place):
                continue
            owner, anchor = words.owners()[place], grams(hashes, seed)[place]
            name = _pair(owner, anchor)
            wanted = np.isin(name, _listed(batch.column("anchors")))
            place, first, count, owner, anchor, name = (x[wanted] for x in (place, first, count, owner, anchor, name))
            once = np.zeros(len(name), dtype=bool)
            once[np.unique(name, return_index=True)[1]] = True
            leading = once & np.isin(name, _listed(batch.column("leading")))
            several = np.isin(name, _listed(batch.column("open")))
            high = place - begin[first]
            low = high - count + 1
            for x in range(0, len(place), CHUNK):
                y = slice(x, x + CHUNK)
                picked = batch.select(["doc", "row"]).take(pa.array(owner[y]))
                zero = np.zeros(len(place[y]), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(anchor[y])),
                        *picked.columns,
                        pa.array((place - words.bounds[owner])[y].astype(np.int32)),
                        pa.array(low[y].astype(np.int32)),
                        pa.array(high[y].astype(np.int32)),
                        pa.array(zero),
                        pa.array(zero),
                        Side.around(hashes, place[y] - 1, high[y], -1).column(),
                        Side.around(hashes, place[y] + seed, reach - low[y], 1).column(),
                        pa.array(leading[y]),
                        pa.array(several[y]),
                    ],
                    names=[*(c.split()[0] for c in OCCURRENCE.split(", ")), "leading", "several"],
                )

    def extended(batches):
        for batch in batches:
            if batch.num_rows:
                yield extend(batch, reach)

    once = source.groupBy("doc", "row").agg(F.first("t").alias("t"))
    paths = [scratch_path(spark, "occurrences")]
    marked = durable(
        once.join(seeds, ["doc", "row"])
        .select("doc", "row", "t", "anchors", "leading", "open")
        .mapInArrow(occurrences, OCCURRENCE + ", leading boolean, several boolean"),
        paths[0],
    )
    agreed = []
    for _ in range(reach + 1):
        # the leader tells whether a third occurrence exists
        leaders = marked.where("leading").select(
            "key", F.col("doc").alias("lead_doc"), F.col("left").alias("lead_left"), F.col("right").alias("lead_right"), F.col("several").cast("int").alias("several")
        )
        pairs = marked.where("not leading").drop("leading", "several").join(leaders, "key")
        followed = durable(pairs.mapInArrow(extended, OCCURRENCE + ", begin int, end int"))
        drop_scratch(spark, paths)
        agreed.append(followed.where("begin is not null").select("doc", "row", "begin", "end"))
        left = followed.where("key is not null").drop("begin", "end")
        shared = (
            left.groupBy("key")
            .agg(F.min(F.struct("doc", "row", "at")).alias("lead"), F.max("doc").alias("last"), F.count("*").alias("n"))
            .where("lead.doc < last")
        )
        shared = durable(shared.select("key", "lead", (F.col("n") > 2).alias("several")))
        if shared.isEmpty():
            break
        paths = [scratch_path(spark, "occurrences")]
        marked = durable(
            left.join(shared, "key")
            .withColumn("leading", F.struct("doc", "row", "at") == F.col("lead"))
            .drop("lead"),
            paths[0],
        )
    removed = agreed[0]
    for more in agreed[1:]:
        removed = removed.unionByName(more)
    removed = durable(removed.groupBy("doc", "row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("starts")))

    # the input travels as one struct, so that its columns may have any names
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input"), F.col(doc_id).cast("long").alias("doc"), text_key(text).alias("row")
    )
    marked = whole.join(removed, ["doc", "row"], "left").select("input", F.col(f"input.`{text}`").alias("t"), "starts")

    def cut(texts, starts_of):
        out = {n: [] for n in RESULT.names}
        for one, at in zip(texts, starts_of, strict=True):
            words = one.split()
            runs = []
            for stretch in at or ():
                begin, end = stretch["begin"], stretch["end"] + length
                if runs and begin <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([begin, end])
            kept, end = [], 0
            for a, b in runs:
                kept += words[end:a]
                end = b
            kept += words[end:]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["repeats"].append(runs)
            out["kept_text"].append(b" ".join(kept).decode())
        return out

    done = over_text(marked, cut, RESULT, "t", keep=["input"], extra=["starts"])
    return done.select("input.*", *RESULT.names)


def _pair(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One number for a text of the step and an anchor."""
    return mixed(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) ^ value


def _listed(column) -> np.ndarray:
    """The anchors listed for each text of the step, as :func:`_pair` names them."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).view(np.uint64)
    return _pair(np.repeat(np.arange(len(column)), sizes), values)
