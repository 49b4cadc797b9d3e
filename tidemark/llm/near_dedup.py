"""Near-duplicate classes by order MinHash and banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_scratch, durable, scratch_path, scratch_scope
from .common import steps
from .words import PLACES, Words, grams, mixed, signed

_MARKS = re.compile(r"[^\w\s]|_")
_SEEDS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def plain(text: bytes) -> bytes:
    """Lower case, without marks; a text of marks alone stays as it is."""
    out = _MARKS.sub("", text.decode().lower()).encode()
    return out if out.split() else text


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words from each place on, in text order, and each text's bounds.

    A text of fewer words is one shingle; a text without words has none.
    """
    words = Words.of([plain(t) for t in texts])
    hashes, counts = words.hashes(), words.counts()
    all_grams = grams(hashes, size)
    number = np.where(counts == 0, 0, np.maximum(1, counts - size + 1))
    bounds = np.concatenate([[0], np.cumsum(number)])
    out = np.empty(int(bounds[-1]), dtype=np.uint64)
    long = np.flatnonzero(counts >= size)
    owner = np.repeat(np.arange(len(texts)), number)
    is_long = np.isin(owner, long)
    place = np.arange(len(out)) - bounds[:-1][owner] + words.bounds[:-1][owner]
    out[is_long] = all_grams[place[is_long]]
    for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        few = hashes[words.bounds[i] : words.bounds[i + 1]]
        out[bounds[i]] = mixed((few * PLACES[1][: len(few)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(few)))[0]
    return out, bounds


def labelled(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence in their text, as one hash: a repeated one counts anew."""
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, owner))
    ranked, who = values[order], owner[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (ranked[1:] != ranked[:-1]) | (who[1:] != who[:-1])
    run = np.maximum.accumulate(np.where(fresh, np.arange(len(values)), 0))
    occurrence = np.empty(len(values), dtype=np.uint64)
    occurrence[order] = (np.arange(len(values)) - run).astype(np.uint64)
    return mixed(values + occurrence * np.uint64(0xD6E8FEB86659FD93))


def order_min_hash(values: np.ndarray, bounds: np.ndarray, sketches: int, each: int) -> np.ndarray:
    """Sketches of every text that has shingles (all of them must): a row per text.

    Shingles are labelled by their occurrence, so a repeated one counts anew.
    Each sketch takes the ``each`` smallest labelled hashes and hashes the
    shingles in the order of the text.
    """
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    tagged = labelled(values, bounds)
    out = np.empty((len(counts), sketches), dtype=np.uint64)
    for j in range(sketches):
        h = mixed(tagged ^ _SEEDS[j])
        picks = np.empty((each, len(counts)), dtype=np.int64)
        for t in range(each):
            least = np.minimum.reduceat(h, bounds[:-1])
            at = np.flatnonzero(h == np.repeat(least, counts))
            _, first = np.unique(owner[at], return_index=True)
            picks[t] = at[first]
            h[picks[t]] = _TOP
        picks.sort(axis=0)
        total = np.full(len(counts), _SEEDS[j])
        for t in range(each):
            total += values[picks[t]] * PLACES[0][t]
        out[:, j] = mixed(total)
    return out


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of a longest common subsequence, followed within ``band`` places of the diagonal.

    Bit ``j`` of ``row`` is clear where the length grows at place ``j``; the row of
    the next element comes from additions on whole rows.
    """
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    low, high = 0, min(len(b), band + 1)
    row, left = (1 << high) - 1, 0
    for i, x in enumerate(a):
        bottom, top = max(0, i - band), min(len(b), i + band + 1)
        if bottom > low:
            gone = bottom - low
            left += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
            low = bottom
        if top > high:
            row |= ((1 << (top - high)) - 1) << (high - low)
            high = top
        hits = 0
        for j in where.get(x, ()):
            if low <= j < high:
                hits |= 1 << (j - low)
        if hits:
            both = row & hits
            row = ((row + both) | (row - both)) & ((1 << (high - low)) - 1)
    return left + (high - low) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Common subsequence of two shingle sequences over their union; 0 if it is surely below ``least``."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    short = min(n, m)
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    same = a[n - short + head :][::-1] == b[m - short + head :][::-1]
    tail = len(same) if same.all() else int(np.argmin(same))
    x, y = a[head : n - tail], b[head : m - tail]
    common = head + tail
    kx, cx = np.unique(x, return_counts=True)
    ky, cy = np.unique(y, return_counts=True)
    _, ix, iy = np.intersect1d(kx, ky, assume_unique=True, return_indices=True)
    if common + int(np.minimum(cx[ix], cy[iy]).sum()) < need:
        return 0.0
    common += aligned(x.tolist(), y.tolist(), max(1, n + m - 2 * need))
    value = common / (n + m - common)
    return value if value >= least - 1e-12 else 0.0


def links_between(
    docs: list[int], groups: list[int], is_pivot: list[bool], texts: list[bytes], size: int, least: float
) -> list[tuple[int, int, float]]:
    """Links that join the groups of pivots with other groups of a cell: ``a, b, score``.

    Every pair of a pivot and a document of another group is aligned, unless the
    labelled shingles they share are too few for ``least`` whatever their order,
    or links found here have already joined their groups.
    """
    order = sorted(range(len(docs)), key=lambda i: (docs[i], texts[i], not is_pivot[i]))
    order = [i for k, i in enumerate(order) if not k or (docs[i], texts[i]) != (docs[order[k - 1]], texts[order[k - 1]])]
    values, bounds = shingles([texts[i] for i in order], size)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return []
    order, bounds = [order[k] for k in full.tolist()], np.append(bounds[full], bounds[-1])
    docs, is_pivot = [docs[i] for i in order], np.array([is_pivot[i] for i in order])
    group = np.array([groups[i] for i in order])
    numbers = np.diff(bounds)
    _, codes = np.unique(labelled(values, bounds), return_inverse=True)
    held = np.zeros(len(codes), dtype=np.int32)
    links = []
    for i in np.flatnonzero(is_pivot).tolist():
        if (group == group[i]).all():
            break
        own = codes[bounds[i] : bounds[i + 1]]
        held[own] = 1
        shared = np.add.reduceat(held[codes], bounds[:-1])
        held[own] = 0
        near = shared >= least * (numbers[i] + numbers - shared) - 1e-9
        near &= group != group[i]
        near[:i] &= ~is_pivot[:i]  # a pair of pivots is met once
        for k in sorted(np.flatnonzero(near).tolist(), key=lambda k: (-int(shared[k]), k)):
            if group[k] == group[i]:
                continue
            a, b = min(i, k), max(i, k)
            score = similarity(values[bounds[a] : bounds[a + 1]], values[bounds[b] : bounds[b + 1]], least)
            if score >= least - 1e-12:
                links.append((docs[a], docs[b], score))
                group[group == group[k]] = group[i]
    return links


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links ``a, b`` lead to, for every node of a link.

    Labels go along links and then jump to their label's label; each round is a
    table in shared storage that replaces the one before, and the end is when no
    label has changed.
    """
    spark = edges.sparkSession
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    path = scratch_path(spark, "labels")
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), path)
    while True:
        further_path = scratch_path(spark, "labels")
        with scratch_scope(spark):
            near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
            met = durable(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
            if met.where("label <> old").isEmpty():
                return labels
            jump = met.select(F.col("node").alias("label"), F.col("label").alias("further"))
            labels = durable(met.join(jump, "label", "left").select("node", F.coalesce("further", "label").alias("label")), further_path)
        drop_scratch(spark, [path])
        path = further_path


def near_classes(
    docs: DataFrame,
    least: float = 0.8,
    size: int = 5,
    sketches: int = 16,
    each: int = 3,
    small: int = 16,
    cell_shingles: int = 200_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, class_id, n_links``: the class of every document number, named by its smallest member.

    Words are compared in lower case and without marks.  Two documents are linked
    if the longest common subsequence of their ``size``-word shingles is at least
    ``least`` of the union (an edit similarity that also bounds the Jaccard
    similarity of the labelled shingles from below).

    1. Documents with equal words are one class at once; the smallest stands for it.
    2. Each sketch (order MinHash, ``each`` shingles) is a bucket, together with a
       length class; similar lengths share one of two classes.
    3. In a bucket of up to ``small`` documents all are compared.  In a larger one
       all are compared with the smallest; if some do not match it, the whole
       bucket is dealt anew by the next sketch as well, then by the next two,
       four and so on, until every bucket is small or matches its smallest member
       (or all sketches agree; then all are compared).
    4. Candidates are verified by alignment in a band as wide as ``least`` allows.
    5. Classes are the connected components of the links.  First buckets of more
       than ``small`` documents that hold several classes by then are opened once
       more, those with the same largest class together: every document outside
       that class is compared with all of the other classes, in cells of about
       ``cell_shingles`` shingles a side, so no two documents of a bucket stay
       apart without a comparison.  The number of shared shingles rules most pairs
       out before alignment.

    ``n_links`` counts verified links of the document's representative.  Two
    documents at the threshold share none of 16 sketches with probability 1e-5.

    Texts without words (null, empty, blank) have equal words and are one class.
    Rows without a number take no part.  Rows that repeat a number are one document.

    Two tables are left when the classes are found, those that the result reads.
    """
    source = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("t")
    )
    spark = docs.sparkSession
    stands_path, labels_path = scratch_path(spark, "stands"), scratch_path(spark, "classes")
    with scratch_scope(spark):
        stands, of_rep = _classified(source, stands_path, labels_path, least, size, sketches, each, small, cell_shingles)
    classes = (
        stands.join(of_rep, "rep", "left")
        .groupBy("doc")
        .agg(F.min(F.coalesce("label", "rep")).alias("class_id"), F.max(F.coalesce("n_links", F.lit(0))).alias("n_links"))
    )
    return classes.select(F.col("doc").alias("doc_id"), "class_id", "n_links")


def _classified(
    source: DataFrame,
    stands_path: str,
    labels_path: str,
    least: float,
    size: int,
    sketches: int,
    each: int,
    small: int,
    cell_shingles: int,
) -> tuple[DataFrame, DataFrame]:
    """The steps of :func:`near_classes`: ``doc, rep``, and ``rep, label, n_links`` of those with links."""
    names = ["doc", "n", "e1", "e2", "sketches"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for part in steps(texts):
                docs_here = batch.column("doc").slice(part.start, part.stop - part.start)
                values, bounds = shingles(texts[part], size)
                full = np.flatnonzero(np.diff(bounds))
                bare = docs_here.take(pa.array(np.flatnonzero(np.diff(bounds) == 0)))
                zeros = pa.array(np.zeros(len(bare), dtype=np.int64))
                none = pa.array([[]] * len(bare), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([bare, zeros.cast(pa.int32()), zeros, zeros, none], names=names)
                if not len(full):
                    continue
                edges = np.append(bounds[full], bounds[-1])
                rows = order_min_hash(values, edges, sketches, each)
                place = np.arange(len(values)) - np.repeat(edges[:-1], np.diff(edges))
                spread_out = mixed(np.arange(1, int(place.max()) + 2, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))[place]
                e1 = np.add.reduceat(mixed(values ^ spread_out), edges[:-1])
                e2 = np.add.reduceat(mixed(values + spread_out) * np.uint64(0xFF51AFD7ED558CCD), edges[:-1])
                flat = pa.array(signed(np.ascontiguousarray(rows).ravel()))
                offsets = pa.array(np.arange(len(full) + 1, dtype=np.int32) * sketches)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs_here.take(pa.array(full)),
                        pa.array(np.diff(edges).astype(np.int32)),
                        pa.array(signed(e1)),
                        pa.array(signed(e2)),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    names=names,
                )

    is_link = F.col("score") >= least - 1e-12
    seen = durable(source.mapInArrow(sketch, "doc long, n int, e1 long, e2 long, sketches array<long>"))
    firsts = durable(seen.groupBy("n", "e1", "e2").agg(F.min("doc").alias("rep")))
    stands = durable(seen.select("doc", "n", "e1", "e2").join(firsts, ["n", "e1", "e2"]).select("doc", "rep"), stands_path)

    length_class = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / least))).cast("int")
    reps = seen.join(firsts.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
    members = reps.where("n > 0").select("doc", "n", length_class.alias("len"), F.posexplode("sketches").alias("j", "s")).select(
        "doc", "n", F.explode(F.array(F.col("len"), F.col("len") + 1)).alias("len"), "j", "s"
    )
    members = members.groupBy(F.xxhash64("len", "j", "s").alias("bucket"), "j", "doc").agg(F.max("n").cast("long").alias("n"))
    members = durable(members)
    sketch_of = reps.select("doc", "sketches")
    wanted = durable(
        members.groupBy("bucket").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("bucket")
    )
    members = durable(members.join(wanted, "bucket"))
    texts = durable(source.join(durable(members.select("doc").distinct()), "doc"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_texts, b_texts = batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist()
            scores = []
            for part in steps(b_texts):
                a_values, a_bounds = shingles(a_texts[part], size)
                b_values, b_bounds = shingles(b_texts[part], size)
                for i in range(part.stop - part.start):
                    a = a_values[a_bounds[i] : a_bounds[i + 1]]
                    scores.append(similarity(a, b_values[b_bounds[i] : b_bounds[i + 1]], least))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(scores, pa.float64())], names=["a", "b", "score"]
            )

    tested: list[DataFrame] = []

    def all_tested() -> DataFrame:
        return reduce(DataFrame.union, tested)

    depth, whole = 1, None
    while True:
        sizes = durable(members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("doc").alias("first")).where("size > 1"))
        is_small = (F.col("size") <= small) | F.lit(depth >= sketches)
        placed = durable(members.join(sizes, "bucket").withColumn("is_small", is_small))
        whole = placed.where("not is_small").select("bucket", "doc", "n") if whole is None else whole
        every = placed.where("is_small").select("bucket", F.col("doc").alias("pivot"))
        star = placed.where("not is_small").select(F.col("first").alias("a"), F.col("doc").alias("b"))
        among = placed.where("is_small").join(every, "bucket").where("pivot < doc").select(F.col("pivot").alias("a"), F.col("doc").alias("b"))
        pairs = star.where("a <> b").union(among).distinct()
        if tested:
            pairs = pairs.join(all_tested().select("a", "b"), ["a", "b"], "left_anti")
        scored = (
            durable(pairs)
            .join(texts.select(F.col("doc").alias("b"), F.col("t").alias("b_text")), "b")
            .join(texts.select(F.col("doc").alias("a"), F.col("t").alias("a_text")), "a")
            .select("a", "b", "a_text", "b_text")
        )
        tested.append(durable(scored.mapInArrow(verify, "a long, b long, score double")))
        if depth >= sketches:
            break
        matched = all_tested().where(is_link).select(F.col("a").alias("first"), F.col("b").alias("doc"))
        large = placed.where("not is_small")
        unsettled = durable(large.where("doc <> first").join(matched, ["first", "doc"], "left_anti").select("bucket").distinct())
        if unsettled.isEmpty():
            break
        further = F.transform(F.sequence(F.lit(depth), F.lit(2 * depth - 1)), lambda i: F.get("sketches", (F.col("j") + i) % sketches))
        # one row per document meets its sketches, however many buckets it is in
        moved = large.join(unsettled, "bucket").groupBy("doc").agg(F.collect_list(F.struct("bucket", "j", "n")).alias("held"))
        members = durable(
            moved.join(sketch_of, "doc")
            .select("doc", "sketches", F.inline("held"))
            .select(F.xxhash64("bucket", further).alias("bucket"), "j", "doc", "n")
        )
        depth *= 2

    links = all_tested().where(is_link).select("a", "b").distinct()
    # A number that is repeated with other words ties the classes of its texts.
    ties = stands.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    links = durable(links)
    labels = components(links.union(ties))

    # Large first buckets whose members are not one class yet: all others against the largest class and each other.
    # A document meets its label once, and buckets with the same largest class are opened together.
    by_doc = whole.groupBy("doc").agg(F.collect_list("bucket").alias("buckets"), F.max("n").alias("n"))
    grouped = durable(
        by_doc.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn("group", F.coalesce("label", "doc"))
        .select("doc", "n", "group", F.explode("buckets").alias("bucket"))
    )
    classes_of = grouped.groupBy("bucket", "group").agg(F.count("*").alias("docs"))
    mains = durable(
        classes_of.groupBy("bucket")
        .agg(F.count("*").alias("groups"), F.max(F.struct("docs", "group")).alias("most"))
        .where("groups > 1")
        .select("bucket", F.col("most.group").alias("main"))
    )
    held = durable(grouped.join(mains, "bucket").groupBy("main", "doc", "group").agg(F.max("n").alias("n")))
    other_n = F.sum(F.when(F.col("group") != F.col("main"), F.col("n")))
    opened = durable(
        held.groupBy("main").agg(
            F.ceil(other_n / cell_shingles).alias("pivot_blocks"), F.ceil(F.sum("n") / cell_shingles).alias("blocks")
        )
    )
    open_members = durable(held.join(opened, "main"))
    at = F.xxhash64("doc", F.lit("block"))
    all_in = open_members.select(
        "main",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("pivot_blocks") - 1)).alias("x"),
        F.pmod(at, "blocks").alias("y"),
        "doc",
        "group",
        F.lit(False).alias("is_pivot"),
    )
    pivots_in = open_members.where("group <> main").select(
        "main",
        F.pmod(at, "pivot_blocks").alias("x"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("y"),
        "doc",
        "group",
        F.lit(True).alias("is_pivot"),
    )
    cells = durable(all_in.union(pivots_in)).join(texts, "doc")

    def close(cell: pd.DataFrame) -> pd.DataFrame:
        columns = [cell[c].tolist() for c in ("doc", "group", "is_pivot", "t")]
        return pd.DataFrame(links_between(*columns, size, least), columns=["a", "b", "score"])

    more = durable(cells.groupBy("main", "x", "y").applyInPandas(close, "a long, b long, score double").select("a", "b").distinct())
    if not more.isEmpty():
        links = durable(links.union(more).distinct())
        labels = components(links.union(ties))
    degrees = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"))
    of_rep = durable(labels.join(degrees, "node", "left").withColumnRenamed("node", "rep"), labels_path)
    return stands, of_rep


def keep_one(docs: DataFrame, classes: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that name their class; rows without a number stay."""
    gone = durable(classes.where("doc_id <> class_id").select(F.col("doc_id").alias("number")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("input"), F.col(doc_id).cast("long").alias("number"))
    return whole.join(gone, "number", "left_anti").select("input.*")
