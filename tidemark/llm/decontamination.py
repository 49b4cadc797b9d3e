"""Benchmark decontamination: a generalised suffix automaton of test items that training text is streamed through."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from .common import ascii_lower, over_text, steps, text_key, without
from .words import PLACES, Words, mixed, starts

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("longest_match", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("kept", T.BooleanType()),
        T.StructField("kept_text", T.StringType()),
    ]
)

#: Normalisation of bytes: digits, letters in lower case and all bytes of other characters stay, the rest separates.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: The same characters for Spark's patterns, on lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Items are cut to pieces of so many words, which overlap by a window less one word.
PIECE_WORDS = 20_000


class Automaton:
    """The suffix automaton of several word sequences, with the items of every window.

    State 1 is the empty string.  ``items_at`` has the items of a full window by
    the state of that window, ``short`` the items that are a window of their own.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.vocabulary = window, {}
        self.length, self.link, self.step = [0, 0], [0, 0], {}
        self._out: list[list[int]] = [[], []]
        coded = []
        for name, words in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if codes:
                coded.append((name, codes))
        self.width = len(self.vocabulary) + 1
        for _, codes in coded:
            last = 1
            for code in codes:
                last = self._extend(last, code)
        self.anchor = self._anchors()
        self.items_at: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for name, codes in coded:
            state = 1
            for i, code in enumerate(codes, 1):
                state = self.step[state * self.width + code]
                if i >= window:
                    self.items_at.setdefault(self.anchor[state], set()).add(name)
            if len(codes) < window:
                self.short.setdefault(state, []).append((len(codes), name))
        self.nearest = self._nearest()
        self.seed = min([window, 5, *[n for held in self.short.values() for n, _ in held]])
        self.seeds = np.zeros(1 << 16, dtype=bool)
        total = sum(len(codes) for _, codes in coded)
        while len(self.seeds) < 16 * total:
            self.seeds = np.zeros(2 * len(self.seeds), dtype=bool)
        for _, codes in coded:
            self.seeds[self.places(np.array(codes, dtype=np.uint64))] = True
        del self._out

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _extend(self, last: int, code: int) -> int:
        length, link, step, width, out = self.length, self.link, self.step, self.width, self._out
        known = step.get(last * width + code)
        if known is not None and length[known] == length[last] + 1:
            return known
        p = last
        if known is None:
            new = self._state(length[last] + 1, 1)
            while p and p * width + code not in step:
                step[p * width + code] = new
                out[p].append(code)
                p = link[p]
            if not p:
                return new
        q = step[p * width + code]
        if length[q] != length[p] + 1:
            old, q = q, self._state(length[p] + 1, link[q])
            out[q] = list(out[old])
            for c in out[old]:
                step[q * width + c] = step[old * width + c]
            link[old] = q
            while p and step.get(p * width + code) == old:
                step[p * width + code] = q
                p = link[p]
        if known is None:
            link[new] = q
            return new
        return q

    def _by_length(self) -> list[int]:
        return sorted(range(2, len(self.length)), key=self.length.__getitem__)

    def _anchors(self) -> list[int]:
        """For each state the state that holds the last ``window`` words of its strings; 0 if they are fewer."""
        anchor = [0] * len(self.length)
        for s in self._by_length():
            if self.length[s] >= self.window:
                anchor[s] = anchor[self.link[s]] or s
        return anchor

    def _nearest(self) -> list[int]:
        """For each state the longest one up its links, itself included, at which a short item ends."""
        nearest = [0] * len(self.length)
        for s in self._by_length():
            nearest[s] = s if s in self.short else nearest[self.link[s]]
        return nearest

    def places(self, codes: np.ndarray) -> np.ndarray:
        """A place in the table of seeds for the ``seed`` words from each word on."""
        size = len(codes) - self.seed + 1
        if size <= 0:
            return np.empty(0, dtype=np.int64)
        total = np.zeros(size, dtype=np.uint64)
        for i in range(self.seed):
            total += codes[i : i + size] * PLACES[0][i]
        return (mixed(total) & np.uint64(len(self.seeds) - 1)).astype(np.int64)

    def stream(self, codes: list[int]) -> tuple[list[tuple[int, int]], set, int]:
        """Read words: spans of window occurrences, the items that hold them, the longest match."""
        length, link, step, width, window = self.length, self.link, self.step, self.width, self.window
        spans: list[list[int]] = []
        items: set = set()
        state, held, longest = 1, 0, 0
        for i, code in enumerate(codes):
            following = step.get(state * width + code) if code else None
            while following is None and code and state != 1:
                state = link[state]
                held = length[state]
                following = step.get(state * width + code)
            if following is None:
                state, held = 1, 0
                continue
            state, held = following, held + 1
            longest = max(longest, held)
            begin = None
            if held >= window:
                items |= self.items_at[self.anchor[state]]
                begin = i + 1 - window
            at = self.nearest[state]
            while at:
                for size, name in self.short[at]:
                    if size <= held:
                        items.add(name)
                        begin = i + 1 - size if begin is None else min(begin, i + 1 - size)
                at = self.nearest[link[at]]
            if begin is not None:
                while spans and begin <= spans[-1][1]:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, i + 1])
        return spans, items, longest

    def scan(self, words: Words) -> dict[int, tuple[list[list[int]], set, int]]:
        """By text: what :meth:`stream` finds in the stretches whose every ``seed`` words may be in an item."""
        get = self.vocabulary.get
        codes = np.fromiter(map(get, words.words, repeat(0)), dtype=np.uint64, count=len(words.words))
        inside = starts(words.bounds, self.seed)
        if not len(inside):
            return {}
        for i in range(self.seed):
            inside &= codes[i : i + len(inside)] > 0
        begin = np.flatnonzero(inside)
        begin = begin[self.seeds[self._some(codes, begin)]]
        if not len(begin):
            return {}
        owner = np.searchsorted(words.bounds, begin, side="right") - 1
        cut = np.flatnonzero((np.diff(begin) > 1) | (np.diff(owner) > 0)) + 1
        found: dict[int, tuple[list[list[int]], set, int]] = {}
        for first, past in zip(np.append(0, cut).tolist(), np.append(cut, len(begin)).tolist(), strict=True):
            a, b, doc = int(begin[first]), int(begin[past - 1]) + self.seed, int(owner[first])
            spans, items, longest = self.stream(codes[a:b].tolist())
            at = a - int(words.bounds[doc])
            before = found.get(doc, ([], set(), 0))
            found[doc] = (before[0] + [[at + s, at + e] for s, e in spans], before[1] | items, max(before[2], longest))
        return found

    def _some(self, codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        total = np.zeros(len(begin), dtype=np.uint64)
        for i in range(self.seed):
            total += codes[begin + i] * PLACES[0][i]
        return (mixed(total) & np.uint64(len(self.seeds) - 1)).astype(np.int64)


def united(spans) -> list[list[int]]:
    """Spans in order, those that meet joined."""
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def without_words(raw: bytes, normal: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans and the separators inside them."""
    edges, inside = [], False
    for i, b in enumerate(normal):
        if (b != 32) != inside:
            inside = not inside
            edges.append(i)
    if inside:
        edges.append(len(normal))
    out, end = [], 0
    for a, b in spans:
        out.append(raw[end : edges[2 * a]])
        end = edges[2 * b - 1]
    return b"".join([*out, raw[end:]])


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def automata(items: DataFrame, window: int, shard_words: int, item_id: str, text: str) -> list[Automaton]:
    """Automata over shards of the items, each of at most ``shard_words`` words.

    Long items are cut to overlapping pieces, so every window is in one piece; the
    pieces are dealt by a hash, more thinly until no shard is larger.  One shard at
    a time is held by the driver.
    """
    step = PIECE_WORDS - window + 1
    size = F.size("w")
    pieces = durable(
        items.select(F.col(f"`{item_id}`").cast("string").alias("item"), item_words(F.col(f"`{text}`")).alias("w"))
        .where(size > 0)
        .distinct()
        .select("item", "w", F.explode(F.sequence(F.lit(0), F.floor(F.greatest(size - window, F.lit(0)) / step).cast("int"))).alias("i"))
        .select("item", F.slice("w", F.col("i") * step + 1, PIECE_WORDS).alias("w"), F.xxhash64("item", "w", "i").alias("h"))
    )
    total = pieces.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    while True:
        dealt = pieces.withColumn("shard", F.pmod("h", F.lit(shards)))
        sizes = dealt.groupBy("shard").agg(F.sum(size).alias("n"))
        if shards == 1 or (sizes.agg(F.max("n")).first()[0] or 0) <= max(shard_words, 2 * PIECE_WORDS):
            break
        shards *= 2
    for shard in range(shards):
        rows = dealt.where(F.col("shard") == shard).select("item", "w").orderBy("h").collect()
        yield Automaton([(r["item"], [w.encode() for w in r["w"]]) for r in rows], window)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    shard_words: int = 200_000,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Find and remove passages of test items; adds the columns of ``RESULT`` to ``docs``.

    Texts and items are words of digits, letters (A to Z in lower case) and other
    characters beyond ASCII.  A document's words are streamed through the suffix
    automaton of the items; where the longest match reaches ``window`` words, the
    last ``window`` words are hit, and an item of fewer words is a window of its own.

    * ``n_words``, ``n_hit``: words, and those inside an occurrence of a window;
    * ``longest_match``: words of the longest common sequence (those shorter than the
      seed of 5 words, or the shortest item, count as 0);
    * ``items``: the items whose windows occur, in the order of their spelling;
    * ``spans``: the hit words as ``[first, end]``; ``kept_text`` is the text without them;
    * ``kept``: whether hit words are at most ``max_coverage`` of all.

    A text is only streamed where five words in succession may be in an item (a
    table of hashes tells), which loses no match of that length.  Items are read in
    shards of ``shard_words`` words; one shard's automaton (about 100 MB) is
    broadcast and its driver copy dropped before the next.  With one shard
    a text is read once and nothing is shuffled; with more, only texts with a hit
    are joined back.

    Null and empty texts have no words and are kept.  Items without words have no
    window; windows of items without a number hit, but are not listed.  Repeated
    items count once, repeated rows get the same answer.
    """
    spark = docs.sparkSession
    docs = without(docs, RESULT.names)

    def judged(texts, found):
        out = {n: [] for n in RESULT.names}
        for raw, (n, spans, names, longest) in zip(texts, found, strict=True):
            spans = united(spans)
            hit = sum(b - a for a, b in spans)
            out["n_words"].append(n)
            out["n_hit"].append(hit)
            out["longest_match"].append(longest)
            out["items"].append(sorted({x for x in names if x is not None}))
            out["spans"].append(spans)
            out["kept"].append(hit <= max_coverage * n)
            out["kept_text"].append((without_words(raw, raw.translate(_NORMAL), spans) if spans else raw).decode())
        return out

    def read(automaton, texts):
        words = Words.of([t.translate(_NORMAL) for t in texts])
        found = automaton.scan(words)
        return [(n, *found.get(i, ((), (), 0))) for i, n in enumerate(words.counts().tolist())]

    shards = automata(items, window, shard_words, item_id, item_text)
    held = [spark.sparkContext.broadcast(next(shards))]
    tables: list[DataFrame] = []
    for following in shards:
        if not tables:
            tables.append(_hits(docs, held[0], read, text))
        tables.append(_hits(docs, spark.sparkContext.broadcast(following), read, text))
    if not tables:
        one = held[0]
        return over_text(docs, lambda texts: judged(texts, read(one.value, texts)), RESULT, text)

    hits = tables[0]
    for more in tables[1:]:
        hits = hits.unionByName(more)
    hits = durable(
        hits.groupBy("k1", "k2").agg(
            F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("names")).alias("i"), F.max("longest").alias("m")
        )
    )
    key = [text_key(text), F.xxhash64(F.lit("second"), F.col(f"`{text}`"))]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    marked = docs.select(whole, F.col(f"`{text}`").alias("t"), key[0].alias("k1"), key[1].alias("k2")).join(hits, ["k1", "k2"], "left")

    def finish(texts, spans, names, longest):
        counts = [len(t.translate(_NORMAL).split()) for t in texts]
        return judged(texts, [(n, s or (), x or (), m or 0) for n, s, x, m in zip(counts, spans, names, longest, strict=True)])

    done = over_text(marked, finish, RESULT, "t", keep=["d"], extra=["s", "i", "m"])
    return done.select("d.*", *RESULT.names)


def _hits(docs: DataFrame, automaton, read, text: str) -> DataFrame:
    """For one shard: the distinct texts with a match, by two hashes of the text."""

    def run(batches):
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for part in steps(texts):
                found = read(automaton.value, texts[part])
                rows = [i for i, f in enumerate(found) if f[3]]
                keys = batch.slice(part.start, part.stop - part.start).select(["k1", "k2"]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *keys.columns,
                        pa.array([[list(s) for s in found[i][1]] for i in rows], pa.list_(pa.list_(pa.int64()))),
                        pa.array([[x for x in found[i][2] if x is not None] for i in rows], pa.list_(pa.string())),
                        pa.array([found[i][3] for i in rows], pa.int64()),
                    ],
                    names=["k1", "k2", "spans", "names", "longest"],
                )

    source = docs.where(F.col(f"`{text}`").isNotNull()).select(
        text_key(text).alias("k1"), F.xxhash64(F.lit("second"), F.col(f"`{text}`")).alias("k2"), F.col(f"`{text}`").cast("binary").alias("t")
    )
    found = source.mapInArrow(run, "k1 long, k2 long, spans array<array<long>>, names array<string>, longest long")
    return durable(found.dropDuplicates(["k1", "k2"]))
