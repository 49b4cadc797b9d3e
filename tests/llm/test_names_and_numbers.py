"""Columns with the names of working columns, large numbers beside null ones, repeated rows."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import line_dedup, near_dedup, packing, perplexity, substring_dedup, token_counts, word_bpe

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
CLASHING = ["doc", "row", "input", "lines", "kept", "dropped", "starts", "t", "__doc", "__at", "__row", "__lines", "n_tokens", "ids_text", "n_bytes", "number"]


def clashing(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.withColumns({c: F.concat(F.lit(f"own {c} "), F.col("doc_id").cast("string")) for c in CLASHING})


LINES = [(1, "a line that repeats\nfirst"), (2, "A LINE that repeats \nsecond"), (2, "A LINE that repeats \nsecond"), ((1 << 60) + 1, "a line that repeats")]


@pytest.mark.parametrize(
    "operator",
    [
        line_dedup.dedup_lines,
        lambda d: substring_dedup.dedup_substrings(d, length=4, seed=2),
        lambda d: word_bpe.encode_texts(d, WORDS),
        lambda d: token_counts.count_tokens(d, BYTES),
        lambda d: near_dedup.keep_one(d, near_dedup.near_classes(d)),
    ],
)
def test_columns_keep_their_values(spark, operator):
    docs = clashing(spark, LINES)
    done = operator(docs)
    replaced = {"n_tokens", "ids_text", "n_bytes"} & set(done.columns) if len(done.columns) > len(docs.columns) - 3 else set()
    for r in done.collect():
        for c in set(CLASHING) - replaced:
            assert r[c] == f"own {c} {r.doc_id}"
    assert set(CLASHING) <= set(done.columns)


def test_lines_are_dropped_beside_clashing_names(spark):
    done = line_dedup.dedup_lines(clashing(spark, LINES))
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in done.collect()) == [
        (1, 2, 0, "a line that repeats\nfirst"), (2, 2, 1, "second"), (2, 2, 1, "second"), ((1 << 60) + 1, 1, 1, "")
    ]


def test_words_are_encoded_and_decoded_as_the_library_does(spark):
    rng = random.Random(4)
    parts = ["ab'st", "It's", "we'LL", "naïve", "É", "ﬁ", "日本 語", " ", "　", "x-1", "12", "<|endoftext|>", "<|", "…", "\x1c", "\x7f", "ǅ", "á", "Σς", "\u0085", "word", "word,"]
    texts = [" ".join(rng.choice(parts) + rng.choice(["", rng.choice(parts)]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [*texts[:40], None, "", "unbroken" * 3000, "日" * 70_000, "　"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(WORDS)
    done = word_bpe.encode_texts(docs, WORDS)
    again = {r.doc_id: r.decoded_text for r in word_bpe.decode_ids(done.select("doc_id", "ids_text"), WORDS).collect()}
    for r in done.collect():
        right = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_text) == (len(right), " ".join(map(str, right)))
        assert r.decoded_text == again[r.doc_id] == tokenizer.decode(right, skip_special_tokens=False)


def test_large_numbers_beside_null_ones_in_the_classifier(spark):
    large = (1 << 60) + 1
    rows = [(large + i, f"trusted words number {i} and more of them", "en") for i in range(60)] + [(None, "a text without a number", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id is not null").select("doc_id")
    done = perplexity.classify(docs, trusted).collect()
    assert sorted(r.doc_id for r in done if r.doc_id is not None) == [large + i for i in range(60)]
    known = sorted(r.perplexity for r in done if r.perplexity is not None)
    (threshold,) = {r.threshold for r in done if r.lang == "en"}
    assert threshold in known  # a held-out document's own value: no approximation


def test_texts_of_one_number_are_dealt_to_several_blocks(spark):
    rows = [(7 if i % 3 else i, f"text {i} has its own words " + "and more of them " * (i % 5), "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.where("doc_id % 2 = 1").select("doc_id")
    one, many = (
        sorted((r.doc_id, round(r.perplexity, 6), r.kept) for r in perplexity.classify(docs, trusted, block_bytes=size).collect())
        for size in (1 << 20, 500)
    )
    assert one == many and len(one) == 120


def passed_on(sizes, groups, capacity, fan_in, limit):
    """Sequences of the same rounds, every underfull bin passed on."""
    held = [np.sort(np.array(s, dtype=np.int64))[::-1] for s in groups]
    final = 0
    while True:
        out = []
        for items in held:
            fills = [int(items[b].sum()) for b in packing.best_fit(items, capacity)]
            final += sum(f >= limit for f in fills)
            out.append([f for f in fills if f < limit])
        if len(out) == 1:
            return final + len(out[0])
        held = [np.array(sorted(sum(out[i : i + fan_in], []), reverse=True), dtype=np.int64) for i in range(0, len(out), fan_in)]


@pytest.mark.parametrize("kind", ["half full", "mixed", "one size"])
def test_no_underfull_bin_is_lost(spark, kind):
    rng = random.Random(kind)
    draw = {
        "half full": lambda: rng.choice([1100, 1100, 1100, 1200, 1101, 800]),
        "mixed": lambda: rng.choice([rng.randint(1, 2047), rng.randint(1030, 1500)]),
        "one size": lambda: 1100,
    }[kind]
    rows = [(i, 0, 0, 0, draw(), i) for i in range(900)]
    pieces = spark.createDataFrame(rows, "id long, row long, piece int, start long, length int, ids_crc32 long")
    dealt = pieces.select("length", F.pmod(F.xxhash64("id", "row", "piece"), F.lit(41)).alias("grp")).collect()
    groups = [[r.length for r in dealt if r.grp == g] for g in range(41)]
    done = packing.pack(pieces, 2048, group_items=22, fan_in=4).collect()
    assert -(-900 // 22) == 41
    assert len({r.sequence_id for r in done}) == passed_on(None, groups, 2048, 4, 2048 - 32)
    held = {}
    for r in done:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert sorted(r.id for r in done) == list(range(900))
