from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts, word_bpe
from tidemark.llm.tokens import Encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = list("ab'st lremdvİßǅ  \n\t 　 12.é<|$") + [
    "<|endoftext|>",
    "<|startoftext|>",
    "<|end",
    "'ll",
    " the",
    "ation",
    "日本",
    "é",
    "🙂",
    "́",
    "=" * 70,
    " " * 30,
]


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    some = ["".join(random.choice(PARTS) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    long = "".join(random.choice(["word", " ", "Anti", "matter", "\n", "x1", ".", " the "]) for _ in range(60_000))
    return some + [None, "", " ", "\n\n", long, "unbroken" * 5_000, "日本語" * 3_000]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_counts(docs, texts):
    right = Tokenizer.from_file(BYTES).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for chunk in (1024, 16):
        found = {r.doc_id: r for r in token_counts.count_tokens(docs, BYTES, chunk=chunk).collect()}
        for i, text in enumerate(texts):
            assert found[i].n_tokens == len(right[i].ids), repr(text)[:80]
            assert found[i].n_bytes == len((text or "").encode())


def test_counts_do_not_depend_on_the_table(monkeypatch, texts):
    from tidemark.llm import transducer

    machine = transducer.Transducer(BYTES)
    data = [t.encode() for t in texts[:300] if t]
    bounds = np.cumsum([0, *map(len, data)])
    whole = np.frombuffer(b"".join(data), dtype=np.uint8)
    once = machine.run(whole, bounds[:-1], bounds[1:])
    monkeypatch.setattr(transducer, "TABLE_STATES", 50)
    for i in range(0, len(data), 7):
        part = machine.run(whole, bounds[i : i + 7][: len(data) - i], bounds[i + 1 : i + 8])
        assert (part == once[i : i + 7]).all()


def test_tables_that_fill_within_a_step(monkeypatch, texts):
    from tidemark.llm import transducer

    random.seed(9)
    letters = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5_000))
    data = [t.encode() for t in [*texts[:60], letters] if t]
    right = Tokenizer.from_file(BYTES).encode_batch([t.decode() for t in data], add_special_tokens=False)
    bounds = np.cumsum([0, *map(len, data)])
    whole = np.frombuffer(b"".join(data), dtype=np.uint8)
    for slots, states in ((10, 1 << 18), (5, 1 << 18), (21, 50)):
        monkeypatch.setattr(transducer, "SLOTS", slots)
        monkeypatch.setattr(transducer, "TABLE_STATES", states)
        machine = transducer.Transducer(BYTES)
        calls, fill = [], machine.fill

        def counted(key):
            assert machine.filled < (1 << slots) - 1  # a slot stays free, so that probes end
            calls.append(key)
            return fill(key)

        monkeypatch.setattr(machine, "fill", counted)
        assert machine.run(whole, bounds[:-1], bounds[1:]).tolist() == [len(r.ids) for r in right]
        assert len(calls) > 1000


def test_word_encoding_and_decoding(docs, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    right = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for r in word_bpe.encode_texts(docs, WORDS).collect():
        ids = right[r.doc_id].ids
        assert r.ids_text == " ".join(map(str, ids)), repr(texts[r.doc_id])[:80]
        assert r.n_tokens == len(ids)
        assert r.decoded_text == tokenizer.decode(ids, skip_special_tokens=False)


def test_worker_side_ids(texts):
    right = Tokenizer.from_file(BYTES)
    encoder = Encoder(BYTES)
    for text in texts[:400]:
        assert list(encoder.ids(text or "")) == right.encode(text or "", add_special_tokens=False).ids


def check_packing(rows, ids_of, capacity):
    """Every document whole and in order, every sequence gapless; returns the number of sequences."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.id, r.row].append(r)
        sequences[r.sequence_id].append(r)
    for (i, _), own in pieces.items():
        own.sort(key=lambda r: r.piece)
        ids, at = ids_of[i], 0
        for k, r in enumerate(own):
            assert r.piece == k and r.start == at and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("group_items", [50_000, 40])
def test_packing(spark, docs, texts, group_items):
    tokenizer = Tokenizer.from_file(BYTES)
    ids_of = {
        i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in enumerate(texts)
    }
    pieces = packing.pieces_of(docs.unionAll(docs.where("doc_id < 3")), BYTES, 128)
    rows = packing.pack(pieces, 128, group_items=group_items).collect()
    assert sum(r.length for r in rows) == sum(len(v) for v in ids_of.values()) + sum(len(ids_of[i]) for i in range(3))
    used = check_packing(rows, ids_of, 128)
    assert used <= -(-sum(r.length for r in rows) // 128) * (1.01 if group_items > 1000 else 1.05) + 1


def test_best_fit_takes_the_fullest_bin():
    assert packing.best_fit(np.array([6, 5, 4, 5]), 10) == [[0, 2], [1, 3]]
    assert packing.best_fit(np.array([], dtype=int), 10) == []


def test_nothing_to_do(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, BYTES).count() == 0
    assert word_bpe.encode_texts(none, WORDS).count() == 0
    assert packing.pack(packing.pieces_of(none, BYTES, 128), 128).count() == 0
