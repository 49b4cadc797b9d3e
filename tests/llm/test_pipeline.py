from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_classes import classes_by_brute_force
from test_lines_and_rules import base, words_of
from test_substrings import brute as brute_substrings
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import quality_rules


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random.seed(21)
    vocabulary = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 7))) for _ in range(500)]

    def sentence(n):
        return " ".join(random.choice(vocabulary) for _ in range(n)).capitalize() + "."

    passage = " ".join(random.choice(vocabulary) for _ in range(60))
    rows = [(None, None), (1, None), (2, ""), (3, "too short.")]
    for i in range(10, 70):
        text = [sentence(random.randint(4, 14)) for _ in range(random.randint(3, 30))]
        if random.random() < 0.3:
            text.insert(1, sentence(6)[:-1] + " " + passage + " " + sentence(5))
        if random.random() < 0.2:
            text.append("All rights reserved.")
        if random.random() < 0.1:
            text = ["Home | News | More | Last"] * 5 + text[:2]
        rows.append((i, "\n".join(text)))
        if random.random() < 0.3:  # a near copy with other line breaks
            rows.append((100 + i, " ".join(text).replace(vocabulary[0], vocabulary[1])))
        if random.random() < 0.2:
            rows.append((200 + i, "\n".join(text)))
    path = tmp_path_factory.mktemp("tables")
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def cleaned(rows):
    for i, text in rows:
        n, *_, failed = base(text)
        kept, lost = [], 0
        for line in (text or "").split("\n"):
            here = len(words_of(line))
            if here and quality_rules.line_fails(line, here, 0.25, 8, 3):
                lost += here
            else:
                kept.append(line)
        if not failed and lost <= 0.3 * n:
            yield i, "\n".join(kept)


def without_repeated_lines(rows):
    held = defaultdict(set)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    for i, text in rows:
        for line in text.split("\n"):
            held[key(line)].add(i)
    for i, text in rows:
        lines = [x for x in text.split("\n") if len(key(x)) < 10 or min(held[key(x)]) == i]
        yield i, "\n".join(lines)


def test_stages_against_brute_force(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    expected = list(cleaned(rows))
    steps = {
        "quality_rules": lambda before: list(cleaned(before)),
        "line_dedup": lambda before: list(without_repeated_lines(before)),
        "near_dedup": lambda before: [(i, t) for i, t in before if classes_by_brute_force(before)[i] == i],
        "substring_dedup": lambda before: [
            (i, kept if gone else dict(before)[i]) for i, _, gone, kept in brute_substrings(before, 13)
        ],
    }
    before = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
        assert docs.columns == columns
        found = docs.collect()
        before = steps[name](before)
        assert sorted((r.doc_id, r.text) for r in found) == sorted(before), name
        assert all(r.n_chars == len(r.text) for r in found)
    assert len(before) < len(expected) < len(rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in before}
    packed = corpus_pipeline.run(spark, path).collect()
    shaped = [type("Piece", (), {**r.asDict(), "id": r.doc_id, "row": 0}) for r in packed]
    assert {r.doc_id for r in packed} == set(ids)
    check_packing(shaped, ids, 2048)


def test_no_documents(spark, folder, tmp_path):
    path, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    assert all(re.fullmatch(r"[a-z_]+", n) for n, _ in corpus_pipeline.STAGES)
