from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import near_dedup as nd


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_against_the_table():
    random.seed(3)
    for _ in range(1500):
        a = [random.randint(0, 6) for _ in range(random.randint(0, 25))]
        b = [random.randint(0, 6) for _ in range(random.randint(0, 25))]
        if random.random() < 0.5:
            b = list(a)
            for _ in range(random.randint(0, 3)):
                if b:
                    b[random.randrange(len(b))] = 9
        common = longest_common(a, b)
        assert nd.aligned(a, b, 60) == common
        score = common / max(1, len(a) + len(b) - common)
        found = nd.similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), 0.8)
        assert found == pytest.approx(score) if score >= 0.8 else found == 0


def classes_by_brute_force(rows, least=0.8):
    rows = [(i, t) for i, t in rows if i is not None]
    values, bounds = nd.shingles([(t or "").encode() for _, t in rows], 5)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    own = [values[bounds[k] : bounds[k + 1]] for k in range(len(rows))]
    for k, (i, _) in enumerate(rows):
        for m in range(k):
            a, b = own[k].tolist(), own[m].tolist()
            most = sum((Counter(a) & Counter(b)).values())
            if a == b or (most >= least * max(len(a), len(b)) and (c := longest_common(a, b)) >= least * (len(a) + len(b) - c) - 1e-9):
                x, y = find(i), find(rows[m][0])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def test_classes_against_brute_force(documents, edges):
    random.seed(11)
    vocabulary = ["".join(random.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    rows = list(edges)
    number = 100
    for _ in range(12):
        text = [random.choice(vocabulary) for _ in range(random.choice([7, 40, 120, 300]))]
        for _ in range(random.randint(1, 6)):
            copy = list(text)
            for _ in range(random.choice([0, 0, 1, len(copy) // 60, len(copy) // 15])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            spelled = " ".join(copy)
            rows.append((number, spelled.upper() + "!" if random.random() < 0.2 else spelled))
            number += 1
    passage = " ".join(vocabulary[:12])
    rows += [(500 + i, passage + " " + " ".join(random.sample(vocabulary, 9))) for i in range(30)]
    rows += [(600, "$$$ %%%"), (601, "$$$ %%%"), (602, "Ein Wort.")]
    found = {r.doc_id: r.class_id for r in nd.near_classes(documents(rows)).collect()}
    assert found == classes_by_brute_force(rows)


def test_a_long_chain_is_one_class(documents):
    """Neighbours are similar, the ends are not."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 10 : i * 10 + 200])) for i in range(20)]
    out = {r.doc_id: r for r in nd.near_classes(documents(rows)).collect()}
    assert {r.class_id for r in out.values()} == {0} and all(r.n_links >= 1 for r in out.values())


def test_one_of_each_class_stays(documents, edges):
    rows = edges + [(7, "one two three four five six"), (8, "ONE two three four five six."), (9, "other words than all of those before")]
    docs = documents(rows)
    kept = nd.keep_one(docs, nd.near_classes(docs))
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([None, 1, 4, 5, 7, 9], key=str)
    assert kept.columns == docs.columns


def test_no_rows(documents):
    assert nd.near_classes(documents([])).count() == 0


def drifting_copies(seed, number):
    """Copies of 200 words, each with four words changed from one of the copies before; their order is shuffled."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    copies = [[word() for _ in range(200)]]
    while len(copies) < number:
        copy = list(rng.choice(copies))
        for i in rng.sample(range(200), 4):
            copy[i] = word()
        copies.append(copy)
    rng.shuffle(copies)
    return [(i, " ".join(copy)) for i, copy in enumerate(copies)]


@pytest.mark.parametrize("number", [40, 300])
def test_drifting_copies_are_one_class(documents, number):
    """Each copy has a neighbour at 0.8, and most are unlike the smallest member of their bucket."""
    families = [drifting_copies(seed, number) for seed in range(3)]
    rows = [(k * 1000 + i, t) for k, family in enumerate(families) for i, t in family]
    found = {r.doc_id: r.class_id for r in nd.near_classes(documents(rows)).collect()}
    assert found == {i: i // 1000 * 1000 for i, _ in rows}


def test_links_of_a_cell():
    """All of what could join two groups is aligned, in any order, with repeated numbers and texts without words."""
    texts = [t.encode() for _, t in drifting_copies(7, 30)]
    docs, pivots = [*range(30), 3, 4], [i % 3 == 0 for i in range(32)]
    links = nd.links_between(docs, docs, pivots, [*texts, b"other words", b""], 5, 0.8)
    values, bounds = nd.shingles(texts, 5)
    own = [values[a:b] for a, b in zip(bounds, bounds[1:])]
    right = {i: i for i in range(30)}
    joined = dict(right)
    for label, pairs in (
        (right, [(a, b) for a in range(30) for b in range(a) if (pivots[a] or pivots[b]) and nd.similarity(own[a], own[b], 0.8)]),
        (joined, [(a, b) for a, b, _ in links]),
    ):
        for a, b in pairs:
            one, other = label[a], label[b]
            label.update({i: min(one, other) for i in label if label[i] in (one, other)})
    assert links and joined == right
