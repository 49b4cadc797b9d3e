from __future__ import annotations

import random

import pytest

from tidemark.llm import substring_dedup, words


def brute(rows, length):
    """Removed places of every row, from the definition."""
    held = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for s in range(len(w) - length + 1):
                key = tuple(w[s : s + length])
                held[key] = min(i, held.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for s in range(len(w) - length + 1):
                if held[tuple(w[s : s + length])] < i:
                    gone.update(range(s, s + length))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, edges, seed):
    random.seed(seed)
    letters = "abcdefgh"
    passages = [[random.choice(letters) + random.choice(letters) for _ in range(random.randint(5, 40))] for _ in range(12)]
    rows = list(edges)
    for i in range(100, 160):
        w = []
        for _ in range(random.randint(0, 6)):
            p = random.choice(passages)
            a = random.randint(0, len(p) - 1)
            w += p[a : a + random.randint(1, 40)] + [random.choice(letters) for _ in range(random.randint(0, 9))]
        rows.append((i, "  ".join(w) + random.choice(["", "\n", " "])))
    rows += [(130, rows[40][1]), (161, "a " * 50), (162, "a " * 30), (163, "a " * 12)]
    done = substring_dedup.dedup_substrings(documents(rows)).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in done], key=str) == brute(rows, 13)
    for r in done:
        assert r.n_removed == sum(b - a for a, b in r.repeats) and all(b - a >= 13 for a, b in r.repeats)


def test_no_rows(documents):
    assert substring_dedup.dedup_substrings(documents([])).count() == 0


def test_equal_windows_select_equal_seeds():
    a = words.Words.of([b"x y z " + b"one two three four five six seven eight nine ten eleven twelve thirteen"])
    b = words.Words.of([b"one two three four five six seven eight nine ten eleven twelve thirteen q r"])
    (ba, pa), (bb, pb) = (substring_dedup.seeds_of(w.hashes(), w.bounds, 13, 5) for w in (a, b))
    assert pa[list(ba).index(3)] - 3 == pb[list(bb).index(0)]


@pytest.mark.parametrize(("length", "seed"), [(6, 2), (5, 5), (9, 1)])
def test_variants_that_differ_at_every_distance_from_a_seed(documents, length, seed):
    random.seed(length)
    base = [f"w{k}" for k in range(3 * length)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(random.randint(0, 3)):
            w[random.randrange(len(w))] = random.choice("xyz")
        a = random.randrange(length)
        rows.append((i, " ".join(w[a:] + w[: random.randrange(len(w))])))
    rows += [(20, rows[20][1]), (20, rows[21][1]), (None, rows[3][1]), (200, None), (201, "")]
    done = substring_dedup.dedup_substrings(documents(rows), length=length, seed=seed).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in done], key=str) == brute(rows, length)


def test_an_occurrence_is_followed_to_both_sides():
    import numpy as np
    import pyarrow as pa

    def side(*words):
        return np.array(words, np.uint64).tobytes()

    one = {"key": 7, "row": 0, "known_left": 0, "known_right": 0, "lead_doc": 1, "several": 1}
    one |= {"lead_left": side(1, 2, 3, 4), "lead_right": side(5, 6, 7, 8)}
    rows = [
        one | {"doc": 2, "at": 50, "low": 0, "high": 4, "left": side(1, 2, 3, 4), "right": side(5, 6, 7, 8)},
        one | {"doc": 3, "at": 60, "low": 1, "high": 3, "left": side(1, 2, 9), "right": side(5, 6, 9)},
        one | {"doc": 1, "at": 70, "low": 2, "high": 2, "left": side(1, 2), "right": side(5, 6)},
    ]
    done = substring_dedup.extend(pa.RecordBatch.from_pylist(rows), 4).to_pylist()
    assert [(r["doc"], r["begin"], r["end"]) for r in done if r["begin"] is not None] == [(2, 46, 50), (3, 58, 58)]
    rest = [r for r in done if r["key"] is not None]
    assert [(r["doc"], r["low"], r["high"], r["known_left"], r["known_right"]) for r in rest] == [(3, 1, 1, 0, 3), (3, 3, 3, 3, 0)]
    assert rest[0]["left"] == side(1) and rest[1]["right"] == side(5) and rest[0]["right"] == rest[1]["left"] == b""
