from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window=10):
    """Hit words and the items whose windows occur."""
    words, hit, names = split(text), set(), set()
    for name, item in items:
        w = split(item)
        m = min(len(w), window)
        windows = {tuple(w[s : s + m]) for s in range(len(w) - m + 1)} if w else set()
        for s in range(len(words) - m + 1):
            if tuple(words[s : s + m]) in windows:
                hit.update(range(s, s + m))
                if name is not None:
                    names.add(str(name))
    return words, hit, sorted(names)


def sample(rng, words, n):
    return [rng.choice(words) for _ in range(n)]


def prepared(seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "été", "x1", "日本", "delta", "eps"]
    items = [(i, " ".join(sample(rng, words, rng.randint(1, 40)))) for i in range(30)]
    items += [(7, items[3][1]), (None, " ".join(sample(rng, words, 30))), (90, None), (91, "..."), (92, ""), (11, items[11][1])]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            own = split(rng.choice(items)[1]) or ["q"]
            a = rng.randint(0, len(own) - 1)
            parts += sample(rng, [*words, "other"], rng.randint(0, 9)) + own[a : a + rng.randint(1, 30)]
        rows.append((i, rng.choice([" ", ", ", "\n-- "]).join(p.upper() if rng.random() < 0.3 else p for p in parts)))
    return items, rows


@pytest.mark.parametrize("shard_words", [200_000, 60])
def test_against_brute_force(spark, documents, edges, shard_words, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 25)
    items, rows = prepared(1)
    rows = [*edges, *rows, (5, rows[8][1]), (500, "word " * 20_000 + rows[9][1])]
    held = spark.createDataFrame(items, "item_id long, text string")
    done = decontamination.decontaminate(documents(rows), held, shard_words=shard_words).collect()
    assert len(done) == len(rows)
    for r in done:
        words, hit, names = brute(r.text, items)
        assert (r.n_words, r.n_hit, r["items"]) == (len(words), len(hit), names)
        assert {k for a, b in r.spans for k in range(a, b)} == hit
        assert split(r.kept_text) == [w for k, w in enumerate(words) if k not in hit]
        assert r.kept == (len(hit) <= 0.5 * len(words))
        assert hit or r.kept_text == (r.text or "")
        assert r.lang == "en"


def test_longest_match(spark, documents):
    item = " ".join(f"w{i}" for i in range(50))
    rows = [(1, "a " + " ".join(f"w{i}" for i in range(5, 14))), (2, "w3 w4 " + " ".join(f"w{i}" for i in range(20, 47))), (3, "w1 w2 w3")]
    done = decontamination.decontaminate(documents(rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r.doc_id: (r.longest_match, r.n_hit) for r in done.collect()} == {1: (9, 0), 2: (27, 27), 3: (0, 0)}


def test_no_rows_and_no_items(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(documents([]), none).count() == 0
    r = decontamination.decontaminate(documents([(1, "some text")]), none).first()
    assert (r.n_words, r.n_hit, r["items"], r.kept, r.kept_text) == (2, 0, [], True, "some text")


def test_automaton_holds_every_substring():
    rng = random.Random(2)
    items = [(str(i), [rng.choice(b"abc").to_bytes() for _ in range(rng.randint(1, 30))]) for i in range(12)]
    found = decontamination.Automaton(items, 4)
    for _, words in items:
        for a in range(len(words)):
            state = 1
            for w in words[a:]:
                state = found.step[state * found.width + found.vocabulary[w]]
    assert len(found.length) <= 2 * sum(len(w) for _, w in items) + 2
