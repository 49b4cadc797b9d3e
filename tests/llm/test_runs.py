from __future__ import annotations

import random
import zlib

import pytest

from tidemark.llm import periodic_runs, queries


def brute(words, least=12):
    """Every maximal stretch for every period, kept for its smallest one."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, 2 * p):
                found.setdefault((start, length), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(300):
        words = [rng.randint(0, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 60))]
        for least in (2, 3, 12):
            assert periodic_runs.runs_of(words, least) == brute(words, least), words


def test_runs_of_regular_words():
    fibonacci, before = "ab", "a"
    while len(fibonacci) < 400:
        fibonacci, before = fibonacci + before, fibonacci
    for word in ("a" * 200, "ab" * 99 + "a", fibonacci[:400], ("abcabd" * 7 + "x") * 4, "x" + "abcdefghij" * 5 + "y"):
        codes = [ord(c) for c in word]
        for least in (2, 12):
            assert periodic_runs.runs_of(codes, least) == brute(codes, least)


def made(rng):
    words = []
    for _ in range(rng.randint(0, 8)):
        block = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 14))]
        words += block * rng.choice([1, 1, 2, 3, 5]) + block[: rng.randint(0, len(block))]
    return words


def test_texts_against_brute_force(documents, edges):
    rng = random.Random(7)
    texts = [made(rng) for _ in range(250)]
    rows = [*edges, *[(100 + i, rng.choice([" ", "\n", "  "]).join(w)) for i, w in enumerate(texts)], (100, " ".join(texts[0]))]
    rows.append((999, "a b c " * 3000))
    for r in periodic_runs.find_runs(documents(rows)).collect():
        words = (r.text or "").encode().split()
        words = [w.decode() for w in words]
        runs = brute(words) if len(words) < 5000 else [(0, 9000, 3)]
        assert [tuple(x) for x in r.runs] == runs
        assert r.n_words == len(words) and r.collapsed_text == collapsed(words, runs)
        assert r.n_dropped == len(words) - len(r.collapsed_text.encode().split())
        assert r.kept_text == "other"  # a column of the input


def test_no_rows(documents):
    assert periodic_runs.find_runs(documents([])).count() == 0


def test_planted_runs(documents):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 80)))) for i in range(400)] + [(None, "a b"), (40, None), (53, "")]
    done = queries.with_planted_runs(documents(rows).select("doc_id", "text")).collect()
    assert len(done) == len(rows)
    given, changed = {}, 0
    for i, t in rows:
        words = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(len(words))]
            changed += 1
        given.setdefault(i, []).append(words)
    assert changed > 10
    assert all((r.text or "").split() in given[r.doc_id] for r in done)


def test_long_text_keeps_its_stretches_apart(documents):
    rng = random.Random(5)
    words = [str(rng.randint(0, 10**9)) for _ in range(30_000)]
    words[5000:5040] = ["x", "y", "z", "w"] * 10
    words[29_000:30_000] = words[28_000:29_000]
    r = periodic_runs.find_runs(documents([(1, " ".join(words))])).first()
    assert [tuple(x) for x in r.runs] == [(5000, 40, 4), (28_000, 2000, 1000)]
