from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import line_dedup, quality_rules


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_repeated_lines_stay_in_the_first_document(documents, edges):
    rows = edges + [
        (10, "  A line of Text \nonly here, once"),
        (11, "a LINE of text\nshort\nown line of eleven"),
        (11, "a LINE of text\nanother text of the same number"),
        (12, "short\nA LINE OF TEXT\nA LINE OF TEXT"),
    ]
    out = defaultdict(list)
    for r in line_dedup.dedup_lines(documents(rows)).collect():
        out[r.doc_id].append((r.n_lines, r.n_dropped, r.kept_text))
    assert out[10] == [(2, 0, "  A line of Text \nonly here, once")]
    assert sorted(out[11]) == [(2, 1, "another text of the same number"), (3, 1, "short\nown line of eleven")]
    assert out[12] == [(3, 2, "short")]
    assert out[1] == out[2] == [(1, 0, "")]
    assert len(out[3]) == 2
    assert out[None] == [(1, 0, rows[0][1])]


def test_a_higher_threshold_counts_documents(documents):
    rows = [(i, "the same long line") for i in range(3)] + [(7, "two documents only"), (8, "two documents only")]
    out = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(documents(rows), min_documents=3).collect()}
    assert out == {0: 0, 1: 1, 2: 1, 7: 0, 8: 0}


def test_no_lines(documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0


def base(text):
    """The base counts, straight from their definition."""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)


def test_base_counts_and_verdicts(documents, edges):
    prose = "The first sentence of a clean text has many words.\nThe second one has other words, and it ends too.\nA third says something else again in several plain words."
    rows = edges + [
        (20, prose),
        (21, "one two three four five six " * 6 + "end."),
        (22, "Home | News | Sport | Contact | More\n" + prose),
        (23, "Home | News | Sport | Contact | More | Even more | Last\n" * 3 + "A short sentence that ends here."),
        (24, "wo$$$ rds*** wi### th%%% si&&& gns$$$ af*** ter### ea%%% ch&&& one$$$"),
        (25, prose + "\nAll rights reserved."),
    ]
    out = {r.doc_id: r for r in quality_rules.apply_rules(documents(rows)).collect()}
    for i, text in rows:
        r = out[i]
        found = (int(r.n_words), r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == base(text), text
    assert [out[i].kept for i in (20, 21, 22, 23, 24, 25)] == [True, False, True, False, False, True]
    assert out[22].kept_text == prose and out[25].kept_text == prose
    assert not out[1].kept and not out[2].kept
    assert quality_rules.apply_rules(documents([])).count() == 0


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("ALL RIGHTS RESERVED.", True),
        ("Terms of Service apply.", True),
        ("Licensed undertakings end.", False),
        ("Alle Rechte vorbehalten.", True),
        ("Unsere Datenschutzerklärungen gelten.", True),
        ("Tous droits réservés.", True),
        ("Les Conditions d'utilisation changent.", True),
        ("Todos los derechos reservados.", True),
        ("Haga clic aquí.", True),
        ("Sie klicken nicht hier.", False),
        ("La política no es privada.", False),
    ],
)
def test_boilerplate_of_every_language(line, fails):
    assert quality_rules.line_fails(line, len(line.split()), 0.25, 8, 3) is fails


def test_phrases_are_lower_case_and_begin_with_a_letter():
    for own in quality_rules.PHRASES.values():
        assert all(p == p.lower() and p[0].isascii() and p[0].isalpha() for p in own)


def test_a_very_long_text(documents):
    text = "\n".join(f"Sentence {i} has its own number {i * 7}, and some words." for i in range(40_000))
    r = quality_rules.apply_rules(documents([(1, text), (2, None)])).where("doc_id = 1").first()
    assert r.kept and r.kept_text == text
    assert line_dedup.dedup_lines(documents([(1, text), (2, text[:1000])])).where("doc_id = 2").first().n_dropped > 15
    assert hashlib.sha256(text.encode()).hexdigest()
