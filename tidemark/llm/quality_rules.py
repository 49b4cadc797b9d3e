"""Quality rules: lines are judged first, then the document by what its lines leave."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import over_text
from .words import Words, grams, starts

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_words_lost", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("kept_text", T.StringType()),
    ]
)

# Rules of a line.  Fixed wording and limits, chosen for this operator.
SYMBOLS = re.compile(rb"[#*$%&|<>]")
#: A line that is a list of short links: parts between bars, arrows, bullets or slashes.
SEPARATORS = re.compile(r"[ \t-\r](?:\||»|›|·|•|>|/)(?:[ \t-\r]|\Z)")
#: Notices and calls to action by language of the corpus; fixed wording in lower case.
PHRASES = {
    "en": (
        "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy",
        "cookie policy", "accept cookies", "enable javascript", "subscribe to our newsletter", "click here to", "sign up now",
    ),
    "de": (
        "alle rechte vorbehalten", "lizenziert unter", "veröffentlicht unter der", "nutzungsbedingungen", "datenschutzerklärung",
        "cookie-richtlinie", "cookies akzeptieren", "javascript aktivieren", "newsletter abonnieren", "klicken sie hier", "jetzt registrieren",
    ),
    "fr": (
        "tous droits réservés", "distribué sous licence", "conditions d'utilisation", "politique de confidentialité",
        "politique de cookies", "accepter les cookies", "activer javascript", "abonnez-vous à notre", "cliquez ici", "inscrivez-vous maintenant",
    ),
    "es": (
        "todos los derechos reservados", "publicado bajo licencia", "términos de uso", "términos de servicio", "política de privacidad",
        "política de cookies", "aceptar cookies", "activar javascript", "suscríbase a nuestro", "haga clic aquí", "regístrese ahora",
    ),
}
#: A phrase begins a word; an English one ends a word too, the others may be inflected.
PATTERN = r"\b(?:" + "|".join(p + r"\b" * (lang == "en") for lang, own in PHRASES.items() for p in own) + ")"
BOILERPLATE = re.compile(PATTERN.encode())
#: A word that ends in a mark.
MARKED = re.compile(r"[.!?…:;\"'”’»)\]。！？](?:[ \t-\r]|\Z)")


def line_fails(line: str, words: int, symbol_share: float, min_words: int, min_parts: int) -> bool:
    """Whether a line of so many words (at least one) is navigation, boilerplate or badly punctuated.

    * navigation: at least ``min_parts`` parts between separators;
    * boilerplate: one of the fixed phrases (A-Z as a-z), whatever the line's language;
    * punctuation: more symbol characters than ``symbol_share`` of its words, or
      ``min_words`` words or more, none of which ends in a mark.
    """
    if len(SEPARATORS.findall(line)) + 1 >= min_parts:
        return True
    raw = line.encode()
    if BOILERPLATE.search(raw.lower()):
        return True
    if len(SYMBOLS.findall(raw)) > symbol_share * words:
        return True
    return words >= min_words and not MARKED.search(line)


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    max_lost: float = 0.3,
    symbol_share: float = 0.25,
    min_words: int = 8,
    min_parts: int = 3,
) -> DataFrame:
    """Judge every line, cut failing lines, then keep documents that lose little.

    Adds the base counts of a document (words, their code points, symbol
    characters, repeated lines, words in repeated 5-word windows),
    ``n_words_lost`` (words of failing lines), ``base_failed``, ``kept`` and
    ``kept_text`` (the text without failing lines; empty lines stay).

    A document fails the base rules if it has fewer than 10 words or if over a
    fifth of its words are in 5-word windows that occur twice.  A document that
    passes is kept if at most ``max_lost`` of its words are in failing lines.
    Null and empty texts have no words and are not kept.  Whole texts are
    judged, row by row, so nothing is shuffled and repeated rows get one answer.
    """

    def judge(texts):
        out = {n: [] for n in RESULT.names}
        words = Words.of(texts)
        hashes = words.hashes()
        covered = _repeated(hashes, words.bounds)
        owner = words.owners()
        repeats = np.bincount(owner[covered], minlength=len(texts))
        for i, raw in enumerate(texts):
            n = int(words.bounds[i + 1] - words.bounds[i])
            kept_lines, lost, seen, repeated_lines = [], 0, set(), 0
            for line in raw.split(b"\n"):
                here = len(line.split())
                if here:
                    repeated_lines += line in seen
                    seen.add(line)
                    if line_fails(line.decode(), here, symbol_share, min_words, min_parts):
                        lost += here
                        continue
                kept_lines.append(line)
            failed = n < 10 or 100 * int(repeats[i]) > 20 * n
            own = b"".join(words.words[words.bounds[i] : words.bounds[i + 1]])
            out["n_words"].append(n)
            out["word_chars"].append(len(own.decode()))
            out["n_symbols"].append(len(SYMBOLS.findall(raw)))
            out["n_dup_lines"].append(repeated_lines)
            out["n_repeat_words"].append(int(repeats[i]))
            out["n_words_lost"].append(lost)
            out["base_failed"].append(failed)
            out["kept"].append(not failed and lost <= max_lost * n)
            out["kept_text"].append(b"\n".join(kept_lines).decode())
        return out

    return over_text(docs, judge, RESULT, text)


def _repeated(hashes: np.ndarray, bounds: np.ndarray, n: int = 5) -> np.ndarray:
    """Which words are in an ``n``-word window that its own text holds twice or more."""
    covered = np.zeros(len(hashes), dtype=bool)
    begin = np.flatnonzero(starts(bounds, n))
    if not len(begin):
        return covered
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[begin]
    values = grams(hashes, n)[begin]
    order = np.lexsort((values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(begin), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for i in range(n):
        covered[begin[twice] + i] = True
    return covered
