"""Encoding and decoding with a word-level BPE vocabulary, prefixes of words shared in a trie."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import Merges, Prefixes
from .common import over_text

RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_text", T.StringType()),
        T.StructField("decoded_text", T.StringType()),
    ]
)

#: Encoded words that a worker keeps between steps; beyond it the memory is emptied.
KEPT_WORDS = 400_000


#: The pre-tokeniser's pattern on lower-cased ASCII.  Fixed wording of the vocabulary file.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n")
#: Characters that the library normalises and cuts in one call.
_CALL = 1 << 16


class WordEncoder:
    """Words to ids and back, for a vocabulary whose last letters carry a suffix."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        model = json.load(open(path))
        bpe = model["model"]
        self.merges = Merges([tuple(m) for m in bpe["merges"]], bpe["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.ids = {t: str(i) for t, i in (bpe["vocab"] | self.special).items()}
        self.spelled = {i: t for t, i in self.ids.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        tokenizer = Tokenizer.from_file(path)
        self.normal = tokenizer.normalizer.normalize_str
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        #: By run of a text without ASCII white space: number of tokens, their ids, and the tokens as text.
        self.known: dict[bytes, tuple[int, str, str]] = {}
        #: The same by word.
        self.learned: dict[str, tuple[int, str, str]] = {}
        #: Runs without a token, which leave no space.
        self.bare: set[bytes] = set()

    def decode(self, ids: Iterable[str]) -> str:
        """The text of ids in decimals.  The file has no decoder, so tokens are joined by one space."""
        return " ".join(map(self.spelled.__getitem__, ids))

    def words(self, run: str) -> list[str]:
        """The words of any run, spelled in the vocabulary's letters; special strings as they are."""
        found: list[str] = []
        for part in self.split_special.split(run):
            if part in self.special:
                found.append(part)
            elif part:
                found += [w for w, _ in self.cut(self.normal(part))]
        return found

    def words_of(self, runs: list[bytes]) -> Iterator[tuple[bytes, list[str]]]:
        """The words of each run: ASCII by the pattern, other runs many in one call of the library."""
        plain: list[bytes] = []
        others: list[tuple[bytes, str]] = []
        for run in runs:
            if run.isalpha():  # bytes: A to Z only
                yield run, [run.decode().lower()]
            elif run.isascii() and b"<|" not in run:
                plain.append(run)
            else:
                text = run.decode()
                if "<|" not in text and len(text) < _CALL and len(text.split()) == 1:
                    others.append((run, text))
                else:  # special strings, white space beyond ASCII
                    yield run, self.words(text)
        lines = b"\n".join(plain).decode()
        if lines.replace("\n", " ").isprintable():
            pieces = _ASCII_WORDS.findall(lines.lower())
            cuts = [-1, *[i for i, w in enumerate(pieces) if w == "\n"], len(pieces)]
            yield from ((run, pieces[a + 1 : b]) for run, a, b in zip(plain, cuts, cuts[1:]))
        else:
            yield from ((run, self.words(run.decode())) for run in plain)
        while others:
            held, size = 0, 0
            while held < len(others) and size < _CALL:
                size += len(others[held][1]) + 1
                held += 1
            now, others = others[:held], others[held:]
            normal = self.normal("\n".join([t for _, t in now])).split(" ")
            pieces = [w for w, _ in self.cut(" ".join(normal))]
            # every letter stands for a byte, and all of a run without white space is in its words
            ends = np.cumsum([len(n.encode()) for n in normal])
            at = np.searchsorted(np.cumsum([len(w) for w in pieces]), ends) + 1
            if len(normal) != len(now) or at[-1] != len(pieces):
                yield from ((run, self.words(text)) for run, text in now)
                continue
            for (run, _), a, b in zip(now, [0, *at.tolist()], at.tolist()):
                yield run, pieces[a:b]

    def learn(self, runs: set[bytes]) -> None:
        """Encode the distinct words of new runs in trie order, each shared prefix once."""
        known, learned, ids = self.known, self.learned, self.ids
        if len(known) > KEPT_WORDS:
            for held in (known, self.bare, learned):
                held.clear()
        new = list(self.words_of([r for r in runs if r not in known]))
        path = Prefixes(self.merges)
        for word in sorted({w for _, words in new for w in words if w not in learned}):
            tokens = [word] if word in self.special else path.encode(word)
            learned[word] = len(tokens), " ".join([ids[t] for t in tokens]), " ".join(tokens)
        for run, words in new:
            if len(words) == 1:
                known[run] = learned[words[0]]
            else:
                parts = [learned[w] for w in words]
                known[run] = sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])
                if not parts:
                    self.bare.add(run)

    def encode(self, texts: list[bytes]) -> dict[str, list]:
        split = [t.split() for t in texts]
        self.learn(set().union(*split))
        if self.bare:
            split = [[r for r in runs if r not in self.bare] for runs in split]
        out = {n: [] for n in RESULT.names}
        for runs in split:
            counts, ids, tokens = zip(*map(self.known.__getitem__, runs)) if runs else ((), (), ())
            out["n_tokens"].append(sum(counts))
            out["ids_text"].append(" ".join(ids))
            out["decoded_text"].append(" ".join(tokens))
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_text`` (decimal ids, one space between) and ``decoded_text``.

    Every step of a pass takes the distinct new words of its texts in sorted
    order, which is a depth-first walk of their trie.  A node's state is the
    last token of the encoding of its prefix, and the longest beginning of a token
    that ends it; the state of a shared prefix is computed once.  Runs between white space are remembered between steps, up to a
    fixed number.
    The decoded text is what :meth:`WordEncoder.decode` gives for the ids, put
    together from the same memory.

    A null or empty text has no tokens and decodes to the empty text.  Nothing is
    shuffled; repeated rows get the same answer.
    """

    return over_text(docs, lambda texts: _encoder(path).encode(texts), RESULT, text)


def decode_ids(docs: DataFrame, path: str, ids: str = "ids_text") -> DataFrame:
    """Add ``decoded_text`` for a column of decimal ids with one space between (null or empty: empty).

    Ids that the vocabulary lacks are an error.
    """
    schema = T.StructType([f for f in RESULT.fields if f.name == "decoded_text"])

    def run(texts):
        return {"decoded_text": [_encoder(path).decode(t.decode().split()) for t in texts]}

    return over_text(docs, run, schema, ids)
