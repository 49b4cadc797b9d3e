"""A public tokenizer as a worker-side helper."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies spell bytes.

    Printable Latin-1 characters stand for themselves, the other bytes for the
    characters from code point 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _loaded(path: str):
    import public_tokenizers
    import tiktoken

    model = json.load(open(path))
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Ids of a byte-level vocabulary file, special strings inside texts recognised.

    The file's vocabulary numbers its merges in order, so they are handed to
    the faster of two libraries that give the same ids.
    """

    def __init__(self, path: str):
        self.path = path

    def ids(self, text: str) -> np.ndarray:
        return np.array(_loaded(self.path).encode(text, allowed_special="all"), dtype=np.uint32)
