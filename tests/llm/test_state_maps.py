import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_counts, transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def stretches():
    random.seed(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        "letters": "".join(random.choice(letters) for _ in range(5000)),
        "one letter": "a" * 4099,
        "dashes": "-=" * 2500,
        "wide": "".join(random.choice("日本語中文字漢한국어") for _ in range(3000)),
        "signs": "".join(random.choice("ab'sré漢é😀<|endoftext|>9.!-") for _ in range(4000)),
        "special": "x<|endoftext|>" * 300,
        "words": "internationalization" * 200,
        "wide space": "字　" * 1500,
        "spaces": " " * 4000 + "x",
    }


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("name", stretches())
@pytest.mark.parametrize("size", [7, 64, 1000])
def test_a_stretch_by_maps_of_its_pieces(library, name, size):
    text = stretches()[name][: 1500 if size == 7 else None]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    machine = transducer.transducer(PATH)
    assert machine.run_stretch(data, 0, len(data), size) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("rounds", [0, 1])
def test_wrong_guesses_are_mended(library, monkeypatch, rounds):
    """Without a look at the bytes before hardly a guess is right, and one round settles little."""
    monkeypatch.setattr(transducer, "WARM", 0)
    monkeypatch.setattr(transducer, "ROUNDS", rounds)
    for text in stretches().values():
        text = text[:1200]
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        found = transducer.transducer(PATH).run_stretch(data, 0, len(data), 50)
        assert found == len(library.encode(text, add_special_tokens=False).ids)


def test_maps_compose_and_leave_out_what_is_unknown():
    maps = [{"s": ("a", 1)}, {"a": ("b", 2), "x": ("y", 9)}, {"b": ("c", 3)}, {"q": ("r", 1)}, {"r": ("s", 1)}]
    reached = transducer.prefix_maps(maps)
    assert [m.get("s") for m in reached] == [("a", 1), ("b", 3), ("c", 6), None, None]


def test_long_texts_in_a_table(documents, library):
    texts = [*stretches().values(), "some words " * 900 + "b" * 6000 + " more words" * 50, "", None]
    got = token_counts.count_tokens(documents(list(enumerate(texts))), PATH, chunk=32).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == {
        i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)
    }
