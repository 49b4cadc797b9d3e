"""Token counts by a finite-state transducer."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import over_text
from .transducer import CHUNK, transducer

RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

#: Chunks' lengths from which a chunk is read by state maps of its pieces (fewer pieces are too few to read side by side).
LONG = 64

#: Last bytes of the white space characters outside ASCII.
_WIDE_SPACE_ENDS = [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]


def synchronising(data: np.ndarray) -> np.ndarray:
    """Places where every state leads to the same: white space after a character that is none.

    A word always ends there, and no special string can be open, so what comes
    after does not depend on the state before.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.ones(256, dtype=bool)
    before[:33] = False
    before[_WIDE_SPACE_ENDS] = False
    at = np.flatnonzero(space[1:] & before[data[:-1]]) + 1
    return at


def chunks(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts into chunks of about ``size`` bytes; returns the chunks' bounds and the texts' first chunks.

    Every chunk begins where its text does or at a synchronising place.
    """
    places = synchronising(data)
    text = np.searchsorted(bounds, places, side="right") - 1
    inside = places > bounds[text]
    places, text = places[inside], text[inside]
    block = (places - bounds[text]) // size
    first = np.ones(len(places), dtype=bool)
    first[1:] = (block[1:] != block[:-1]) | (text[1:] != text[:-1])
    cuts = np.sort(np.concatenate([bounds[:-1], places[first & (block > 0)]]), kind="stable")
    return cuts, np.searchsorted(cuts, bounds[:-1], side="left")


def count_tokens(docs: DataFrame, path: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` for a byte-level vocabulary file.

    The vocabulary is compiled to a transducer whose transitions carry numbers of
    tokens.  Texts are cut into chunks; a chunk from a synchronising place on
    maps every state to one state and one count, so the chunks of all texts of a
    step are read side by side, and maps compose by adding the counts before
    each place: a prefix sum over chunks, of which each text takes a difference.
    A chunk that is longer than ``LONG`` chunks, for want of such places, is cut
    anywhere: its pieces get maps with the states that they may be entered in,
    and the maps are composed by a prefix scan.

    A null or empty text has no bytes and no tokens.  Nothing is shuffled, and a
    repeated row gets the same answer.
    """

    def run(texts):
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        full = np.flatnonzero(np.diff(bounds))  # empty texts have no chunk
        total = np.zeros(len(texts), dtype=np.int64)
        if len(full):
            cuts, first = chunks(data, np.append(bounds[full], bounds[-1]), chunk)
            ends = np.append(cuts[1:], bounds[-1])
            machine, counts = transducer(path), np.zeros(len(cuts), dtype=np.int64)
            long = ends - cuts > LONG * chunk
            counts[~long] = machine.run(data, cuts[~long], ends[~long])
            for i in np.flatnonzero(long).tolist():
                counts[i] = machine.run_stretch(data, int(cuts[i]), int(ends[i]), chunk)
            before = np.concatenate([[0], np.cumsum(counts)])
            total[full] = before[np.append(first[1:], len(cuts))] - before[first]
        return {"n_bytes": np.diff(bounds), "n_tokens": total}

    # long steps: the more chunks are read side by side, the less each costs
    return over_text(docs, run, RESULT, text, step_bytes=4 << 20)
