"""A byte-level tokenizer compiled to a deterministic transducer that counts tokens.

Reading a byte leads from one state to the next and adds to the number of tokens
of what has been read (it may also take away, where a byte completes a longer
token).  A state holds all that the future depends on:

* how much of a special string may have begun;
* the bytes of an unfinished character;
* where the splitter into words stands;
* the window of the open word: the letters with which a token may have begun,
  the last token and the relative count at each of these places.

Tokens have a bounded length, so the states are finite.  They are made and
numbered when first met; a full table is emptied, also while texts are read, and
filled again from the states of the open chunks, which changes no result.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from .bpe import Merges
from .tokens import byte_letters

#: States that a worker tabulates at most, and slots for their transitions (a few for each state).
TABLE_STATES, SLOTS = 1 << 18, 21
#: Bytes of a chunk, and the number of chunks below which they are read one by one.
CHUNK, FEW = 1024, 24
#: Bytes before a piece that its entry state is guessed from, and rounds in which all exits become entries.
WARM, ROUNDS = 128, 8

SPACE, LETTER, NUMBER, OTHER = "space", "letter", "number", "other"
#: Word endings that a splitter of this kind keeps together (fixed by the vocabulary's format).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
EMPTY = ("", (None,), (0,))
START = (0, b"", None, "", EMPTY)


def room() -> int:
    return 3 << SLOTS >> 2


class Transducer:
    def __init__(self, path: str):
        import regex

        model = json.load(open(path))
        self.letter = {b: c for c, b in byte_letters().items()}
        self.merges = Merges([tuple(m) for m in model["model"]["merges"]])
        self.begun = {t[:i] for t in self.merges.tokens for i in range(1, len(t))}
        # One special string can be told from text while reading if no proper start of it is also its end.
        (self.special,) = [t["content"].encode() for t in model["added_tokens"]]
        assert all(not self.special.endswith(self.special[:i]) for i in range(1, len(self.special)))
        self.kinds = [(SPACE, regex.compile(r"\s")), (LETTER, regex.compile(r"\p{L}")), (NUMBER, regex.compile(r"\p{N}"))]
        self.kind_of: dict[str, str] = {}
        self.clear()

    def clear(self) -> None:
        self.number = {START: 0}
        self.states = [START]
        self.ends = [0]
        # Open addressing: a state and a byte, then the next state and the count (plus 128).
        self.moves = np.full((1 << SLOTS, 2), -1, dtype=np.int32)
        self.filled = 0
        self.most = TABLE_STATES

    def is_full(self, new: int) -> bool:
        """Whether ``new`` transitions more would leave less than a quarter of the slots free."""
        return self.filled + new > room() or len(self.states) > self.most

    def anew(self, state: np.ndarray) -> np.ndarray:
        """Empty the tables but for the states of open chunks, and number these anew."""
        live, at = np.unique(state, return_inverse=True)
        kept = [self.states[i] for i in live.tolist()]
        self.clear()
        numbers = np.array([self.intern(one) for one in kept], dtype=np.int32)
        self.most = max(TABLE_STATES, 2 * len(self.states))
        return numbers[at]

    # One word: the window of its last places.

    def letter_step(self, window, letter: str):
        seen, last, counts = window
        now = seen + letter
        n = len(now)
        for size in range(min(n, self.merges.reach.get(now[-2:], 1)), 1, -1):
            token = now[n - size :]
            if token in self.merges.tokens:
                at = n - size
                if last[at] is None or self.merges.stand(last[at], token):
                    break
        else:
            token, at = letter, n - 1
        delta = counts[at] + 1
        keep = n
        while keep and now[n - keep :] not in self.begun:
            keep -= 1
        places, rest = [], []
        for i in range(n - keep, n):  # a place where no token can have begun is of no use
            useful = now[i:] in self.begun
            places.append(last[i] if useful else "")
            rest.append(counts[i] - delta if useful else 0)
        return (now[n - keep :], (*places, token), (*rest, 0)), delta

    def word_step(self, window, text: str):
        total = 0
        for byte in text.encode():
            window, delta = self.letter_step(window, self.letter[byte])
            total += delta
        return window, total

    # The splitter: one character.

    def kind(self, char: str) -> str:
        known = self.kind_of.get(char)
        if known is None:
            known = self.kind_of[char] = next((k for k, p in self.kinds if p.match(char)), OTHER)
        return known

    def char_step(self, mode, held: str, window, char: str):
        """``held``: the last white space of a run, or letters after an apostrophe that may be a contraction."""
        kind, total = self.kind(char), 0
        if mode == "apostrophe":
            tail = held + char
            if tail in CONTRACTIONS:
                _, total = self.word_step(window, tail)
                return (None, "", EMPTY), total
            if any(c.startswith(tail) for c in CONTRACTIONS):
                return ("apostrophe", tail, window), 0
            if held:  # no contraction: the letters begin a word of their own
                window, total = self.word_step(EMPTY, held)
                mode, held = LETTER, ""
            else:
                mode = OTHER
        if mode == SPACE:
            if kind == SPACE:
                window, total = self.word_step(window, held)
                return (SPACE, char, window), total
            window, total = self.word_step(EMPTY, held)
            if held != " ":
                mode, window = None, EMPTY
            else:
                mode = kind
        elif mode != kind:
            mode, window = None, EMPTY
        if kind == SPACE:
            return (SPACE, char, EMPTY), total
        alone = mode is None
        window, more = self.word_step(window, char)
        if alone and char == "'":
            return ("apostrophe", "", window), total + more
        return (kind, "", window), total + more

    def byte_step(self, rest, byte: int):
        begun, mode, held, window = rest
        begun += bytes([byte])
        try:
            char = begun.decode()
        except UnicodeDecodeError:
            return (begun, mode, held, window), 0
        after, total = self.char_step(mode, held, window, char)
        return (b"", *after), total

    # The whole machine.

    def step(self, state, byte: int):
        matched, *rest = state
        if byte == self.special[matched]:
            if matched + 1 == len(self.special):
                return START, self.end((0, *rest)) + 1
            return (matched + 1, *rest), 0
        total = 0
        for b in self.special[:matched]:
            rest, delta = self.byte_step(rest, b)
            total += delta
        if matched and byte == self.special[0]:
            return (1, *rest), total
        rest, delta = self.byte_step(rest, byte)
        return (0, *rest), total + delta

    def end(self, state) -> int:
        """What the end of a text adds."""
        matched, *rest = state
        total = 0
        for b in self.special[:matched]:
            rest, delta = self.byte_step(rest, b)
            total += delta
        _, mode, held, window = rest
        if mode == SPACE:
            total += self.word_step(window, held)[1]
        elif mode == "apostrophe" and held:
            total += self.word_step(EMPTY, held)[1]
        return total

    def intern(self, state) -> int:
        known = self.number.get(state)
        if known is None:
            known = self.number[state] = len(self.states)
            self.states.append(state)
            self.ends.append(self.end(state))
        return known

    def fill(self, key: int) -> int:
        after, delta = self.step(self.states[key >> 8], key & 255)
        value = self.intern(after) << 8 | delta + 128
        slot, mask = (key * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - SLOTS), (1 << SLOTS) - 1
        while self.moves[slot, 0] >= 0:
            slot = slot + 1 & mask
        self.moves[slot] = key, value
        self.filled += 1
        return value

    def look(self, keys: np.ndarray) -> np.ndarray:
        """Values of transitions, of which new ones are made first."""
        mask = np.uint32((1 << SLOTS) - 1)
        slot = (keys.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOTS)
        found = self.moves[slot]
        open_ = np.flatnonzero(found[:, 0] != keys)
        while len(open_):
            empty = found[open_, 0] < 0
            if empty.any():
                for key in np.unique(keys[open_[empty]]).tolist():
                    self.fill(key)
                return self.look(keys)
            slot[open_] = slot[open_] + np.uint32(1) & mask
            found[open_] = self.moves[slot[open_]]
            open_ = open_[found[open_, 0] != keys[open_]]
        return found[:, 1]

    def run(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each chunk, all chunks read side by side, each from the start state to its end."""
        state, total = self.read(data, begin, end, np.zeros(len(begin), dtype=np.int32))
        total += np.array(self.ends, dtype=np.int64)[state]
        if len(self.states) > TABLE_STATES:
            self.clear()
        return total

    def read(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state after each chunk and the count on the way, from the given states on."""
        order = np.argsort(begin - end, kind="stable")
        begin, length, state = begin[order], (end - begin)[order], state[order]
        total = np.zeros(len(begin), dtype=np.int64)
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        done = 0
        for m in active.tolist():
            if m < FEW:
                break
            for i in range(0, m, room()):
                j = min(m, i + room())
                if self.is_full(j - i):
                    state = self.anew(state)
                value = self.look(state[i:j] * np.int32(256) + data[begin[i:j] + done])
                state[i:j] = value >> 8
                total[i:j] += (value & 255) - 128
            done += 1
        for i in np.flatnonzero(length > done).tolist():
            s, t, known = int(state[i]), 0, {}
            for b in data[begin[i] + done : begin[i] + length[i]].tolist():
                key = s << 8 | b
                value = known.get(key)
                if value is None:
                    if self.is_full(1):
                        state[i] = s
                        state, known = self.anew(state), {}
                        key = int(state[i]) << 8 | b
                    value = known[key] = int(self.look(np.array([key], dtype=np.int32))[0])
                s = value >> 8
                t += (value & 255) - 128
            state[i] = s
            total[i] += t
        after, out = np.empty_like(state), np.empty_like(total)
        after[order], out[order] = state, total
        return after, out

    # Stretches whose pieces begin in a state that is not known beforehand.

    def maps(self, data: np.ndarray, pieces: list[tuple[int, int]], entries: list) -> list[tuple]:
        """For each piece and the state it is entered in: the state after it, and the count."""
        begin, end = (np.array(x, dtype=np.int64) for x in zip(*pieces))
        state = np.array([self.intern(e) for e in entries], dtype=np.int32)
        after, total = self.read(data, begin, end, state)
        found = [(self.states[s], t) for s, t in zip(after.tolist(), total.tolist())]
        if len(self.states) > TABLE_STATES:
            self.clear()
        return found

    def run_stretch(self, data: np.ndarray, begin: int, end: int, size: int) -> int:
        """Tokens of one long chunk, from the start state to its end, by state maps of its pieces.

        Every piece gets a map from entry states to the state after it and the
        count.  First it holds the state that some bytes before the piece lead
        to, which mostly is the right one.  Maps compose by a prefix scan; where
        a map leads to a state that the next map lacks, it is added and read.
        What some rounds have not settled is read on from the last known state,
        so the count does not depend on the guesses.
        """
        cuts = character_starts(data, np.arange(begin + size, end, size), end)
        cuts = [begin, *np.unique(cuts[cuts < end]).tolist()]
        pieces = list(zip(cuts, [*cuts[1:], end]))
        ahead = character_starts(data, np.maximum(begin, np.array(cuts[1:], dtype=np.int64) - WARM), end).tolist()
        guesses = self.maps(data, list(zip(ahead, cuts[1:])), [START] * len(ahead)) if ahead else []
        held: list[dict] = [{} for _ in pieces]
        wanted = {(0, START), *((i + 1, state) for i, (state, _) in enumerate(guesses))}
        state, total, settled = START, 0, 0
        for _ in range(ROUNDS):
            asked = list(wanted)
            for (i, entry), leads in zip(asked, self.maps(data, [pieces[i] for i, _ in asked], [e for _, e in asked])):
                held[i][entry] = leads
            reached = prefix_maps(held)
            settled = sum(1 for m in reached if START in m)
            state, total = reached[settled - 1][START]
            if settled == len(pieces):
                break
            wanted = {
                (i, after) for i in range(settled, len(pieces)) for after, _ in held[i - 1].values() if after not in held[i]
            }
        for i in range(settled, len(pieces)):
            if state not in held[i]:
                (held[i][state],) = self.maps(data, [pieces[i]], [state])
            state, more = held[i][state]
            total += more
        return total + self.end(state)


def character_starts(data: np.ndarray, places: np.ndarray, end: int) -> np.ndarray:
    """Each place, or the first after it where a character begins."""
    places = places.copy()
    while len(inside := np.flatnonzero(places < end)):
        within = inside[(data[places[inside]] & 0xC0) == 0x80]
        if not len(within):
            break
        places[within] += 1
    return places


def prefix_maps(maps: list[dict]) -> list[dict]:
    """The maps of all pieces up to each, by doubling; an entry that a later map lacks is left out."""
    reached, reach = list(maps), 1
    while reach < len(maps):
        reached = reached[:reach] + [
            {
                entry: (later[state][0], total + later[state][1])
                for entry, (state, total) in earlier.items()
                if state in later
            }
            for earlier, later in zip(reached, reached[reach:])
        ]
        reach *= 2
    return reached


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)
