"""Runs of repeated words inside a text, from a suffix automaton whose link tree is recoloured word by word."""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import over_text
from .words import Words, grams, mixed, starts

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("collapsed_text", T.StringType()),
    ]
)


class LinkTree:
    """The suffix links of a growing automaton as a link-cut tree of last occurrences.

    A preferred path is a splay tree ordered by length; its root knows where the
    path's strings ended last.  ``up`` of such a root is the state above the path.
    The automaton's first state is 1 and is in no path.
    """

    def __init__(self):
        self.left, self.right, self.up = array("i", [0, 0]), array("i", [0, 0]), array("i", [0, 0])
        self.seen = array("i", [0, 0])

    def add(self) -> None:
        for field in (self.left, self.right, self.up, self.seen):
            field.append(0)

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its preferred path."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self.seen[x] = self.seen[z]
                self.rotate(y if (left[z] == y) == (left[y] == x) else x)
            else:
                self.seen[x] = self.seen[y]
            self.rotate(x)
            y = up[x]

    def rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        if left[y] == x:
            moved = left[y] = right[x]
            right[x] = y
        else:
            moved = right[y] = left[x]
            left[x] = y
        if moved:
            up[moved] = y
        z = up[x] = up[y]
        up[y] = x
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def insert_above(self, state: int, new: int) -> None:
        """Link ``new`` between ``state`` and what stands above it; it has the same last occurrence."""
        self.splay(state)
        above = self.left[new] = self.left[state]
        if above:
            self.up[above] = new
        self.left[state], self.up[new] = new, state

    def access(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolour the path from ``state`` to the top: all its strings end at ``end``.

        Returns, for each path segment of one colour above ``state``, the longest
        state on it and where its strings ended last before.
        """
        right, up, seen = self.right, self.up, self.seen
        found, below = [], state
        x = up[state]
        while x:
            self.splay(x)
            found.append((x, seen[x]))
            if right[x]:
                seen[right[x]] = seen[x]
            right[x] = below
            below, x = x, up[x]
        seen[below] = end
        return found


def runs_of(codes: list[int], min_length: int = 12) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``min_length`` and two periods.

    Each word is appended to a suffix automaton, and the path of its state in
    the link tree is recoloured.  A segment last seen ``d`` words ago whose
    strings are at least ``d`` long is a square of period ``d`` that ends here; a
    run is a square found at every further word.  The segment's length tells
    where the run began.
    """
    length, link, step = array("i", [0, 0]), array("i", [0, 0]), [None, {}]
    tree = LinkTree()
    last, going, runs = 1, {}, []

    def state(size: int, steps: dict, above: int) -> int:
        length.append(size)
        link.append(above)
        step.append(steps)
        tree.add()
        return len(length) - 1

    for end, word in enumerate(codes):
        p = last
        last = state(length[p] + 1, {}, 1)
        while p and word not in step[p]:
            step[p][word] = last
            p = link[p]
        if p:
            q = step[p][word]
            if length[q] != length[p] + 1:
                old, q = q, state(length[p] + 1, dict(step[q]), link[q])
                tree.insert_above(old, q)
                link[old] = q
                while p and step[p].get(word) == old:
                    step[p][word] = q
                    p = link[p]
            link[last] = tree.up[last] = q
        for x, before in tree.access(last, end):
            period, size = end - before, length[x]
            if period <= size:
                run = going.get(period)
                if run and run[1] == end - 1:
                    run[1] = end
                else:
                    if run:
                        runs.append((run[0], run[1] + 1 - run[0], period))
                    going[period] = [end - size - period + 1, end]
    runs += [(first, end + 1 - first, period) for period, (first, end) in going.items()]
    return sorted((s, n, p) for s, n, p in runs if n >= min_length)


def repetitive(words: Words, seed: int) -> list[tuple[int, int]]:
    """Stretches of words (over all texts) outside of which no run of ``2 * seed`` words can be.

    Each word of such a run is in a ``seed``-word window that its own stretch
    holds again, at most half the stretch away.
    """
    hashes, owner = words.hashes(), words.owners()
    begin = np.flatnonzero(starts(words.bounds, seed))
    if not len(begin):
        return []
    values = grams(hashes, seed)[begin] ^ mixed(owner[begin].astype(np.uint64) + np.uint64(1))
    order = np.argsort(values, kind="stable")
    placed = begin[order]
    same = values[order][1:] == values[order][:-1]
    gap = np.where(same, placed[1:] - placed[:-1], np.iinfo(np.int64).max)
    none = gap.dtype.type(np.iinfo(np.int64).max)
    near = np.minimum(np.append(gap, none), np.append(none, gap))
    hit = near < none
    at, near = placed[hit], near[hit]
    order = np.argsort(at)
    at, near = at[order], near[order]
    while len(at):
        cut = np.flatnonzero((at[1:] - at[:-1] > seed) | (owner[at[1:]] != owner[at[:-1]])) + 1
        first, past = np.append(0, cut), np.append(cut, len(at))
        size = at[past - 1] + seed - at[first]
        keep = 2 * near <= np.repeat(size, past - first)
        if keep.all():
            return list(zip(at[first].tolist(), (at[first] + size).tolist(), strict=True))
        at, near = at[keep], near[keep]
    return []


def find_runs(docs: DataFrame, text: str = "text", min_length: int = 12) -> DataFrame:
    """Add ``n_words``, ``runs``, ``n_dropped`` and ``collapsed_text``.

    A run is a longest stretch of consecutive words with smallest period ``p``, of
    at least ``min_length`` words and two periods: ``[first word, length, p]``,
    ordered by start, then period.  Words that some run holds after its first
    period are dropped; the others, joined by one space, are the collapsed text.

    Only stretches of a text that repeat themselves go through the automaton:
    outside of them no run can be (see :func:`repetitive`).  A text is one task's
    business; the automaton holds about 100 bytes and a small table for a word.

    Null and empty texts have no words and no runs and collapse to the empty
    text.  Nothing is shuffled; repeated rows get the same answer.
    """
    seed = max(1, min_length // 2)

    def run(texts):
        out = {n: [] for n in RESULT.names}
        words = Words.of(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for a, b in repetitive(words, seed):
            names: dict[bytes, int] = {}
            codes = [names.setdefault(w, len(names)) for w in words.words[a:b]]
            doc = int(np.searchsorted(words.bounds, a, side="right")) - 1
            at = a - int(words.bounds[doc])
            found[doc] += [(at + s, n, p) for s, n, p in runs_of(codes, min_length)]
        for i, one in enumerate(texts):
            own, runs = words.words[words.bounds[i] : words.bounds[i + 1]], sorted(found[i], key=lambda r: (r[0], r[2]))
            kept = own
            if runs:
                change = np.zeros(len(own) + 1, dtype=np.int64)
                for s, n, p in runs:
                    change[s + p] += 1
                    change[s + n] -= 1
                kept = [own[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
            out["n_words"].append(len(own))
            out["runs"].append([list(r) for r in runs])
            out["n_dropped"].append(len(own) - len(kept))
            out["collapsed_text"].append(b" ".join(kept).decode())
        return out

    return over_text(docs, run, RESULT, text)
