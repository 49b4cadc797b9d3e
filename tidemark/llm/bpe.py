"""Byte-pair encodings of prefixes, by their last tokens.

The encoding of a string is fixed by the last token of each of its prefixes:
the last token of a prefix is the one token that ends it and that does not merge
across its left edge with the last token of what stands before.  Which tokens end
a prefix follows from the longest of their beginnings that ends it, so a state of
the walk is that beginning and the last token.
"""

from __future__ import annotations

from collections import deque


class Merges:
    """The merge list of a vocabulary whose symbols are letters, a word's last one perhaps with a suffix."""

    def __init__(self, merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.rank = {pair: i for i, pair in enumerate(merges)}
        #: Tokens of two letters or more that occur as a token of their own spelling, with their number of letters.
        self.tokens: dict[str, int] = {}
        for a, b in merges:
            parts = self.letters(a + b)
            if self.encode(parts) == [a + b]:
                self.tokens[a + b] = len(parts)
        #: The longest token by its last two letters.
        self.reach: dict[str, int] = {}
        for token, size in self.tokens.items():
            end = "".join(self.letters(token)[-2:])
            self.reach[end] = max(size, self.reach.get(end, 1))
        self.pairs: dict[tuple[str, str], bool] = {}
        self._link()

    def _link(self) -> None:
        """A trie of the tokens by letters; per node what follows, and the tokens that end there, longest first."""
        self.follow: list[dict[str, int]] = [{}]
        own: list[str | None] = [None]
        for token in self.tokens:
            node = 0
            for letter in self.letters(token):
                following = self.follow[node].get(letter)
                if following is None:
                    following = self.follow[node][letter] = len(self.follow)
                    self.follow.append({})
                    own.append(None)
                node = following
            own[node] = token
        self.shorter = [0] * len(self.follow)
        self.ends: list[tuple[tuple[str, int], ...]] = [()] * len(self.follow)
        waiting = deque(self.follow[0].values())
        while waiting:
            node = waiting.popleft()
            rest = self.ends[self.shorter[node]]
            self.ends[node] = ((own[node], self.tokens[own[node]]), *rest) if own[node] else rest
            for letter, following in self.follow[node].items():
                at = self.shorter[node]
                while at and letter not in self.follow[at]:
                    at = self.shorter[at]
                self.shorter[following] = self.follow[at].get(letter, 0) if node else 0
                waiting.append(following)

    def letters(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix):
            word = token[: -len(self.suffix)]
            return [*word[:-1], word[-1:] + self.suffix]
        return [*token]

    def encode(self, letters: list[str]) -> list[str]:
        """By the rules: merge the pair of lowest rank, from the left, until none is left."""
        parts, rank, none = list(letters), self.rank.get, 1 << 60
        while len(parts) > 1:
            ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stand(self, left: str, right: str) -> bool:
        """Whether two tokens next to each other stay as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.encode(self.letters(left) + self.letters(right)) == [left, right]
            self.pairs[left, right] = known
        return known


class Prefixes:
    """A walk over a trie of words: keeps the states of the current path only."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.path = ""
        #: By prefix: the beginning of a token that ends it, its last token, and that token's letters.
        self.nodes, self.last, self.sizes = [0], [""], [0]

    def encode(self, word: str) -> list[str]:
        """Go to the node of ``word`` from where the walk stands, and read its tokens."""
        merges, nodes, last, sizes = self.merges, self.nodes, self.last, self.sizes
        ends, follow, shorter, known, stand = merges.ends, merges.follow, merges.shorter, merges.pairs.get, merges.stand
        inner = len(word) - 1 if merges.suffix else len(word)
        same, path = 0, self.path
        if word.startswith(path):
            same = min(len(path), inner)
        else:
            for a, b in zip(path, word[:inner]):
                if a != b:
                    break
                same += 1
        del nodes[same + 1 :], last[same + 1 :], sizes[same + 1 :]
        node = nodes[same]
        for i in range(same, len(word)):
            letter = word[i] if i < inner else word[i] + merges.suffix
            following = follow[node].get(letter)
            while following is None and node:
                node = shorter[node]
                following = follow[node].get(letter)
            node = following or 0
            for token, size in ends[node]:
                if size == i + 1:
                    break
                before = last[i + 1 - size]
                fits = known((before, token))
                if fits or (fits is None and stand(before, token)):
                    break
            else:
                token, size = letter, 1
            if i == inner:
                break
            nodes.append(node)
            last.append(token)
            sizes.append(size)
        self.path = word[:inner]
        out, at = [], len(word)
        if inner < at:
            out.append(token)
            at -= size
        while at:
            out.append(last[at])
            at -= sizes[at]
        return out[::-1]
