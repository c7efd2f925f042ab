"""Many words sought at once in many texts: an automaton in arrays, stepped over a batch of texts together."""

from __future__ import annotations

import numpy as np


class Automaton:
    """Goto, failure and output functions of a set of words, failures resolved into one table of states by letters.

    Letters that no word has are one column.  ``word[s]`` is the longest word that ends
    in state s, ``shorter[s]`` the state of the next shorter one; -1 where there is none.
    """

    def __init__(self, words: list[str]):
        self.words = sorted({w for w in words if w})
        points = sorted({ord(c) for w in self.words for c in w})
        self.points = np.array(points, np.int64)
        codes = {p: i + 1 for i, p in enumerate(points)}
        goto: list[dict[int, int]] = [{}]
        word = [-1]
        for k, w in enumerate(self.words):
            at = 0
            for c in w:
                code = codes[ord(c)]
                if code not in goto[at]:
                    goto[at][code] = len(goto)
                    goto.append({})
                    word.append(-1)
                at = goto[at][code]
            word[at] = k
        self.table = np.zeros((len(goto), len(points) + 1), np.int32)
        self.word, self.shorter = np.array(word, np.int64), np.full(len(goto), -1, np.int64)
        fail = np.zeros(len(goto), np.int64)
        level = [0]
        while level:  # by depth: a state's failure is nearer to the root
            after = []
            for s in level:
                row = self.table[fail[s]].copy() if s else self.table[0]
                for code, to in goto[s].items():
                    fail[to] = self.table[fail[s], code] if s else 0
                    row[code] = to
                    after.append(to)
                self.table[s] = row
            for s in after:
                f = fail[s]
                self.shorter[s] = f if self.word[f] >= 0 else self.shorter[f]
            level = after

    def found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, word) by their places, each pair once."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        point = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not len(point) or not len(self.points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.points, point), len(self.points) - 1)
        code = np.where(self.points[at] == point, at + 1, 0)
        start = (np.cumsum(sizes) - sizes)[order]
        state = np.zeros(len(texts), np.int64)
        ends = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), "right")
        pairs = []
        for i, n in enumerate(ends.tolist()):  # the n longest texts have a letter at place i
            state[:n] = self.table[state[:n], code[start[:n] + i]]
            who, s = np.arange(n), state[:n]
            while len(who):
                hit = self.word[s] >= 0
                if hit.any():
                    pairs.append(np.stack([order[who[hit]], self.word[s[hit]]], 1))
                s = self.shorter[s]
                who, s = who[s >= 0], s[s >= 0]
        both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return both[:, 0], both[:, 1]
