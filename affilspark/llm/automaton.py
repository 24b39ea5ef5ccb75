"""Suffix automaton over word sequences, with occurrence counts and matching statistics."""

from __future__ import annotations


class SuffixAutomaton:
    """All substrings of several sequences of words. add() each sequence, then count(), then match().

    A state stands for substrings that end at the same places; `seen` counts those places. Its size
    is at most twice the words added.
    """

    def __init__(self):
        self.next, self.link, self.length, self.seen = [{}], [-1], [0], [0]

    def add(self, words, times: int = 1) -> None:
        """Adds a sequence that occurs `times` times."""
        nxt, link, length, seen = self.next, self.link, self.length, self.seen
        last = 0
        for w in words:
            p = last
            if w in nxt[p]:
                q = nxt[p][w]
                if length[q] != length[p] + 1:
                    q = self._split(p, q, w)
                last = q
                seen[last] += times
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[p] + 1)
            seen.append(times)
            link.append(0)
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, w)
            last = cur

    def _split(self, p: int, q: int, w) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.seen.append(0)
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        link[q] = clone
        return clone

    def count(self) -> None:
        """Passes the counts on to shorter substrings; once, after the last add()."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.seen[self.link[state]] += self.seen[state]

    def match(self, words, least: int = 1):
        """For each word, how many words up to it are the longest suffix that occurs `least` times."""
        nxt, link, length, seen = self.next, self.link, self.length, self.seen
        state = have = 0
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                have = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                have += 1
                while state and seen[state] < least:
                    state = link[state]
                    have = length[state]
            yield have


def spans(matches, least: int) -> list[tuple[int, int]]:
    """Maximal spans (start, end) of words covered by matches of at least `least` words."""
    out: list[list[int]] = []
    for i, have in enumerate(matches):
        if have >= least:
            if out and i - have + 1 <= out[-1][1]:
                out[-1][0] = min(out[-1][0], i - have + 1)
                out[-1][1] = i + 1
                while len(out) > 1 and out[-2][1] >= out[-1][0]:
                    b = out.pop()
                    out[-1] = [min(out[-1][0], b[0]), b[1]]
            else:
                out.append([i - have + 1, i + 1])
    return [(a, b) for a, b in out]
