"""A bidirectional FM-index over a delimited vocabulary, and the search scheme for one error.

The words are a collection of strings ^w$. The index keeps the sorted suffixes
(suffix ranks), and for each place of the order how often every letter stands
before it in the column of preceding letters; the same for the reversed words.
A searched string is a pair of intervals of equal width, one in each order: a
letter put in front narrows the first exactly and shifts the second by the
letters that sort before it, and the other way round.

``near`` runs one search of the scheme: the first half of each pattern is
matched without error, from its last letter to the word's start; then the
interval is extended over the second half, where every state may spend its one
error on a replaced, missing or added letter. The other search of the scheme is
the same on reversed words.
"""

from __future__ import annotations

import numpy as np

END, START = 1, 2  # symbols; letters follow, 0 stands for none
PACKED = 16  # letters that the first sorting passes see


def _suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of the suffixes of many strings laid end to end; ``left``: symbols from each place to the end of its string.

    Suffixes that are equal keep the order of their strings. Stable passes over
    pairs of symbols (16-bit keys) order by the first ``PACKED`` symbols; what is
    still equal and longer is ordered by ranks of doubled reach.
    """
    n = len(text)
    order = np.arange(n)
    padded = np.append(text, np.zeros(PACKED + 2, dtype=np.uint16))
    for j in range(PACKED - 2, -1, -2):
        a = np.where(left > j, padded[j:j + n], 0)
        b = np.where(left > j + 1, padded[j + 1:j + 1 + n], 0)
        order = order[np.argsort((a << 8 | b)[order], kind="stable")]
    reach = PACKED
    if not (left > reach).any():
        return order
    key = np.zeros(n, dtype=bool)  # does a place of the order begin a new group
    key[0] = True
    for j in range(PACKED):
        c = np.where(left > j, padded[j:j + n], 0)[order]
        key[1:] |= c[1:] != c[:-1]
    while True:
        begin = np.maximum.accumulate(np.where(key, np.arange(n), 0))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = begin
        alone = key & np.append(key[1:], True)
        at = np.flatnonzero(~alone & (left[order] > reach))
        if not len(at):
            return order
        # whole groups: a suffix that ends within reach sorts first in its group
        at = np.flatnonzero(np.isin(begin, np.unique(begin[at])))
        who = order[at]
        rest = np.where(left[who] > reach, rank[np.minimum(who + reach, n - 1)], -1)
        by = np.lexsort((who, rest, begin[at]))
        order[at] = who[by]
        same = (begin[at][1:] == begin[at][:-1]) & (rest[by][1:] == rest[by][:-1])
        key[at[1:]] |= ~same
        reach *= 2


class Half:
    """One direction: strings of the places in suffix order, and where a symbol put in front leads."""

    def __init__(self, text: np.ndarray, start: np.ndarray, size: np.ndarray, symbols: int, companion: bool):
        n = len(text)
        owner = np.repeat(np.arange(len(start)), size)
        order = _suffix_order(text, np.repeat(start + size, size) - np.arange(n))
        before = np.append(0, text[:-1]).astype(np.uint8)
        before[start] = 0  # nothing stands before a string
        before, known = before[order], np.arange(symbols, dtype=np.uint8)[:, None]
        first = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))[:symbols]
        self.owner = owner[order]
        self.lead = self._counts(before == known, first)  # [place, c]: the place of c before the suffixes from here on
        self.below = self._counts(before < known, 0) if companion else None  # [place, c]: symbols below c before this place

    @staticmethod
    def _counts(hit: np.ndarray, base) -> np.ndarray:
        out = np.zeros((hit.shape[0], hit.shape[1] + 1), dtype=np.int32)
        out[:, 1:] = hit
        out[:, 0] = base
        np.cumsum(out, axis=1, out=out)
        return np.ascontiguousarray(out.T)

    def narrow(self, low, high, c):
        """Intervals with ``c`` put in front."""
        return self.lead[low, c], self.lead[high, c]

    def narrow_both(self, low, high, other, c):
        """Likewise, and the low end of the companion interval."""
        return *self.narrow(low, high, c), other + (self.below[high, c] - self.below[low, c])


class Index:
    """``words``: arrays of symbols above START, without repeats."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        size = np.array([len(w) for w in words]) + 2
        start = np.append(0, np.cumsum(size)[:-1])
        forward = np.empty(size.sum(), dtype=np.uint16)
        inner = np.ones(len(forward), dtype=bool)
        inner[start] = inner[start + size - 1] = False
        forward[inner] = np.concatenate(words)
        forward[start], forward[start + size - 1] = START, END
        place = np.arange(len(forward))
        mirror = forward[np.repeat(2 * start + size - 1, size) - place]
        self.symbols, self.places = symbols, len(forward)
        self.forward = Half(forward, start, size, symbols, companion=True)
        self.mirror = Half(mirror, start, size, symbols, companion=False)  # searches end in this one


def near(index: Index, patterns: list[np.ndarray], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (pattern, word) where the word begins with the pattern's first half and is one error away from it."""
    m = len(patterns)
    size = np.array([len(p) for p in patterns])
    letters = np.concatenate([x for p in patterns for x in (p, [END])])  # an END behind each pattern
    begin = np.append(0, np.cumsum(size + 1)[:-1])

    # first half, from its last letter to the start symbol, in the forward order
    who = np.arange(m)
    low, high, up = np.zeros(m, dtype=np.int64), np.full(m, index.places), np.zeros(m, dtype=np.int64)
    for step in range(halves.max() + 1):
        live = step <= halves[who]
        c = np.where(step < halves[who], letters[begin[who] + np.maximum(halves[who] - 1 - step, 0)], START)
        a, b, u = index.forward.narrow_both(low, high, up, c)
        low, high, up = np.where(live, a, low), np.where(live, b, high), np.where(live, u, up)
        some = high > low
        who, low, high, up = who[some], low[some], high[some], up[some]

    # second half, to the right: in the mirrored order a letter put in front. The width is the same there.
    mirror, found = index.mirror, [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    low, high = up, up + (high - low)
    at = halves[who]
    spent = (np.zeros(0, dtype=np.int64),) * 4  # pattern, next letter, low, high of states after their error
    letter = np.arange(START + 1, index.symbols)
    while len(who) or len(spent[0]):
        # states after the error: the rest must match
        p, j, lo, hi = spent
        c = letters[begin[p] + j]
        lo, hi = mirror.narrow(lo, hi, c)
        some = hi > lo
        p, j, lo, hi, c = p[some], j[some], lo[some], hi[some], c[some]
        done = c == END
        if done.any():
            found.append((p[done], mirror.owner[lo[done]]))
        states = [(p[~done], j[~done] + 1, lo[~done], hi[~done])]

        # states without error: spend it here, or go on
        if len(who):
            c = letters[begin[who] + at]
            inside = c != END
            states.append((who[inside], at[inside] + 1, low[inside], high[inside]))  # the letter is missing in the word
            row, col = np.nonzero(mirror.lead[high, START + 1:] > mirror.lead[low, START + 1:])  # letters that follow in some word
            col = letter[col]
            lo, hi = mirror.narrow(low[row], high[row], col)
            states.append((who[row], at[row], lo, hi))  # added
            other = (col != c[row]) & inside[row]
            states.append((who[row][other], at[row][other] + 1, lo[other], hi[other]))  # replaced
            low, high = mirror.narrow(low, high, c)
            go = inside & (high > low)
            who, at, low, high = who[go], at[go] + 1, low[go], high[go]
        spent = tuple(np.concatenate(x) for x in zip(*states))

    p, w = (np.concatenate(x) for x in zip(*found))
    pair = np.unique(np.stack((p, w)), axis=1)  # several errors can lead to the same word
    return pair[0], pair[1]
