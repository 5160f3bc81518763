"""PartEnum signatures for Jaccard similarity of sets of 64-bit numbers.

Sets with Jaccard similarity of at least g differ in at most (|A| + |B|)
(1 - g) / (1 + g) elements, so in at most k(s) = s (1 - g) / g elements for
either size s. Sizes fall into bands; a pair meets in the band of its smaller
set: every set signs for its own band and for the lower ones that may hold a
partner. A band cuts the domain into n1 partitions, each of n2 parts. A
partition in which the two sets differ in at most k2 elements has n2 - k2 parts
in which they agree fully, so each subset of n2 - k2 parts makes one signature
of the elements in it. As at most k(s) / (k2 + 1) partitions differ in more
than k2 elements, a set need sign the first partitions only, up to
k(s) // (k2 + 1) + 1 *good* ones: those that keep ``least`` elements whichever
k2 parts are left out. Then one signature that both sets have is made of
``least`` elements or more, and smaller ones need not be signed: they would
join sets that share a passage only. A set with too few good partitions lowers
``least`` as far as it must, to 0 if need be, and signs all partitions, so it
meets the signatures of any other set. Sets below the size at which k is 1
are similar to equal sets only and sign nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from itertools import combinations

import numpy as np

from .shingles import mix

SMALL_K = 3  # up to here one partition, parts enumerated by pairs
K2, N2 = 0, 1
LEAST = 2
SLACK = 3  # a band has one partition in SLACK more than must be good


class PartEnum:
    def __init__(self, percent: int = 80, largest: int = 1 << 40):
        self.g = percent
        edges = [s for s in range(1, 100 * (SMALL_K + 2)) if self.k(s) > self.k(s - 1) and self.k(s) <= SMALL_K + 1]
        self.small = len(edges) - 1
        while edges[-1] < largest:
            edges.append(-(-edges[-1] * 100 // percent))  # bands as wide as the size ratio of a pair
        self.edges = edges

    def k(self, s: int) -> int:
        """The most elements in which a set of size s and a similar set differ."""
        return s * (100 - self.g) // self.g

    def band(self, s: int) -> int:
        return bisect_right(self.edges, s) - 1

    @lru_cache(maxsize=None)
    def shape(self, band: int) -> tuple[int, int, int, list]:
        """n1, n2, k2 and the subsets of parts of a band."""
        if band < self.small:
            k2 = self.k(self.edges[band + 1] - 1)
            n1, n2 = 1, k2 + 2
        else:
            k2, n2 = K2, N2
            most = self.k((self.edges[band + 1] - 1) * 100 // self.g) // (k2 + 1) + 1
            n1 = most + most // SLACK + 3
        return n1, n2, k2, [np.array(t) for t in combinations(range(n2), n2 - k2)]

    def signatures(self, a: np.ndarray) -> np.ndarray:
        """Signatures of a set given as ascending distinct numbers."""
        s = len(a)
        if not self.k(s):
            return a[:0]
        out, spread = [], mix(a)
        band = self.band(s)
        while band >= 0 and self.edges[band + 1] > -(-s * self.g // 100):
            out.append(self._signed(a, spread, band))
            band -= 1
        return np.concatenate(out)

    def _signed(self, a: np.ndarray, spread: np.ndarray, band: int) -> np.ndarray:
        n1, n2, k2, subsets = self.shape(band)
        part = (((a >> np.uint64(32)) * np.uint64(n1 * n2)) >> np.uint64(32)).astype(np.int64)  # ascending like a
        start = np.flatnonzero(np.diff(part, prepend=-1))
        filled = part[start]
        count = np.bincount(part, minlength=n1 * n2).reshape(n1, n2)
        rest = np.sort(count, axis=1)[:, :n2 - k2].sum(axis=1)  # without its k2 largest parts
        need = self.k(len(a)) // (k2 + 1) + 1
        used = n1
        for least in range(LEAST, -1, -1):
            seen = np.cumsum(rest >= least)
            if seen[-1] >= need or not least:
                break
        if least == LEAST:
            used = int(np.searchsorted(seen, need)) + 1
        mine = filled < used * n2
        with np.errstate(over="ignore"):
            value = np.zeros(used * n2, dtype=np.uint64)
            value[filled[mine]] = np.add.reduceat(spread, start)[mine]
            value = value.reshape(used, n2)
            place = np.arange(used, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band + 1) * np.uint64(0xC2B2AE3D27D4EB4F)
            made = []
            for i, subset in enumerate(subsets):
                sig = mix(value[:, subset].sum(axis=1, dtype=np.uint64) + mix(place + np.uint64(i)))
                made.append(sig[count[:used, subset].sum(axis=1) >= least])
        return np.concatenate(made)
