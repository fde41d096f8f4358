"""Double-array tries over phrases of word numbers, matched at all text positions at once.

A word number is spelled as a few digits, so that a node's children lie close together. A
transition adds a digit to the node's base and holds if the place reached names the node
as its parent. Positions of a text advance together, one digit at a time, by array look-ups;
those without a transition drop out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits of a digit, at most.
DIGIT_BITS = 10
#: Places that are tried for the children of a node before new ones are added.
TRIES = 64


def digits_of(highest: int) -> tuple[int, int]:
    """(digits per word number, bits per digit) for numbers up to ``highest``."""
    bits = max(1, int(highest).bit_length())
    count = -(-bits // DIGIT_BITS)
    return count, -(-bits // count)


@dataclass(frozen=True)
class DoubleArray:
    """``check[place]`` is the parent of the node at a place, -1 where there is none; the root is at place 0.

    ``states[i]`` is the place at which phrase ``i`` of those it was built from is accepted.
    """

    base: np.ndarray
    check: np.ndarray
    states: np.ndarray
    words: int
    digits: int
    bits: int

    def match(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a phrase begins, and their accepting states; 0 is no word and ends every phrase."""
        at = np.flatnonzero(ids[: max(0, len(ids) - self.words + 1)])
        state = np.zeros(len(at), np.int32)
        mask = (1 << self.bits) - 1
        for k in range(self.words):
            word = ids[at + k]
            for shift in range((self.digits - 1) * self.bits, -1, -self.bits):
                to = self.base[state] + ((word >> shift) & mask)
                holds = np.flatnonzero(self.check.take(to, mode="clip") == state)
                at, state, word = at[holds], to[holds], word[holds]
        return at, state


def build(phrases: np.ndarray, highest: int) -> DoubleArray:
    """The trie of distinct phrases, rows of word numbers from 1 to ``highest`` in lexicographic order."""
    count, bits = digits_of(highest)
    n, words = phrases.shape
    shifts = np.arange(count - 1, -1, -1) * bits
    symbols = ((phrases[:, :, None] >> shifts) & ((1 << bits) - 1)).reshape(n, -1).astype(np.int32)
    differs = np.ones((n, symbols.shape[1]), bool)
    differs[1:] = np.logical_or.accumulate(symbols[1:] != symbols[:-1], axis=1)
    # Nodes are numbered depth by depth; the children of a node are neighbours at the next depth.
    parent, symbol, before, shift = [], [], np.zeros(n, np.int64), 1
    for depth in range(symbols.shape[1]):
        fresh = differs[:, depth]
        parent.append(before[fresh])
        symbol.append(symbols[fresh, depth])
        before = np.cumsum(fresh) - 1 + shift
        shift += len(parent[-1])
    parent, symbol = np.concatenate(parent), np.concatenate(symbol)
    base = _bases(parent, symbol, shift)
    place = np.zeros(shift, np.int64)
    place[1:] = base[parent] + symbol
    size = int(place.max()) + 2  # the last place stays free: look-ups beyond it end there
    out_base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    out_base[place] = base
    check[place[1:]] = place[parent]
    return DoubleArray(out_base, check, place[before].astype(np.int32), words, count, bits)


def _bases(parent: np.ndarray, symbol: np.ndarray, nodes: int) -> np.ndarray:
    """For each node a base at which all its children find free places: the largest families first."""
    first = np.searchsorted(parent, np.arange(nodes + 1))
    children = np.diff(first)
    base = np.zeros(nodes, np.int64)
    taken = np.zeros(max(1024, 4 * nodes), bool)
    taken[0] = True
    top = 1
    draw = np.random.default_rng(0)
    shared = np.flatnonzero(children > 1)
    for node in shared[np.argsort(-children[shared], kind="stable")]:
        own = symbol[first[node] : first[node + 1]]
        tries = draw.integers(1, top + 1, TRIES) - own[0]
        free = np.flatnonzero(~taken[tries[:, None] + own].any(axis=1))
        at = tries[free[0]] if len(free) else top - own[0]
        base[node] = at
        taken[at + own] = True
        top = max(top, int(at + own[-1]) + 1)
        if top + (own[-1] - own[0]) + 4096 > len(taken):
            taken = np.concatenate([taken, np.zeros(len(taken), bool)])
    single = np.flatnonzero(children == 1)
    places = np.flatnonzero(~taken[: top + len(single) + 1])
    if len(places) < len(single):
        places = np.concatenate([places, np.arange(top + len(single) + 1, top + 2 * len(single) + 1)])
    base[single] = places[: len(single)] - symbol[first[single]]
    return base
