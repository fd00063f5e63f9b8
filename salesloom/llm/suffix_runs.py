"""Runs of repeated periods in sequences of symbols, from an enhanced suffix array.

Several sequences are laid end to end.  Symbols are numbered per sequence, so
that no suffix compares equal with one of another sequence.

* Suffixes are ranked by doubling.  Of each round the ranks of those still tied
  are kept: places with equal ranks there share the next 2^round symbols, which
  gives common prefixes of any two places, and common stretches to their left.
* For each interval of the suffix array with common prefix ``depth`` the
  suffixes of all but its largest child are looked at: if the place ``depth``
  to the right or left has its rank in the same interval but in another child,
  a square starts there that cannot be moved to the right.  Intervals and
  children are index ranges; no tree is built.
* Each square is rotated to the left as far as it goes, which gives the whole
  run; runs with the same ends are merged to the one with the smallest period.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Limits:
    """A run counts if it is at least ``length`` symbols and ``exponent`` periods long."""

    length: int = 24
    exponent: int = 3

    @property
    def overlap(self) -> int:
        """Symbols that the run's start and the place one period later share at least."""
        periods = range(1, self.length + 1)
        return min(max(self.length, self.exponent * period) - period for period in periods)


class SuffixArray:
    """Suffix array, its inverse and common prefixes of sequences laid end to end.

    ``symbols`` are integers, no value of which is in two sequences; ``stops``
    gives for each place the end of its sequence.
    """

    def __init__(self, symbols: np.ndarray, stops: np.ndarray):
        # Of each place, how long its sequence is.
        self.lengths = stops - np.searchsorted(stops, stops)
        count = len(symbols)
        order = np.argsort(symbols, kind="stable")
        self.rank = np.empty(count, np.int64)
        self._name(order, symbols[order], np.zeros(count, np.int64))
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []
        step = 1
        tied = self._tied(np.arange(count))
        while len(tied):
            self.rounds.append((tied, self.rank[tied]))
            follow = np.full(len(tied), -1, np.int64)
            inside = tied + step < stops[tied]
            follow[inside] = self.rank[tied[inside] + step]
            order = np.lexsort((follow, self.rank[tied]))
            places = tied[order]
            self._name(places, follow[order], self.rank[places])
            tied = self._tied(tied)
            step *= 2
        self.array = np.empty(count, np.int64)
        self.array[self.rank] = np.arange(count)
        self.prefix = np.zeros(count, np.int64)
        if count:
            self.prefix[1:] = self.common(self.array[:-1], self.array[1:], 1)

    def _name(self, places: np.ndarray, keys: np.ndarray, groups: np.ndarray) -> None:
        """Ranks of sorted ``places``: the first rank of their group plus those before them with a smaller key."""
        if not len(places):
            return
        at = np.arange(len(places))
        opens = np.ones(len(places), bool)
        opens[1:] = groups[1:] != groups[:-1]
        changes = opens.copy()
        changes[1:] |= keys[1:] != keys[:-1]
        group_start = np.maximum.accumulate(np.where(opens, at, 0))
        key_start = np.maximum.accumulate(np.where(changes, at, 0))
        self.rank[places] = groups + key_start - group_start

    def _tied(self, places: np.ndarray) -> np.ndarray:
        """Those of the sorted ``places`` that share their rank with another one."""
        if not len(places):
            return places
        ranks = self.rank[places]
        order = np.argsort(ranks, kind="stable")
        equal = ranks[order][1:] == ranks[order][:-1]
        shared = np.zeros(len(places), bool)
        shared[order[1:]] |= equal
        shared[order[:-1]] |= equal
        return places[shared]

    def common(self, a: np.ndarray, b: np.ndarray, direction: int) -> np.ndarray:
        """Symbols that follow ``a`` and ``b`` (1) or precede them (-1) and are equal."""
        shared = np.zeros(len(a), np.int64)
        for level in range(len(self.rounds) - 1, -1, -1):
            places, ranks = self.rounds[level]
            shift = -(1 << level) if direction < 0 else 0
            x, y = a + direction * shared + shift, b + direction * shared + shift
            at_x, at_y = np.searchsorted(places, x), np.searchsorted(places, y)
            known = (at_x < len(places)) & (at_y < len(places))
            at_x, at_y = np.where(known, at_x, 0), np.where(known, at_y, 0)
            equal = known & (places[at_x] == x) & (places[at_y] == y) & (ranks[at_x] == ranks[at_y])
            shared[equal] += 1 << level
        return shared


def _bounds(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each index the nearest ones on either side with a smaller value (-1 and the length if there is none)."""
    values = prefix.tolist()
    count = len(values)
    before, after, stack = [-1] * count, [count] * count, []
    for at, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            after[stack.pop()] = at
        if stack:
            top = stack[-1]
            before[at] = before[top] if values[top] == value else top
        stack.append(at)
    return np.array(before, np.int64), np.array(after, np.int64)


def _child_ranges(prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of the suffix array that are children of an interval but its largest, with the interval.

    Columns: first and last index of the child, first and last of the interval, its depth.
    """
    cuts = np.flatnonzero(prefix > 0)
    before, after = _bounds(prefix)
    # An interval is the stretch between smaller values; its cuts are the indices of its depth.
    first, last = before[cuts], after[cuts] - 1
    order = np.lexsort((cuts, last, first))
    cuts, first, last = cuts[order], first[order], last[order]
    opens = np.ones(len(cuts), bool)
    opens[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    closes = np.append(opens[1:], True) if len(cuts) else opens
    group = np.cumsum(opens) - 1
    low = np.concatenate([first[opens], cuts])
    high = np.concatenate([cuts[opens] - 1, np.where(closes, last, np.append(cuts[1:], 0) - 1 if len(cuts) else cuts)])
    owner = np.concatenate([np.arange(int(opens.sum())), group])
    size = high - low + 1
    by_size = np.lexsort((size, owner))
    largest = np.append(owner[by_size][1:] != owner[by_size][:-1], True) if len(by_size) else by_size.astype(bool)
    small = by_size[~largest]
    tops = np.flatnonzero(opens)[owner[small]]
    return np.stack([low[small], high[small]]), np.stack([first[tops], last[tops]]), prefix[cuts[tops]]


def squares(array: SuffixArray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of each square that does not move to the right, of periods that a counted run can have."""
    child, interval, depth = _child_ranges(array.prefix)
    # A run of this period is at least `exponent` times as long, and lies in one sequence.
    keep = depth * limits.exponent <= array.lengths[array.array[child[0]]]
    child, interval, depth = child[:, keep], interval[:, keep], depth[keep]
    sizes = child[1] - child[0] + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = array.array[child[0][owner] + inner]
    depth = depth[owner]
    found = []
    for sign in (1, -1):
        others = places + sign * depth
        inside = (others >= 0) & (others < len(array.rank))
        ranks = array.rank[np.where(inside, others, 0)]
        inside &= (ranks >= interval[0][owner]) & (ranks <= interval[1][owner])
        inside &= (ranks < child[0][owner]) | (ranks > child[1][owner])
        found.append((np.minimum(places, others)[inside], depth[inside]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs(symbols: np.ndarray, stops: np.ndarray, limits: Limits) -> np.ndarray:
    """Start, length and smallest period of every counted run, sorted by start and period."""
    array = SuffixArray(symbols, stops)
    start, period = squares(array, limits)
    end = start + 2 * period
    start = start - array.common(start, start + period, -1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    length = end - start
    keep &= (length >= limits.length) & (length >= limits.exponent * period)
    found = np.stack([start[keep], length[keep], period[keep]], axis=1)
    return found[np.lexsort((found[:, 2], found[:, 0]))]
