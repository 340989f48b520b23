"""Sorting the suffixes of one shard by induction, with common-prefix values.

``sorted_suffixes`` takes the shard as symbols and yields its suffixes in order (exact in their
first ``depth`` symbols), each with the length it has in common with the one before (exact up to
``depth``).  The steps of external induced sorting:

* suffixes that start a fall-to-rise (S*) are sorted first, by the names of the substrings up to
  the next one and then on the reduced string of these names;
* the others are induced from them: every suffix taken from a priority queue, smallest symbol
  first, puts the suffix one position to its left back into the queue, together with one more
  than the smallest common prefix passed since that queue bucket's last entry;
* once rising from the smallest symbol for falling (L) suffixes, once falling for rising (S) ones.

The queue takes and gives whole runs of tuples as arrays.  Within a bucket they come out as they
went in, which is their order.  Runs beyond a memory budget are kept on disk, in a folder that
goes with the sort.  The shard's text, types, S* names and the bucket at hand stay in memory, some
tens of bytes a symbol, so the caller bounds its shards.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

#: Tuples held in memory before runs go to disk (12 bytes each).
MEMORY_TUPLES = 16_000_000
#: Bits of one (symbol, type) pair; six of them make a sort key.
PAIR_BITS, PER_KEY = 10, 6


class SuffixQueue:
    """Disk-backed priority queue of (position, common prefix) runs, one bucket a symbol."""

    def __init__(self, folder: str, symbols: int, budget: int = MEMORY_TUPLES):
        self.folder, self.budget = folder, budget
        self.runs: list[list] = [[] for _ in range(symbols)]
        self.held = self.files = 0

    def push(self, symbol: int, positions, prefixes) -> None:
        self.runs[symbol].append((positions, prefixes))
        self.held += len(positions)
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        import numpy as np

        for runs in self.runs:
            for k, run in enumerate(runs):
                if isinstance(run[0], np.ndarray) and len(run[0]):
                    path = os.path.join(self.folder, f"run{self.files}.npz")
                    self.files += 1
                    np.savez(path, p=run[0], c=run[1])
                    runs[k] = (path, len(run[0]))
        self.held = 0

    def pop(self, symbol: int):
        """All tuples of a bucket in order, or None."""
        import numpy as np

        runs, out = self.runs[symbol], []
        if not runs:
            return None
        self.runs[symbol] = []
        for run in runs:
            if isinstance(run[0], str):
                with np.load(run[0]) as f:
                    out.append((f["p"], f["c"]))
                os.remove(run[0])
            else:
                self.held -= len(run[0])
                out.append(run)
        return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])


def _types(text):
    """Whether each position rises (S): its suffix is smaller than the next one's."""
    import numpy as np

    n = len(text)
    rises = np.zeros(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    rises[-1] = True
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    ends = np.flatnonzero(differs)  # last position of each run of equal symbols
    lengths = np.diff(np.concatenate(([-1], ends)))
    run_end = np.repeat(ends, lengths)
    return rises[run_end], (run_end - np.arange(n) + 1).astype(np.int32)


def _ranked(keys):
    """Dense ranks of the rows of ``keys`` (most significant first)."""
    import numpy as np

    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, order


def _refined(ranks, keys, tied):
    """``ranks`` with the rows in ``tied`` (whole classes) split further by ``keys``."""
    import numpy as np

    sub, _ = _ranked([ranks[tied], keys])
    # a class keeps its first rank; its members rank behind by how many of the class are smaller
    order = np.argsort(sub, kind="stable")
    first = np.searchsorted(sub[order], sub[order], side="left")
    old = ranks[tied][order]
    start = np.searchsorted(old, old, side="left")
    out = ranks.copy()
    out[tied[order]] = old + (first - start)
    return out


def _tied(ranks, count):
    import numpy as np

    sizes = np.bincount(ranks, minlength=count)
    return np.flatnonzero(sizes[ranks] > 1)


def _sorted_stars(text, rises, stars, depth: int):
    """Order of the S* suffixes in their first ``depth`` symbols, and their common prefixes."""
    import numpy as np

    n, m = len(text), len(stars)
    pair = np.concatenate((text.astype(np.uint64) * 2 + rises, np.zeros(depth + 2 * PER_KEY, np.uint64)))
    length = np.diff(np.append(stars, n)) + 1

    def key(rows, offset):
        out = np.zeros(len(rows), np.uint64)
        for k in range(PER_KEY):
            out = out << np.uint64(PAIR_BITS) | pair[rows + (offset + k)]
        return out

    dense, _ = _ranked([key(stars, 0)])
    sizes = np.bincount(dense)
    ranks = (np.cumsum(sizes) - sizes)[dense].astype(np.int32)  # rank: how many suffixes are smaller
    covered = PER_KEY
    while covered < depth:  # until names span their whole substrings
        tied = _tied(ranks, m)
        sizes = np.zeros(m, bool)
        sizes[ranks[tied[length[tied] > covered]]] = True
        tied = tied[sizes[ranks[tied]]]
        if not len(tied):
            break
        ranks = _refined(ranks, key(stars[tied], covered), tied)
        covered += PER_KEY
    levels, step = [ranks], 1
    while True:  # the reduced string: names of 1, 2, 4, ... substrings
        tied = _tied(ranks, m)
        ahead = np.minimum(tied + step, m - 1)
        open_ = np.zeros(m, bool)
        open_[ranks[tied[stars[ahead] - stars[tied] < depth]]] = True
        tied = tied[open_[ranks[tied]]]
        if not len(tied) or step >= m:
            break
        nxt = np.where(tied + step < m, levels[-1][np.minimum(tied + step, m - 1)] + 1, 0)
        ranks = _refined(levels[-1], nxt, tied)
        levels.append(ranks)
        step *= 2
    order = np.argsort(ranks, kind="stable")
    # common prefixes of neighbours: whole substrings by the levels, then symbol by symbol
    a, b = order[:-1].copy(), order[1:].copy()
    a0 = stars[a]
    for k in range(len(levels) - 1, -1, -1):
        while True:
            near = stars[a] - a0 < depth
            same = near & (a < m - 1) & (b < m - 1) & (levels[k][a] == levels[k][b])
            if k == 0:  # a name may stand for less than a substring once ``depth`` is reached
                same &= length[a] <= np.maximum(covered, depth)
            if not same.any():
                break
            a = np.where(same, np.minimum(a + (1 << k), m - 1), a)
            b = np.where(same, np.minimum(b + (1 << k), m - 1), b)
            if k < len(levels) - 1 and k > 0:
                break
    common = stars[a] - a0
    live, offset = np.flatnonzero(common < depth), 0
    while len(live):
        left, right = stars[a[live]] + offset, stars[b[live]] + offset
        inside = (common[live] < depth) & (left < n) & (right < n)
        live, left, right = live[inside], left[inside], right[inside]
        live = live[text[left] == text[right]]  # symbols alone: types may differ within a run
        common[live] += 1
        offset += 1
    return stars[order], np.concatenate(([0], np.minimum(common, depth))).astype(np.int32)


def _induced(text, wanted, run, seeds, symbols, falling: bool, folder: str, depth: int):
    """One inducing pass.  ``seeds[c]``: (positions, prefixes) taken after the bucket's own tuples.

    Returns each symbol's induced (positions, prefixes) in the order in which they were taken.
    """
    import numpy as np

    queue = SuffixQueue(folder, symbols)
    since = np.full(symbols, -1, np.int64)  # smallest prefix passed since a bucket's last entry
    found: list = [None] * symbols

    def pass_on(positions, prefixes):
        inner = positions > 0
        left = np.maximum(positions - 1, 0)
        target = np.where(inner & wanted[left], text[left].astype(np.int64), -1)
        padded = np.append(prefixes, np.int32(depth))
        low = int(prefixes.min())
        hit = np.unique(target)
        for b in hit[hit >= 0]:
            at = np.flatnonzero(target == b)
            mins = np.minimum.reduceat(padded, np.concatenate(([0], at + 1)))
            mins[0] = min(int(mins[0]), int(since[b]))
            queue.push(int(b), left[at], np.minimum(mins[:-1] + 1, depth).astype(np.int32))
            since[b] = mins[-1]
        rest = np.ones(symbols, bool)
        rest[hit[hit >= 0]] = False
        since[rest] = np.minimum(since[rest], low)

    for c in (range(symbols - 1, -1, -1) if falling else range(symbols)):
        own = []
        while (got := queue.pop(c)) is not None:
            own.append(got)
            pass_on(*got)
        if own:
            found[c] = (np.concatenate([p for p, _ in own]), np.concatenate([x for _, x in own]))
        if seeds[c] is not None:
            positions, prefixes = seeds[c]
            prefixes = prefixes.copy()
            # a falling and a rising suffix of one bucket share its symbol's shorter run
            prefixes[0] = min(int(run[found[c][0][-1]]), int(run[positions[0]]), depth) if own else 0
            pass_on(positions, prefixes)
    return found


def sorted_suffixes(text, symbols: int, depth: int) -> Iterator[tuple]:
    """(positions, prefixes) of all suffixes in order, bucket by bucket of the first symbol.

    ``text``: integer symbols below ``symbols`` (at most 512), the last of them 0 and only there.
    """
    import numpy as np

    with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
        rises, run = _types(text)
        star = rises.copy()
        star[0] = False
        star[1:] &= ~rises[:-1]
        stars = np.flatnonzero(star)
        order, prefixes = _sorted_stars(text, rises, stars, depth)
        first = text[order]
        bounds = np.searchsorted(first, np.arange(symbols + 1))
        seeds = [(order[i:j], prefixes[i:j]) if j > i else None for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        low = _induced(text, ~rises, run, seeds, symbols, False, folder, depth)
        # falling pass: the L suffixes of a bucket from the largest, each with its larger neighbour's prefix
        back = [None if x is None else (x[0][::-1], np.concatenate((np.zeros(1, np.int32), x[1][:0:-1]))) for x in low]
        last = len(text) - 1
        high = _induced(text, rises, run, back, symbols, True, folder, depth)
        high[0] = (np.array([last]), np.zeros(1, np.int32))
        for c in range(symbols):
            parts = []
            if low[c] is not None:
                parts.append(low[c])
            if high[c] is not None:
                p, x = high[c][0][::-1], np.concatenate((np.zeros(1, np.int32), high[c][1][:0:-1]))
                if parts:
                    x[0] = min(int(run[parts[0][0][-1]]), int(run[p[0]]), depth)
                parts.append((p, x))
            if parts:
                yield np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])
