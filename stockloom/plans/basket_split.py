"""Cutting sorted quantities into three groups with the least squared error.

For a start of the second group the best start of the third never moves back
when the second group starts later.  So the starts are solved from the middle
outwards: the middle one bounds the search of both halves, and all starts of n
quantities take n log n steps instead of n squared.  The halves of all pairs of
a batch are solved side by side, one level of halving at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Quantities that are worked on at once; a longer histogram is a chunk of its own.
CHUNK = 1 << 20
#: Relative difference below which two sums of errors are equal.
SAME = 2e-15
_WHOLE = float(1 << 62)


class Histograms:
    """Running sums of counts, quantities and squares of several histograms.

    Quantities are taken from a whole number near their mean, and sums are
    whole, so nothing is lost by cancellation; the chunk's numbers become Python
    integers where 64 bits do not hold a product.
    """

    def __init__(self, quantities: list[np.ndarray], counts: list[np.ndarray]):
        self.n = np.array([len(x) for x in quantities], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.n + 1)[:-1]]).astype(np.int64)
        self.centre = [int(round(float(np.dot(c.astype(float), x.astype(float)) / max(c.sum(), 1)))) for x, c in zip(quantities, counts)]
        wide = any(float(c.sum()) * float((c.astype(float) * np.square(x - m, dtype=float)).sum()) >= _WHOLE
                   for x, c, m in zip(quantities, counts, self.centre))
        kind = object if wide else np.int64

        def running(power: int) -> np.ndarray:
            parts = []
            for x, c, m in zip(quantities, counts, self.centre):
                values = c.astype(kind) * (x.astype(kind) - m) ** power if power else c.astype(kind)
                parts += [np.zeros(1, kind), np.cumsum(values)]
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.sums = [running(p) for p in range(3)]

    def group(self, pair: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, sum (from the centre) and error of ranks first..last; 0 if empty."""
        empty = last < first
        low = self.base[pair] + np.where(empty, 0, first - 1)
        high = self.base[pair] + np.where(empty, 0, last)
        n, s, q = (x[high] - x[low] for x in self.sums)
        count = np.where(empty, 1, n)
        return n, s, ((count * q - s * s) / count).astype(float)

    def error(self, pair: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.group(pair, first, last)[2]


def best_thirds(h: Histograms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, k2, k3): the best start k3 of the third group for every start k2 of
    the second, by pair and k2; equal errors take the smaller k3.

    Histograms of fewer than three quantities have the one split (2, 3).
    """
    pair = np.flatnonzero(h.n >= 3)
    lo, hi = np.full(len(pair), 2), h.n[pair] - 1
    least, most = np.full(len(pair), 3), h.n[pair]
    found = [(np.flatnonzero(h.n < 3), 2, 3)]
    while len(pair):
        mid = (lo + hi) // 2
        first = np.maximum(mid + 1, least)
        size = most - first + 1
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        of = np.repeat(np.arange(len(pair)), size)
        k3 = first[of] + np.arange(len(of)) - begin[of]
        owner = pair[of]
        cost = h.error(owner, mid[of], k3 - 1) + h.error(owner, k3, h.n[owner])
        good = np.flatnonzero(cost <= np.minimum.reduceat(cost, begin)[of] * (1 + SAME))
        best = k3[good[np.unique(of[good], return_index=True)[1]]]
        found.append((pair, mid, best))
        left, right = lo < mid, mid < hi
        pair, lo, hi, least, most = (
            np.concatenate([pair[left], pair[right]]), np.concatenate([lo[left], mid[right] + 1]),
            np.concatenate([mid[left] - 1, hi[right]]), np.concatenate([least[left], best[right]]),
            np.concatenate([best[left], most[right]]))
    pairs = np.concatenate([p for p, _, _ in found])
    k2, k3 = (np.concatenate([np.broadcast_to(x[i], len(x[0])) for x in found]) for i in (1, 2))
    order = np.lexsort((k2, pairs))
    return pairs[order], k2[order], k3[order]


def winners(pair: np.ndarray, k2: np.ndarray, sse: np.ndarray) -> np.ndarray:
    """Places of each pair's least error, to six decimals; ties take the smaller k2."""
    order = np.lexsort((k2, np.round(sse, 6), pair))
    return order[np.unique(pair[order], return_index=True)[1]]


GROUPS = ("k1", "k2", "k3")
STATS = "k2_start int, k3_start int, sse double, " + ", ".join(
    f"{g}_mean double, {g}_stddev double, {g}_cnt long" for g in GROUPS)


def _solved(quantities: list[np.ndarray], counts: list[np.ndarray], only_best: bool) -> tuple[np.ndarray, list[pa.Array]]:
    h = Histograms(quantities, counts)
    pair, k2, k3 = best_thirds(h)
    n = h.n[pair]
    spans = [(np.ones_like(n), np.minimum(k2 - 1, n)), (k2, np.minimum(k3 - 1, n)), (k3, n)]
    groups = [h.group(pair, a, b) for a, b in spans]
    sse = groups[0][2] + groups[1][2] + groups[2][2]
    keep = winners(pair, k2, sse) if only_best else np.arange(len(pair))
    centre = np.array(h.centre, float)[pair]
    out = [pa.array(k2[keep], pa.int32()), pa.array(k3[keep], pa.int32()), pa.array(sse[keep])]
    for count, total, error in groups:
        none = (count == 0)[keep]
        known = np.where(count == 0, 1, count)
        out += [pa.array((centre + (total / known).astype(float))[keep], mask=none),
                pa.array(np.sqrt((error / known).astype(float))[keep], mask=none),
                pa.array(count.astype(np.int64)[keep], mask=none)]
    return pair[keep], out


def split_batches(keys: list[str], only_best: bool):
    """For ``mapInArrow`` over rows (*keys, quantities, counts), one per pair: a
    row per start of the second group, or with ``only_best`` the best one."""
    names = [c.split()[0] for c in STATS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            quantities, counts = (_arrays(b.column(c)) for c in ("quantities", "counts"))
            lengths = np.array([len(x) for x in quantities], np.int64)
            chunk = np.cumsum(lengths) // CHUNK
            for c in np.unique(chunk):
                rows = np.flatnonzero(chunk == c)
                pair, columns = _solved([quantities[i] for i in rows], [counts[i] for i in rows], only_best)
                at = pa.array(rows[pair])
                yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in keys], *columns], [*keys, *names])

    return run


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []
