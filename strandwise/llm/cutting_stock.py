"""The cutting-stock problem over a histogram of lengths, by column generation.

The linear program's columns are patterns: how many pieces of each length class share one sequence. Its duals price
the classes; one knapsack dynamic program then gives the best pattern of all, which bounds what is still to gain, and the
best one that holds each class, which join the candidates; those of first-fit decreasing are candidates from the start.
Pivots take candidates in turn until none gains, then the classes are priced anew, until the bound meets the value. The
fractional solution is rounded down, and what it leaves (less than one sequence per pattern) is filled first-fit
decreasing. The work depends on the number of classes only, not on the number of pieces.
"""

from __future__ import annotations

import numpy as np

#: The program ends when its value is proved to be within this share of the optimum. Demands are raised by up to TILT, each
#: by another part, so that no pivot stands still; the inverse is mended every REFRESH pivots. Sums go through einsum: a
#: forking driver and a threaded BLAS do not mix.
GAP, TILT, REFRESH = 1e-4, 1e-7, 50
#: Pivots between two pricings of the classes, candidates that are kept.
PIVOTS, POOL = 60, 4_000


def priced(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Per room from 0 to capacity the highest total price of a multiset of sizes (unbounded knapsack), and the class that it takes there (-1: none)."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    useful = np.flatnonzero(prices > 1e-12)
    useful = useful[np.argsort(sizes[useful])]
    at, price = sizes[useful], prices[useful]
    first = np.searchsorted(at, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := first[c]:
            total = best[c - at[:n]] + price[:n]
            k = int(total.argmax())
            if total[k] > best[c]:
                best[c], pick[c] = total[k], useful[k]
    return best, pick


def taken(pick: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """The multiset that ``priced`` chose for a room, as counts per class."""
    counts = np.zeros(len(sizes), np.int64)
    while room > 0:
        k = pick[room]
        if k < 0:
            room -= 1
        else:
            counts[k] += 1
            room -= sizes[k]
    return counts


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within capacity of the highest total price, as counts per size."""
    best, pick = priced(prices, sizes, capacity)
    return float(best[capacity]), taken(pick, sizes, capacity)


def decreasing(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """First-fit decreasing over a histogram: (uses, pattern) that add up to the demand exactly."""
    left, found = demand.astype(np.int64).copy(), []
    order = np.argsort(-sizes, kind="stable")
    while left.any():
        column, room = np.zeros(len(sizes), np.int64), capacity
        for i in order:
            n = min(left[i], room // sizes[i])
            column[i], room = n, room - n * sizes[i]
        inside = column > 0
        uses = int((left[inside] // column[inside]).min())
        left -= uses * column
        found.append((uses, column))
    return found


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Basic solution of the linear program: patterns (columns), how often each is used (fractions), and a proved lower bound of their sum."""
    m = len(sizes)
    demand = demand * (1 + TILT * ((np.arange(m) * 0.6180339887498949 + 0.5) % 1))
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    use = demand / (capacity // sizes)
    pool = np.array([column for _, column in decreasing(sizes, demand, capacity)], float)
    known = {tuple(column) for column in pool.astype(int)}
    bound, pivots = 0.0, 0
    while True:
        prices = inverse.sum(axis=0)
        best, pick = priced(prices, sizes, capacity)
        bound = max(bound, use.sum() / max(best[capacity], 1.0))
        if use.sum() - bound <= GAP * use.sum():
            return basis.astype(int), use, bound
        # The best pattern of all, and the best that holds each class.
        fresh = [taken(pick, sizes, capacity)]
        known.add(tuple(fresh[0]))
        for i in np.flatnonzero(prices + best[capacity - sizes] > 1 + 1e-9):
            column = taken(pick, sizes, int(capacity - sizes[i]))
            column[i] += 1
            if tuple(column) not in known:
                known.add(tuple(column))
                fresh.append(column)
        pool = np.concatenate([np.array(fresh, float), pool])[:POOL]
        known = {tuple(column) for column in pool.astype(int)} if len(known) > 4 * POOL else known
        moved = 0
        while moved < PIVOTS:
            gains = np.einsum("ij,j->i", pool, inverse.sum(axis=0))
            take = int(gains.argmax())
            if gains[take] <= 1 + 1e-9:
                break
            pattern = pool[take]
            way = np.einsum("ij,j->i", inverse, pattern)
            ratio = np.where(way > 1e-9, use / np.where(way > 1e-9, way, 1), np.inf)
            out = int(ratio.argmin())
            basis[:, out] = pattern
            use = np.maximum(use - ratio[out] * way, 0)
            use[out] = ratio.min()
            row = inverse[out] / way[out]
            inverse -= np.outer(way, row)
            inverse[out] = row
            moved += 1
            pivots += 1
            if pivots % REFRESH == 0:  # one Newton step undoes what rounding errors have added up to
                inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ij,jk->ik", basis, inverse))
                use = np.maximum(np.einsum("ij,j->i", inverse, demand), 0)


def plan(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Whole-numbered plan: (uses, [(class index, pieces of it)]) whose pieces add up to the demand exactly."""
    found: list[tuple[int, list[tuple[int, int]]]] = []
    some = np.flatnonzero(demand > 0)
    if not len(some):
        return found
    sizes, left = sizes[some], demand[some].astype(np.int64).copy()
    patterns, use, _ = relaxed(sizes, left.astype(float), capacity)
    parts = lambda column: [(int(some[i]), int(column[i])) for i in np.flatnonzero(column)]
    for k in np.argsort(-use):
        column = patterns[:, k]
        inside = column > 0
        uses = min(int(use[k] + 1e-6), int((left[inside] // column[inside]).min()))
        if uses > 0:
            left -= uses * column
            found.append((uses, parts(column)))
    return found + [(uses, parts(column)) for uses, column in decreasing(sizes, left, capacity)]
