"""Augmented Dickey-Fuller test of daily series from the days that have rows.

The regression of a daily change on the previous value, on lagged changes and a constant needs only the sums
of products of values at offsets 0 to p + 1. These come from pairs of existing days; empty days enter in closed
form. All values are taken less the mean, so large levels cost no digits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, erf, sqrt

import numpy as np
from pyspark import cloudpickle

SIGNIFICANT = 0.05
# Published response surface of the statistic with a constant (MacKinnon 1994), lowest power first.
SURFACE_BELOW, SURFACE_ABOVE = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
SURFACE_SPLIT, SURFACE_LEAST, SURFACE_MOST = -1.61, -18.83, 2.74
#: Share of a column's own sum of squares below which it counts as a combination of the others.
DEPENDENT = 1e-10
#: Series that are tested together.
TOGETHER = 256


def p_value(statistic: float) -> float:
    """Probability of a smaller statistic if there is a unit root."""
    if statistic <= SURFACE_LEAST or statistic >= SURFACE_MOST:
        return float(statistic >= SURFACE_MOST)
    surface = SURFACE_BELOW if statistic <= SURFACE_SPLIT else SURFACE_ABOVE
    z = sum(c * statistic**k for k, c in enumerate(surface))
    return (1 + erf(z / sqrt(2))) / 2


def default_lags(n: int) -> int:
    """Largest number of lagged changes that is tried for ``n`` days; negative if there are too few days."""
    return min(ceil(12 * (n / 100) ** 0.25), n // 2 - 2)


@dataclass
class OffsetSums:
    """Sums of products ``z[t] * z[t + k]`` over a whole series, and its values at both ends."""

    n: int
    sums: np.ndarray
    head: np.ndarray
    tail: np.ndarray

    @classmethod
    def of(cls, days: np.ndarray, qty: np.ndarray, width: int) -> OffsetSums:
        """Sums up to offset ``width`` of the series that is 0 on days without a row."""
        at = days - days[0]
        n = int(at[-1]) + 1
        mean = qty.sum() / n
        z = qty - mean
        pairs, both, left, right = (np.zeros(width + 1) for _ in range(4))
        for stride in range(len(at)):
            apart = at[stride:] - at[:len(at) - stride]
            near = np.flatnonzero(apart <= width)
            if not len(near):
                break
            k, a, b = apart[near], z[near], z[near + stride]
            pairs += np.bincount(k, minlength=width + 1)
            both += np.bincount(k, a * b, width + 1)
            left += np.bincount(k, a, width + 1)
            right += np.bincount(k, b, width + 1)
        k = np.arange(width + 1)
        running = np.append(0.0, np.cumsum(z))
        n_first = np.searchsorted(at, n - 1 - k, side="right")  # days with a partner inside, later and earlier
        n_last = len(at) - np.searchsorted(at, k)
        one = (running[n_first] - left) + (running[-1] - running[len(at) - n_last] - right)
        none = (n - k) - n_first - n_last + pairs
        filled = [np.full(min(n, width + 1), -mean) for _ in range(2)]
        first, last = at < len(filled[0]), at >= n - len(filled[1])
        filled[0][at[first]] = z[first]
        filled[1][n - 1 - at[last]] = z[last]
        return cls(n, both - mean * one + mean * mean * none, *filled)


def products(sums: np.ndarray, heads: np.ndarray, tails: np.ndarray, days: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Centred products of the previous value, ``p`` lagged changes and the change, over the days that have all.

    For many series, from their :class:`OffsetSums` as rows; also how many days each has.
    """
    size = p + 2
    start = p + 1
    i, j = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    low, high = np.minimum(i, j), np.maximum(i, j)
    k = high - low

    def edge(values: np.ndarray) -> np.ndarray:
        """Row c: sums of the first c products at every offset."""
        padded = np.concatenate([values[:, :size], np.zeros((len(values), size))], axis=1)
        ahead = np.lib.stride_tricks.sliding_window_view(padded, size, axis=1)[:, :size]
        own = np.zeros((len(values), size + 1, size))
        np.cumsum(padded[:, :size, None] * ahead, axis=1, out=own[:, 1:])
        return own

    gram = sums[:, k] - edge(heads)[:, start - high, k] - edge(tails)[:, low, k]
    place = np.arange(size)
    head, tail = (np.cumsum(np.pad(v[:, :size], ((0, 0), (1, 0))), axis=1) for v in (heads, tails))
    total = -head[:, start - place] - tail[:, place]  # all values add up to 0
    n = days - start
    centred = gram - total[:, :, None] * total[:, None] / n[:, None, None]
    turn = np.zeros((size, size))
    turn[0, 1] = 1.0
    for row in range(1, p + 1):
        turn[row, row], turn[row, row + 1] = 1.0, -1.0
    turn[p + 1, 0], turn[p + 1, 1] = 1.0, -1.0
    return turn @ centred @ turn.T, n


def residuals(products: np.ndarray) -> np.ndarray:
    """Residual sums of squares of the last column on the first one, two, ... of the others, a row for each series."""
    left = products.copy()
    own = np.einsum("sii->si", products).copy()
    out = np.zeros((len(left), left.shape[1] - 1))
    for k in range(out.shape[1]):
        pivot = left[:, k, k]
        free = pivot > DEPENDENT * own[:, k]
        share = left[:, k + 1:, k] * np.where(free, 1.0 / np.where(free, pivot, 1.0), 0.0)[:, None]
        left[:, k + 1:, k + 1:] -= share[:, :, None] * left[:, k, None, k + 1:]
        out[:, k] = left[:, -1, -1]
    return out


def augmented_dickey_fuller_many(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], lags: int | None = None, choose: bool = True
) -> list[tuple[int, int, float, float] | None]:
    """For each series (changes used, lagged changes, statistic, probability); None where there is nothing to test.

    With ``choose``, the number of lagged changes up to ``lags`` is the one with the least information
    criterion (AIC) on the days that all of them can use; the test is then run on all days it can use itself.
    A series is ascending numbers of the days with rows, and their values. Series that try equally many lags are
    tested together.
    """
    found: list = [None] * len(rows)
    alike: dict[int, list[int]] = {}
    for k, (days, _) in enumerate(rows):
        if len(days):
            n = int(days[-1] - days[0]) + 1
            most = default_lags(n) if lags is None else min(lags, n // 2 - 2)
            if most >= 0:
                alike.setdefault(most, []).append(k)
    for most, places in alike.items():
        for start in range(0, len(places), TOGETHER):
            own = np.array(places[start:start + TOGETHER])
            each = [OffsetSums.of(*rows[k], most + 1) for k in own]
            parts = [np.stack(v) for v in zip(*((s.sums, s.head, s.tail) for s in each))]
            parts.append(np.array([s.n for s in each]))
            used = np.full(len(own), most)
            if choose:
                tried, size = products(*parts, most)
                rest = np.maximum(residuals(tried), 1e-14 * tried[:, -1, -1:] + 1e-300)
                used = np.argmin(size[:, None] * np.log(rest / size[:, None]) + 2 * np.arange(most + 1), axis=1)
            for p in np.unique(used).tolist():
                some = np.flatnonzero(used == p)
                for k, result in zip(own[some].tolist(), _statistics(*[v[some] for v in parts], p)):
                    found[k] = result
    return found


def _statistics(sums, heads, tails, days, p: int) -> Iterator[tuple[int, int, float, float] | None]:
    tried, size = products(sums, heads, tails, days, p)
    free = size - p - 2
    inner = tried[:, :-1, :-1]
    scale = np.sqrt(np.maximum(np.einsum("sii->si", inner), 1e-300))
    rest = residuals(tried)[:, -1]
    good = (free >= 1) & (inner[:, 0, 0] > 1e-12 * sums[:, 0]) & (rest > 1e-12 * np.maximum(tried[:, -1, -1], sums[:, 0] * 1e-3))
    first = np.linalg.pinv(inner[good] / (scale[good, :, None] * scale[good, None]), rcond=DEPENDENT, hermitian=True)[:, 0]
    slope = (first * (tried[good, :-1, -1] / scale[good])).sum(axis=1)
    statistic = iter((slope / np.sqrt(rest[good] / free[good] * np.maximum(first[:, 0], 1e-300))).tolist())
    for n, fine in zip(size.tolist(), good.tolist()):
        value = next(statistic) if fine else 0.0
        yield (n, p, value, p_value(value)) if fine else None


def augmented_dickey_fuller(
    days: np.ndarray, qty: np.ndarray, lags: int | None = None, choose: bool = True
) -> tuple[int, int, float, float] | None:
    """:func:`augmented_dickey_fuller_many` of one series."""
    return augmented_dickey_fuller_many([(days, qty)], lags, choose)[0]


# Task functions travel inside the job, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
