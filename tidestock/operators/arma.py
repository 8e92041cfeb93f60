"""ARMA models of many series around 0 at once: conditional least squares by Gauss-Newton steps.

Series of a batch are the rows of one matrix, aligned at their last day; zeros before the first day change
nothing, as the recursion of the shocks starts from zeros. One pass over the days therefore filters all series.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Orders of the model.
AR_ORDER, MA_ORDER, LONG_AR = 5, 2, 10
RIDGE = 1e-3
#: Largest modulus of the roots of a recursion.
FADE = 0.995
#: Steps of the fit, and the relative gain under which a series is done.
MAX_STEPS, GAIN = 20, 1e-5


def less_lags(y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``y[t] - sum weights[k] * y[t - k - 1]``, with 0 before the first day."""
    out, product = y.copy(), np.empty_like(y)
    for k in range(min(weights.shape[1], y.shape[1] - 1)):
        part = product[:, k + 1:]
        np.multiply(weights[:, k:k + 1], y[:, :y.shape[1] - k - 1], out=part)
        out[:, k + 1:] -= part
    return out


def fading(weights: np.ndarray) -> np.ndarray:
    """Weights of recursions (a row each), shrunk so that all their roots stay within ``FADE``.

    Multiplying the k-th weight by c^k multiplies every root by c.
    """
    order = weights.shape[1]
    powers = np.arange(1, order + 1)
    out = weights.copy()
    # where this sum is at most 1, no root is larger than FADE
    open_rows = np.flatnonzero((np.abs(weights) * FADE**-powers).sum(axis=1) > 1)
    companion = np.zeros((len(open_rows), order, order))
    companion[:, powers[:-1], powers[:-1] - 1] = 1.0
    companion[:, 0] = weights[open_rows]
    largest = np.abs(np.linalg.eigvals(companion)).max(axis=1) if len(open_rows) else np.zeros(0)
    factor = np.where(largest > FADE, FADE / np.maximum(largest, FADE), 1.0)
    out[open_rows] *= factor[:, None] ** powers
    return out


def autocovariances(y: np.ndarray, order: int) -> np.ndarray:
    return np.stack([(y[:, k:] * y[:, :y.shape[1] - k]).sum(axis=1) for k in range(order + 1)], axis=1)


def yule_walker(y: np.ndarray, order: int) -> np.ndarray:
    """Autoregressions from autocovariances divided by the number of days, which are always stationary."""
    r = np.zeros((len(y), order + 1))
    known = autocovariances(y, min(order, y.shape[1] - 1))
    r[:, :known.shape[1]] = known
    toeplitz = r[:, np.abs(np.subtract.outer(np.arange(order), np.arange(order)))]
    toeplitz = toeplitz + (1e-9 * r[:, 0] + 1e-300)[:, None, None] * np.eye(order)
    return np.linalg.solve(toeplitz, r[:, 1:, None])[:, :, 0]


def filtered(x: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """``out[t] = x[t] - sum ma[j] * out[t - j - 1]`` along the last axis; ``x`` is (series, ..., days).

    The days come first while the recursion runs, so that a step reads and writes neighbouring numbers in place.
    """
    days = np.ascontiguousarray(np.moveaxis(x, -1, 0))
    out = np.zeros((len(days) + MA_ORDER, *days.shape[1:]))
    first, second = (np.ascontiguousarray(np.broadcast_to(w.reshape(-1, *([1] * (x.ndim - 2))), days.shape[1:])) for w in ma.T)
    product, places = np.empty(days.shape[1:]), list(out)
    for value, new, last, before in zip(days, places[MA_ORDER:], places[1:], places):
        np.multiply(first, last, out=new)
        np.subtract(value, new, out=new)
        np.multiply(second, before, out=product)
        np.subtract(new, product, out=new)
    return np.ascontiguousarray(np.moveaxis(out[MA_ORDER:], 0, -1))


def start_weights(y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """First weights: shocks of a long autoregression, then least squares on lags of values and shocks."""
    shocks = less_lags(y, yule_walker(y, LONG_AR))
    # shocks of the days before a series' first one are not zero only by the padding's doing
    shocks[np.arange(y.shape[1]) < (y.shape[1] - length)[:, None]] = 0.0
    gram, known = normal_equations(y, shocks, y)
    penalty = RIDGE * np.maximum((y * y).sum(axis=1), 1e-300)
    weights = np.linalg.solve(
        gram + penalty[:, None, None] * np.eye(AR_ORDER + MA_ORDER), known[:, :, None]
    )[:, :, 0]
    return held(weights)


def lag_products(x: np.ndarray, y: np.ndarray, lag: int) -> np.ndarray:
    """Sums of ``x[t] * y[t + lag]``."""
    return np.einsum("st,st->s", x[:, :max(x.shape[1] - lag, 0)], y[:, lag:])


def normal_equations(ar_side: np.ndarray, ma_side: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of the lags of two filtered series with each other and with a target.

    The product of two lags is that of the whole series at their distance, less the last days that the longer
    lag doesn't reach.
    """
    n, days = target.shape
    columns = [(ar_side, k + 1) for k in range(AR_ORDER)] + [(ma_side, k + 1) for k in range(MA_ORDER)]
    gram, known = np.zeros((n, len(columns), len(columns))), np.zeros((n, len(columns)))
    whole = {}
    for i, (x, p) in enumerate(columns):
        known[:, i] = lag_products(x, target, p)
        for j, (y, q) in enumerate(columns[:i + 1]):
            # x[t - p] * y[t - q]: the later one is the one with the shorter lag
            (early, far), (late, near) = ((x, p), (y, q)) if p >= q else ((y, q), (x, p))
            key = (early is ar_side, late is ar_side, far - near)
            if key not in whole:
                whole[key] = lag_products(early, late, far - near)
            left = max(days - far, 0)
            rest = (early[:, left:max(days - far + near, 0)] * late[:, left + far - near:days]).sum(axis=1)
            gram[:, i, j] = gram[:, j, i] = whole[key] - rest
    return gram, known


def held(weights: np.ndarray) -> np.ndarray:
    """Stationary and invertible weights."""
    return np.concatenate([fading(weights[:, :AR_ORDER]), -fading(-weights[:, AR_ORDER:])], axis=1)


def shocks_of(y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return filtered(less_lags(y, weights[:, :AR_ORDER]), weights[:, AR_ORDER:])


def fit(y: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, shocks, sum of squared shocks) of every series, never worse than :func:`start_weights`.

    A step solves the damped normal equations of the shocks' derivatives, which are lags of the filtered values
    and shocks. It is taken where the sum of squares falls; else the damping grows.
    """
    weights = start_weights(y, length)
    shocks = shocks_of(y, weights)
    error = (shocks * shocks).sum(axis=1)
    damping = np.full(len(y), 1e-3)
    open_rows = np.flatnonzero(error > 0)
    for _ in range(MAX_STEPS):
        if not len(open_rows):
            break
        own, e = y[open_rows], shocks[open_rows]
        both = filtered(np.stack([own, e], axis=1), weights[open_rows, AR_ORDER:])
        gram, known = normal_equations(both[:, 0], both[:, 1], e)
        scale = np.einsum("sii->si", gram)
        level = np.maximum(scale.max(axis=1, keepdims=True), 1e-300)
        diagonal = (damping[open_rows, None] * scale + 1e-12 * level)[:, :, None] * np.eye(gram.shape[1])
        step = np.linalg.solve(gram + diagonal, known[:, :, None])[:, :, 0]
        tried = held(weights[open_rows] + step)
        new = shocks_of(own, tried)
        reached = (new * new).sum(axis=1)
        better = reached < error[open_rows]
        rows = open_rows[better]
        gain = 1 - reached[better] / error[rows]
        weights[rows], shocks[rows], error[rows] = tried[better], new[better], reached[better]
        damping[rows] /= 10
        damping[open_rows[~better]] *= 10
        done = np.zeros(len(y), bool)
        done[rows[gain < GAIN]] = True
        done |= damping > 1e6
        open_rows = open_rows[~done[open_rows]]
    return weights, shocks, error


def paths(y: np.ndarray, length: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and AIC of every series; ``length`` is the number of its days."""
    weights, shocks, error = fit(y, length)
    ar, ma = weights[:, :AR_ORDER], weights[:, AR_ORDER:]
    floor = 1e-12 * (y * y).sum(axis=1) / length + 1e-300
    aic = length * np.log(np.maximum(error, floor) / length) + 2 * (weights.shape[1] + 1)
    past = np.concatenate([np.zeros((len(y), AR_ORDER)), y], axis=1)[:, -AR_ORDER:]
    last = np.concatenate([np.zeros((len(y), MA_ORDER)), shocks], axis=1)[:, -MA_ORDER:]
    out = np.zeros((len(y), AR_ORDER + steps))
    out[:, :AR_ORDER] = past
    ahead = np.zeros((len(y), MA_ORDER + steps))
    ahead[:, :MA_ORDER] = last
    for t in range(steps):
        out[:, AR_ORDER + t] = (ar * out[:, t:t + AR_ORDER][:, ::-1]).sum(axis=1) + (ma * ahead[:, t:t + MA_ORDER][:, ::-1]).sum(axis=1)
    return out[:, AR_ORDER:], aic


# Task functions travel inside the job, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
