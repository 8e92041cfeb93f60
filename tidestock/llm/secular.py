"""Eigenvalues and eigenvectors of a scatter matrix under rank-one updates.

``A + v v'`` has, in the eigenbasis of ``A``, the matrix ``D + z z'`` with ``z`` the coordinates of ``v``. Its
eigenvalues are the roots of the secular equation ``1 + sum z_j^2 / (d_j - x) = 0``, one between neighbouring
entries of ``D``; its eigenvectors are ``z_j / (d_j - x)``. Coordinates too small to matter and entries of ``D``
too close to tell apart are deflated first: they keep their eigenvectors, the latter after a rotation.
"""

from __future__ import annotations

import numpy as np

EPSILON = np.finfo(np.float64).eps
MAX_STEPS = 200


def deflated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray) -> list[int]:
    """Indices that stay in the secular equation; the arrays are changed in place."""
    size = float(np.sqrt(z @ z))
    bound = 8 * EPSILON * max(float(values[-1]), size * size)
    stays: list[int] = []
    last = -1
    for j in range(len(z)):
        if abs(z[j]) * size <= bound:
            z[j] = 0.0
            continue
        if last >= 0:
            length = float(np.hypot(z[last], z[j]))
            c, s = z[j] / length, z[last] / length
            if abs((values[j] - values[last]) * c * s) <= bound:
                a, b = vectors[:, last].copy(), vectors[:, j].copy()
                vectors[:, last], vectors[:, j] = c * a - s * b, s * a + c * b
                low, high = values[last], values[j]
                values[last], values[j] = c * c * low + s * s * high, s * s * low + c * c * high
                z[last], z[j] = 0.0, length
                last = j
                continue
            stays.append(last)
        last = j
    return [*stays, last] if last >= 0 else stays


def roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Roots of ``1 + sum weights / (poles - x)``: the nearest pole of each, its distance, all poles less that one.

    Every step fits a pole on each side to the two halves of the sum; a step that leaves the bracket is halved.
    """
    k = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum())
    half = (ends - poles) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        middle = 1 + (weights / (poles - (poles + half)[:, None])).sum(axis=1)
    right = (middle < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, np.append(poles[1:], 0.0), poles)
    away = poles[None, :] - origin[:, None]
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    low[-1], high[-1] = 0.0, ends[-1] - poles[-1]
    if middle[-1] < 0:
        low[-1] = half[-1]
    else:
        high[-1] = half[-1]
    shift = (low + high) / 2
    left = np.tri(k, dtype=bool)
    at = np.arange(k)
    near = away[at, at]
    far = np.append(away[at[:-1], at[1:]], np.inf)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(MAX_STEPS):
            gaps = away - shift[:, None]
            terms = weights / gaps
            value = 1 + terms.sum(axis=1)
            low, high = np.where(value < 0, shift, low), np.where(value >= 0, shift, high)
            small = np.abs(value) <= 2 * k * EPSILON * (1 + np.abs(terms).sum(axis=1))
            done = small | (high - low <= 2 * EPSILON * np.maximum(np.abs(low), np.abs(high)))
            if done.all():
                break
            slopes = terms / gaps
            psi, phi = (terms * left).sum(axis=1), (terms * ~left).sum(axis=1)
            dpsi, dphi = (slopes * left).sum(axis=1), (slopes * ~left).sum(axis=1)
            a, b = near - shift, far - shift
            c = 1 + psi - dpsi * a + np.where(np.isinf(b), 0.0, phi - dphi * b)
            q, s = dpsi * a * a, np.where(np.isinf(b), 0.0, dphi * b * b)
            p1, p0 = c * (a + b) + q + s, value * a * b
            root = np.sqrt(np.maximum(p1 * p1 - 4 * c * p0, 0.0))
            step = np.where(p1 > 0, 2 * p0 / (p1 + root), (p1 - root) / (2 * c))
            step[-1] = a[-1] + q[-1] / c[-1]
            new = shift + step
            inside = np.isfinite(new) & (new > low) & (new < high)
            same_sign = low * high > 0
            middle = np.where(same_sign, np.sign(low + high) * np.sqrt(np.abs(low) * np.abs(high)), (low + high) / 2)
            shift = np.where(done, shift, np.where(inside, new, middle))
    return origin, shift, away


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and their eigenvectors (columns) of ``vectors diag(values) vectors' + v v'``."""
    values, vectors, z = values.copy(), vectors.copy(), vectors.T @ v
    stays = deflated(values, vectors, z)
    if not stays:
        return values, vectors
    poles, own = values[stays], z[stays]
    if len(stays) == 1:
        values[stays] += own * own
    else:
        origin, shift, away = roots(poles, own * own)
        gaps = away - shift[:, None]  # pole less root: a row for each root
        # the weights whose equation has exactly these roots make the eigenvectors orthogonal
        apart = poles[:, None] - poles[None, :]
        np.fill_diagonal(apart, 1.0)
        exact = np.sqrt(np.abs(np.prod(-gaps / apart, axis=0))) * np.sign(own)
        turned = exact / gaps
        turned /= np.sqrt((turned * turned).sum(axis=1))[:, None]
        vectors[:, stays] = vectors[:, stays] @ turned.T
        values[stays] = origin + shift
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]
