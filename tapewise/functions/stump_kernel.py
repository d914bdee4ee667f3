"""AdaBoost's weights and cuts: one round on a partition's sorted values, or a whole model on rows that fit a task (numpy, shipped to workers by value)."""

from __future__ import annotations

import math

import numpy as np


def compiled(stumps: list[tuple], p: int) -> tuple[float, list]:
    """Stumps (feature or None, threshold, left, right, alpha) as one step function per feature.

    Returns the sum of the weights given to class 1 by constant stumps, and per feature
    sorted thresholds with the weight for class 1 in each interval between them.
    """
    constant = sum(a for f, _, left, _, a in stumps if f is None and left)
    steps = []
    for f in range(p):
        own = sorted((t, left, right, a) for g, t, left, right, a in stumps if g == f)
        votes = np.zeros(len(own) + 1)
        for i, (_, left, right, a) in enumerate(own):
            votes[:i + 1] += a * left  # at or below the threshold
            votes[i + 1:] += a * right
        steps.append((np.array([t for t, *_ in own]), votes))
    return constant, steps


def votes(x: np.ndarray, constant: float, steps: list) -> np.ndarray:
    """Summed weight of the stumps that predict class 1."""
    out = np.full(len(x), float(constant))
    for f, (thresholds, values) in enumerate(steps):
        if len(thresholds):
            out += values[np.searchsorted(thresholds, x[:, f], side="left")]
    return out


def cells(f, r, salt, v, pos, neg):
    """Sums of ``pos`` and ``neg`` over equal neighbours (feature, range, salt, value)."""
    new = np.concatenate(([True], (f[1:] != f[:-1]) | (r[1:] != r[:-1]) | (salt[1:] != salt[:-1]) | (v[1:] != v[:-1])))
    at = np.flatnonzero(new)
    return f[at], r[at], salt[at], v[at], np.add.reduceat(pos, at), np.add.reduceat(neg, at)


def range_minima(f, r, salt, v, pos, neg, slack: float) -> dict:
    """Per (feature, range, salt) of sorted cells: totals, first value, and the cut after which class 1 (``a``) or
    class 0 (``b``) leads most on the left: its lead, value and the next value (NaN: none in the range)."""
    start = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (r[1:] != r[:-1]) | (salt[1:] != salt[:-1]))))
    size = np.diff(np.append(start, len(f)))
    group = np.repeat(np.arange(len(start)), size)
    p, n = np.cumsum(pos), np.cumsum(neg)
    lead = (n - p) - np.repeat((n - p)[start] - (neg - pos)[start], size)
    following = np.append(v[1:], np.nan)
    following[np.append(start[1:], len(f)) - 1] = np.nan
    out = {"f": f[start], "r": r[start], "salt": salt[start], "first": v[start], "pos": np.add.reduceat(pos, start), "neg": np.add.reduceat(neg, start)}
    for name, d in (("a", lead), ("b", -lead)):
        least = np.minimum.reduceat(d, start)
        near = np.flatnonzero(d <= least[group] + slack)
        at = near[np.unique(group[near], return_index=True)[1]]
        out |= {name: least, f"{name}_value": v[at], f"{name}_next": following[at]}
    return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int, rate: float, share: float) -> list[tuple]:
    """A whole model on rows that fit one task: per round (feature, threshold, left, right, alpha, error).

    Errors that differ by less than ``share`` of all weight are ties, as in the rounds over ranges of values.
    """
    n, positive, slack = len(y), y > 0, share * len(y)
    features = []
    for f in range(x.shape[1]):
        values, codes = np.unique(x[:, f], return_inverse=True)
        # a cut lies below a value that is not missing
        features.append((values, codes.astype("int64"), int((~np.isnan(values)).sum()) - 1))
    votes, whole, scale, out = np.zeros(n), 0.0, 0.0, []
    while len(out) < rounds:
        w = np.exp(np.where(positive, whole - votes, votes) - scale)
        ones, zeros = float(w[positive].sum()), float(w[~positive].sum())
        signed, sides, best = np.where(positive, -w, w), [], np.inf
        for values, codes, cuts in features:
            lead = np.cumsum(np.bincount(codes, signed, len(values))[:cuts]) if cuts > 0 else np.zeros(0)
            sides.append(lead)
            if cuts > 0:
                best = min(best, ones + lead.min(), zeros - lead.max())
        if best >= min(ones, zeros) - slack:
            f, threshold, left, e = None, None, 1.0 if ones > zeros else 0.0, min(ones, zeros)
            right = left
        else:
            f, cut, left, e = _first_cut(sides, ones, zeros, best + slack)
            low, high = features[f][0][cut:cut + 2]
            mid, right = low + (high - low) / 2, 1.0 - left
            threshold = float(mid if mid < high else low)
        err = e / n
        if err <= share or err >= 0.5:
            if not out or err <= share:
                out.append((f or 0, threshold, left, right, 1.0, err))
            break
        alpha = rate * math.log((1.0 - err) / err)
        out.append((f or 0, threshold, left, right, alpha, err))
        whole += alpha
        if threshold is None:
            votes = votes + alpha * left
        else:
            votes = votes + alpha * np.where(x[:, f] <= threshold, left, right)
        scale += math.log((1.0 - err) + err * math.exp(alpha))
    return out


def _first_cut(sides: list[np.ndarray], ones: float, zeros: float, most: float) -> tuple[int, int, float, float]:
    """Feature, cut, class on the left and error of the first cut with an error of at most ``most``."""
    for f, lead in enumerate(sides):
        near = np.flatnonzero((ones + lead <= most) | (zeros - lead <= most))
        if len(near):
            cut = int(near[0])
            left = 1.0 if ones + lead[cut] <= most else 0.0
            return f, cut, left, float(ones + lead[cut] if left else zeros - lead[cut])
    raise ValueError("no cut has the least error")
