"""Exact greedy tree growth on one node's rows, all nodes of a level at once (numpy, shipped to workers by value).

A node tries its features in a random order of its own and takes the best cut
among the first ``max_features`` that can be cut at all.  A cut lies half way
between neighbouring values; the best one has the highest sum over both sides of
(class weights squared) / weight, the least Gini impurity, with ties to the lower
feature, then the lower value.  Growth stops at pure nodes, or where a node has
less weight than ``min_split``, no cut leaves ``min_leaf`` on both sides, or
``max_depth`` is reached.  Everything random is a function of the node's id, so a
node grows the same subtree wherever it is grown.
"""

from __future__ import annotations

import math

import numpy as np

U = np.uint64
ROOT = 1


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit hash (the finaliser of splitmix64)."""
    z = values.astype(U) + U(0x9E3779B97F4A7C15)
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def child_ids(ids: np.ndarray, side: int) -> np.ndarray:
    """Ids of the left (0) or right (1) children."""
    return mix(ids.astype(U) ^ U(0x5851F42D4C957F2D + side))


def feature_order(ids: np.ndarray, seed: int, p: int) -> np.ndarray:
    """A random order of the ``p`` features for each node."""
    keys = mix(mix(ids.astype(U) ^ mix(np.array([seed], U)))[:, None] ^ np.arange(1, p + 1, dtype=U))
    return np.argsort(keys, axis=1, kind="stable")


def middle(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Half way between two neighbouring values, below the higher one; the lower one if the other is not finite."""
    mid = low + (high - low) / 2
    return np.where((mid < high) & np.isfinite(mid), mid, low)


def value_codes(x: np.ndarray) -> np.ndarray:
    """Per feature the rank of each row's value among the distinct ones."""
    codes = np.empty(x.shape, "int32")
    for f in range(x.shape[1]):
        codes[:, f] = np.unique(x[:, f], return_inverse=True)[1]
    return codes


def poisson(draw: np.ndarray, most: int = 12) -> np.ndarray:
    """Poisson(1) weight of a uniform draw."""
    chances = [math.exp(-1) / math.factorial(k) for k in range(most)]
    return np.searchsorted([sum(chances[:k + 1]) for k in range(most)], draw, side="right").astype("float64")


def xxhash64(values: np.ndarray, seed: int) -> np.ndarray:
    """Spark's ``xxhash64`` of 64-bit integers after columns whose hash is ``seed``."""
    p1, p2, p3, p4, p5 = (U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(v, by):
        return (v << U(by)) | (v >> U(64 - by))

    with np.errstate(over="ignore"):
        h = (np.array([seed], "int64").view(U) + p5 + U(8)) ^ (turned(values.astype("int64").view(U) * p2, 31) * p1)
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> U(33))) * p2
        h = (h ^ (h >> U(29))) * p3
        return h ^ (h >> U(32))


def _sorted(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys (below ``most``) in order, and the stable order; key and position sort as one number where they fit."""
    bits = max(1, len(key) - 1).bit_length()
    if int(most) << bits < 1 << 63:
        packed = np.sort((key << bits) | np.arange(len(key)))
        return packed >> bits, packed & ((1 << bits) - 1)
    by = np.argsort(key, kind="stable")
    return key[by], by


def values_of(x: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
    """Per feature the value of each rank in ``codes``."""
    out = []
    for f in range(x.shape[1]):
        out.append(np.zeros(int(codes[:, f].max(initial=-1)) + 1))
        out[f][codes[:, f]] = x[:, f]
    return out


class _Ranks:
    """Ranks of the rows' values on the features of more than one value; rows move as a whole."""

    def __init__(self, codes: np.ndarray):
        self.varied = codes.max(axis=0, initial=0) > 0
        kept = np.flatnonzero(self.varied) if self.varied.any() else np.arange(min(1, codes.shape[1]))
        self.column = np.zeros(codes.shape[1], "int64")
        self.column[kept] = np.arange(len(kept))
        self.held = np.empty((len(codes), len(kept)), "uint16" if codes.max(initial=0) < 1 << 16 else "int32")
        for i, f in enumerate(kept):
            self.held[:, i] = codes[:, f]

    def keep(self, rows) -> None:
        self.held = np.take(self.held, rows, axis=0)
        self.base = np.arange(len(rows)) * self.held.shape[1]

    def of(self, feature: np.ndarray, size: np.ndarray, mine=slice(None)) -> np.ndarray:
        """Ranks on each node's feature, of some rows in order of their nodes."""
        return np.take(self.held.reshape(-1), self.base[mine] + np.repeat(self.column[feature], size)).astype("int64")


def _column_cuts(group, bits, runs, sizes, n, n1, min_leaf, check):
    """Best cut of each node from its rows in order of one feature: (nodes, scores, ranks below and above the cut) of those that can be cut.

    ``group``: node and rank of each row, in order; ``runs``: running sums of the weights, one of both in an integer or two.
    """
    step = (group[1:] ^ group[:-1]).view(U)
    cut = np.flatnonzero(step - U(1) < U((1 << bits) - 1))
    at = group[cut]
    own = at >> bits
    before = np.cumsum(sizes) - sizes
    sums = [run[cut] - np.concatenate((np.zeros(1, run.dtype), run))[before][own] for run in runs]
    left, left1 = sums if len(sums) == 2 else ((sums[0] & 0xFFFFFFFF).astype("float64"), (sums[0] >> 32).astype("float64"))
    right, right1 = n[own] - left, n1[own] - left1
    if check:
        keep = (left >= min_leaf) & (right >= min_leaf)
        if not keep.all():
            cut, at, own, left, left1, right, right1 = (v[keep] for v in (cut, at, own, left, left1, right, right1))
    if not len(cut):
        return own, left, at, at
    score = (left1 * left1 + (left - left1) * (left - left1)) / left + (right1 * right1 + (right - right1) * (right - right1)) / right
    starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    top = np.maximum.reduceat(score, starts)
    best = np.flatnonzero(score == np.repeat(top, np.diff(np.append(starts, len(own)))))
    if len(best) > len(starts):
        best = best[np.concatenate(([True], own[best][1:] != own[best][:-1]))]
    mask = (1 << bits) - 1
    return own[best], score[best], at[best] & mask, group[cut[best] + 1] & mask


def grow(x: np.ndarray | None, y: np.ndarray, w: np.ndarray, root: int, depth: int, seed: int, max_features: int | None,
         min_leaf: float, min_split: float, max_depth: int | None, codes: np.ndarray | None = None, values: list[np.ndarray] | None = None) -> dict:
    """The subtree under node ``root``: arrays over its nodes (feature -1: leaf; children by position).

    ``codes``: ranks of the values per feature, of these rows or of more; ``values``: the value of each rank (``x`` is not read then).
    """
    codes = value_codes(x) if codes is None else codes
    values = values_of(x, codes) if values is None else values
    p = codes.shape[1]
    m = min(max_features or p, p)
    table, offset = np.concatenate(values) if p else np.zeros(0), np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype("int64")
    wy = w * y
    # whole weights: both sums run in one integer
    whole = w.sum() < 1 << 31 and (w == np.floor(w)).all() and (wy == np.floor(wy)).all()
    check = not (whole and min_leaf <= 1 and w.min(initial=1) >= 1)
    bits = max(1, int(codes.max()).bit_length()) if codes.size else 1
    # small weights and the label sort along with the rank, so that no sum has to look its rows up
    tag, low = None, 0
    if whole and len(y) and w.min() >= 0 and ((y == 0) | (y == 1)).all():
        low = int(w.max()).bit_length() + 1
        if low <= 12 and len(y).bit_length() + bits + low < 62:
            tag = (w.astype("int64") << 1) | y.astype("int64")
            number = np.arange(1 << low)
            weight, weight1 = (number >> 1).astype("float64"), ((number >> 1) * (number & 1)).astype("float64")
            both = (number >> 1) + (((number >> 1) * (number & 1)) << 32)
    weights = ((w.astype("int64") + (wy.astype("int64") << 32)),) if whole else (w, wy)
    out = {k: [] for k in ("feature", "threshold", "left", "right", "n", "n1")}
    seg, ids, total = np.zeros(len(y), "int64"), np.array([root], "int64").view(U), 0
    ranks = _Ranks(codes)
    codes, varied = None, int(ranks.varied.sum())
    while len(ids):
        s = len(ids)
        n, n1 = (np.bincount(seg, v, s) for v in ((w, wy) if tag is None else (weight[tag], weight1[tag])))
        open_ = (n1 > 0) & (n1 < n) & (n >= min_split) & (n >= 2 * min_leaf)
        if max_depth is not None and depth >= max_depth:
            open_[:] = False
        feature, below, above, score = np.full(s, -1), np.zeros(s, "int64"), np.zeros(s, "int64"), np.full(s, -np.inf)
        # the rows of open nodes, one node after another
        rows = np.flatnonzero(open_[seg])
        rows = rows[_sorted(seg[rows], s)[1]]
        sizes = np.bincount(seg, minlength=s)
        sizes[~open_] = 0
        seg = np.repeat(np.arange(s), sizes)
        ranks.keep(rows)
        if tag is None:
            w, wy, weights = w[rows], wy[rows], tuple(v[rows] for v in weights)
        else:
            tag = tag[rows]
        if len(rows):
            order, found = feature_order(ids, seed, p), np.zeros(s, "int64")
            order = order[ranks.varied[order]].reshape(s, varied)  # no node can be cut on a feature of one value
            stem = None if tag is None else (seg << (bits + low)) | tag
            for j in range(varied):
                lacking = open_ & (found < m)
                if not lacking.any():
                    break
                # before m features are tried, every open node takes part
                mine = slice(None) if (lacking == open_).all() else np.flatnonzero(lacking[seg])
                size = np.where(lacking, sizes, 0)
                column = ranks.of(order[:, j], size, mine)
                if tag is not None:
                    key = (column << low) | stem[mine]
                    key.sort()
                    group, runs = key >> low, (np.cumsum(both[key & ((1 << low) - 1)]),)
                else:
                    group, by = _sorted((seg[mine] << bits) | column, s << bits)
                    runs = tuple(np.cumsum(v[mine][by]) for v in weights)
                own, sc, lo, hi = _column_cuts(group, bits, runs, size, n, n1, min_leaf, check)
                found[own] += 1
                better = (sc > score[own]) | ((sc == score[own]) & (order[own, j] < feature[own]))
                own = own[better]
                feature[own], below[own], above[own], score[own] = order[own, j], lo[better], hi[better], sc[better]
        split = feature >= 0
        threshold = np.zeros(s)
        threshold[split] = middle(table[offset[feature[split]] + below[split]], table[offset[feature[split]] + above[split]])
        children = np.cumsum(split) - 1
        nxt = total + s
        out["feature"].append(feature)
        out["threshold"].append(threshold)
        out["left"].append(np.where(split, nxt + 2 * children, -1))
        out["right"].append(np.where(split, nxt + 2 * children + 1, -1))
        out["n"].append(n)
        out["n1"].append(n1)
        seg = 2 * np.repeat(children, sizes) + (ranks.of(np.maximum(feature, 0), sizes) > np.repeat(below, sizes))
        if not split[open_].all():
            moving = np.flatnonzero(np.repeat(split, sizes))
            seg = seg[moving]
            ranks.keep(moving)
            if tag is None:
                w, wy, weights = w[moving], wy[moving], tuple(v[moving] for v in weights)
            else:
                tag = tag[moving]
        ids = np.stack((child_ids(ids[split], 0), child_ids(ids[split], 1)), axis=1).ravel()
        total, depth = nxt, depth + 1
    return {k: np.concatenate(v) for k, v in out.items()}


def paths(tree: dict, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the rows that reach it and their nodes, from the root down."""
    rows, node, out = np.arange(len(x)), np.zeros(len(x), "int64"), []
    while len(rows):
        out.append((rows, node))
        f = tree["feature"][node]
        rows, node, f = rows[f >= 0], node[f >= 0], f[f >= 0]
        node = np.where(x[rows, f] <= tree["threshold"][node], tree["left"][node], tree["right"][node])
    return out


def alike(codes: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Number of each row's (values, label) cell, if there are less than half as many cells as rows."""
    cell = y.astype("int64")
    for f in range(codes.shape[1]):
        cell = np.unique(cell * (int(codes[:, f].max()) + 1) + codes[:, f], return_inverse=True)[1]
        if 2 * (int(cell.max()) + 1) > len(y):
            return None
    return cell


def leaves(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    leaf = np.zeros(len(x), "int64")
    rows, node = np.arange(len(x)), leaf
    while len(rows):
        f = tree["feature"][node]
        ends = f < 0
        leaf[rows[ends]] = node[ends]
        rows, node, f = rows[~ends], node[~ends], f[~ends]
        node = np.where(x[rows, f] <= tree["threshold"][node], tree["left"][node], tree["right"][node])
    return leaf


def importances(tree: dict, p: int) -> np.ndarray:
    """Weighted Gini decrease per feature, not normalised."""
    inner = np.flatnonzero(tree["feature"] >= 0)
    impurity = tree["n"] - (tree["n1"] ** 2 + (tree["n"] - tree["n1"]) ** 2) / tree["n"]
    gain = impurity[inner] - impurity[tree["left"][inner]] - impurity[tree["right"][inner]]
    return np.bincount(tree["feature"][inner], gain, p)
