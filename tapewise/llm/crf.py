"""A linear-chain conditional random field over sequences of sparse binary features, in numpy."""

from __future__ import annotations

import numpy as np

from tapewise.llm.common import by_value


class Chain:
    """Two-label chain: ``emit[f, y]`` for the features of a block, ``move[y, z]`` between neighbours, ``start[y]``."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.names, self.emit, self.move, self.start = names, emit, move, start

    def scores(self, blocks: list[list[str]]) -> np.ndarray:
        rows = [[self.names[f] for f in fs if f in self.names] for fs in blocks]
        return np.array([self.emit[r].sum(0) if r else np.zeros(2) for r in rows]).reshape(len(rows), 2)

    def decode(self, blocks: list[list[str]]) -> list[int]:
        """The most probable labels (Viterbi)."""
        if not blocks:
            return []
        emit = self.scores(blocks).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = self.start[0] + emit[0][0], self.start[1] + emit[0][1]
        back = []
        for e0, e1 in emit[1:]:
            from0, from1 = int(b + m10 > a + m00), int(b + m11 > a + m01)
            a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
            back.append((from0, from1))
        label = int(b > a)
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]


def _gradient(sequences, params, n):
    """Mean negative log likelihood and its gradient, by forward and backward sums."""
    emit, move, start = params
    ge, gm, gs = np.zeros_like(emit), np.zeros_like(move), np.zeros_like(start)
    loss = 0.0
    for rows, flat, owner, labels in sequences:
        k = len(labels)
        e = np.stack([np.bincount(owner, emit[flat, y], k) for y in (0, 1)], 1)
        alpha, beta = np.zeros((k, 2)), np.zeros((k, 2))
        alpha[0] = start + e[0]
        for i in range(1, k):
            alpha[i] = np.logaddexp(alpha[i - 1][0] + move[0], alpha[i - 1][1] + move[1]) + e[i]
        for i in range(k - 2, -1, -1):
            x = beta[i + 1] + e[i + 1]
            beta[i] = np.logaddexp(move[:, 0] + x[0], move[:, 1] + x[1])
        z = np.logaddexp(*alpha[-1])
        node = np.exp(alpha + beta - z)
        want = np.zeros((k, 2))
        want[np.arange(k), labels] = 1
        loss += z - (start[labels[0]] + e[np.arange(k), labels].sum() + move[labels[:-1], labels[1:]].sum())
        diff = node - want
        for y in (0, 1):
            ge[:, y] += np.bincount(flat, diff[owner, y], len(emit))
        gs += diff[0]
        if k > 1:
            pair = np.exp(alpha[:-1, :, None] + move[None] + (beta[1:] + e[1:])[:, None, :] - z)
            gm += pair.sum(0)
            np.subtract.at(gm, (labels[:-1], labels[1:]), 1)
    return loss / n, [ge / n, gm / n, gs / n]


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 100, rate: float = 0.2, l2: float = 1e-4) -> Chain:
    """Fit on (features of each block, label of each block) pages by full-batch Adam with an L2 penalty."""
    names: dict[str, int] = {}
    sequences = []
    for blocks, labels in pages:
        if not blocks:
            continue
        rows = [[names.setdefault(f, len(names)) for f in fs] for fs in blocks]
        flat = np.array([i for r in rows for i in r], np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        sequences.append((rows, flat, owner, np.array(labels)))
    params = [np.zeros((max(1, len(names)), 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1) if sequences else ():
        _, grads = _gradient(sequences, params, len(sequences))
        for p, g, a, b in zip(params, grads, first, second):
            g = g + l2 * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return Chain(names, *params)


by_value(__name__)
