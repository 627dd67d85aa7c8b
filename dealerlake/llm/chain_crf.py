"""Linear-chain conditional random fields in numpy, over many ragged sequences at once.

A sequence's positions lie next to each other in flat arrays. Steps run over the position
within a sequence; sequences are handled longest first, so that those still running are
always the first columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Layout:
    """Where the sequences of one batch lie: first position and length, longest first."""

    starts: np.ndarray
    lengths: np.ndarray
    running: np.ndarray  # how many sequences have more than t positions

    @classmethod
    def of(cls, lengths: np.ndarray) -> Layout:
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        ordered = lengths[order]
        longest = int(ordered[0]) if len(ordered) else 0
        running = np.searchsorted(-ordered, -np.arange(longest), side="left")
        return cls(starts[order], ordered, running)


def _sum_exp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


def marginals(unary: np.ndarray, moves: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward: chance of each label at each position, expected moves, sum of log normalisers.

    ``unary`` is [position, label], ``moves`` [label before, label after].
    """
    ahead, back = np.array(unary), np.zeros_like(unary)
    for t in range(1, len(layout.running)):
        at = layout.starts[: layout.running[t]] + t
        ahead[at] += _sum_exp(ahead[at - 1][:, :, None] + moves, 1)
    for t in range(len(layout.running) - 1, 0, -1):
        at = layout.starts[: layout.running[t]] + t
        back[at - 1] = _sum_exp(moves + (unary[at] + back[at])[:, None, :], 2)
    joint = ahead + back
    total = _sum_exp(joint, 1) if len(joint) else np.zeros(0)
    chance = np.exp(joint - total[:, None])
    expected = np.zeros_like(moves)
    for t in range(1, len(layout.running)):
        at = layout.starts[: layout.running[t]] + t
        pair = ahead[at - 1][:, :, None] + moves + (unary[at] + back[at])[:, None, :]
        expected += np.exp(pair - total[at][:, None, None]).sum(axis=0)
    filled = layout.lengths > 0
    return chance, expected, float(total[layout.starts[filled]].sum())


def best_path(unary: np.ndarray, moves: np.ndarray, layout: Layout) -> np.ndarray:
    """Viterbi: the likeliest label of each position; of equal paths the one with the smaller labels last."""
    labels = unary.shape[1]
    score = np.array(unary)
    came = np.zeros(unary.shape, np.int8)
    for t in range(1, len(layout.running)):
        at = layout.starts[: layout.running[t]] + t
        past = score[at - 1]
        now = score[at]
        for k in range(labels):
            through = past + moves[:, k]
            best = through.argmax(axis=1)
            came[at, k] = best
            now[:, k] += through.max(axis=1)
        score[at] = now
    path = np.zeros(len(unary), np.int64)
    filled = layout.lengths > 0
    last = (layout.starts + layout.lengths - 1)[filled]
    path[last] = score[last].argmax(axis=1)
    for t in range(len(layout.running) - 1, 0, -1):
        at = layout.starts[: layout.running[t]] + t
        path[at - 1] = came[at, path[at]]
    return path


class ChainCRF:
    """Weights for binned features: each position has one bin number per feature.

    ``bins`` is [position, feature] of row numbers into ``table`` [row, label].
    """

    def __init__(self, rows: int, labels: int):
        self.table = np.zeros((rows, labels))
        self.moves = np.zeros((labels, labels))

    def unary(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros((len(bins), self.table.shape[1]))
        for column in bins.T:
            total += self.table[column]
        return total

    def slopes(self, bins: np.ndarray, target: np.ndarray, layout: Layout, decay: float):
        """Penalised negative log likelihood per sequence and its slopes."""
        unary = self.unary(bins)
        chance, expected, total = marginals(unary, self.moves, layout)
        places = np.arange(len(target))
        reached = unary[places, target].sum()
        seen = np.zeros_like(self.moves)
        inner = np.ones(len(target), bool)
        inner[layout.starts[layout.lengths > 0]] = False
        after = np.flatnonzero(inner)
        np.add.at(seen, (target[after - 1], target[after]), 1)
        reached += (seen * self.moves).sum()
        count = max(1, int((layout.lengths > 0).sum()))
        chance[places, target] -= 1
        d_table = decay * self.table
        for column in bins.T:
            for k in range(chance.shape[1]):
                d_table[:, k] += np.bincount(column, chance[:, k], len(self.table)) / count
        d_moves = (expected - seen) / count + decay * self.moves
        loss = (total - reached) / count + decay / 2 * ((self.table**2).sum() + (self.moves**2).sum())
        return loss, d_table, d_moves

    def fit(self, bins: np.ndarray, target: np.ndarray, lengths: np.ndarray, steps: int, rate: float, decay: float) -> ChainCRF:
        """Adam over the whole training set."""
        layout = Layout.of(lengths)
        held = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.table, self.moves)]
        for step in range(1, steps + 1):
            _, *slopes = self.slopes(bins, target, layout, decay)
            for weights, slope, (mean, square) in zip((self.table, self.moves), slopes, held, strict=True):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        return self
