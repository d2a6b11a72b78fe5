"""Naive Bayes support vectors on hashed indicators: log-count ratios, a linear hinge loss, scores from 0 to 1.

Everything here works on a bounded sample of labelled documents, whose size is a parameter of the caller.  A sample is a
list of index arrays (the features that are present), each with the value that its features get, and labels 0 or 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    """``weights`` already holds the log-count ratios; the score is the logistic of slope * margin + offset."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        margins = np.array([self.weights[i].astype(np.float64) @ v for i, v in rows], dtype=np.float64) + self.bias
        return logistic(self.slope * margins + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, smoothing: float = 1.0) -> np.ndarray:
    """log of the smoothed share of a feature among the positive counts over that among the negative ones."""
    counts = np.full((2, size), smoothing)
    for index, label in zip(rows, labels, strict=True):
        counts[int(label), index] += 1.0
    shares = counts / counts.sum(axis=1, keepdims=True)
    # a feature that nobody has tells nothing
    return np.where(counts.sum(axis=0) > 2 * smoothing, np.log(shares[1] / shares[0]), 0.0)


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, cost: float, passes: int) -> tuple[np.ndarray, float]:
    """Minimises |w|^2 / 2 + cost * hinge by coordinate steps in the dual, with a constant feature as bias."""
    sign = np.where(labels > 0, 1.0, -1.0)
    limit = cost * np.where(labels > 0, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    squares = np.array([v @ v for _, v in rows]) + 1.0
    dual, weights, bias = np.zeros(len(rows)), np.zeros(size), 0.0
    order = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            gradient = sign[i] * (weights[index] @ value + bias) - 1.0
            after = min(max(dual[i] - gradient / squares[i], 0.0), limit[i])
            step = (after - dual[i]) * sign[i]
            if step:
                dual[i] = after
                weights[index] += step * value
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, with softened targets."""
    n_pos, n_neg = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    design = np.stack([margins, np.ones(len(margins))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = logistic(design @ beta)
        slope = design.T @ (p - target) + 1e-3 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, cost: float = 1.0, passes: int = 20, share: float = 1.0) -> Model:
    """Ratios and weights from all rows; the curve from margins of rows that the fit behind them has not seen.

    With ``share`` below 1 the weights are mixed with their mean size, which leans towards plain naive Bayes.
    """
    labels = np.asarray(labels, dtype=np.float64)
    if len(rows) == 0 or labels.min() == labels.max():  # nothing to separate
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(size, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))

    def once(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        ratios = log_count_ratios([rows[i][0] for i in chosen], labels[chosen], size)
        scaled = [(rows[i][0], (rows[i][1] * ratios[rows[i][0]]).astype(np.float32)) for i in chosen]
        weights, bias = dual_descent(scaled, labels[chosen], size, cost, passes)
        weights = share * weights + (1 - share) * (np.abs(weights[weights != 0]).mean() if weights.any() else 0.0)
        return weights * ratios, bias

    margins = np.zeros(len(rows))
    folds = np.arange(len(rows)) % 3
    for fold in range(3):
        inside = np.flatnonzero(folds != fold)
        weights, bias = once(inside)
        for i in np.flatnonzero(folds == fold):
            margins[i] = weights[rows[i][0]] @ rows[i][1] + bias
    slope, offset = calibrated(margins, labels)
    weights, bias = once(np.arange(len(rows)))
    return Model(weights.astype(np.float32), bias, slope, offset)
