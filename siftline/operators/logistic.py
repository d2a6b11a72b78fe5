"""Logistic regressions of many labels over the same rows, each label against the others, fitted side by side.

Objective and search are those of MLlib's ``LogisticRegression``: weighted rows, centred features at unit deviation, an L2 penalty,
L-BFGS with a strong Wolfe line search.  The searches of all labels advance together, so a step reads the rows once whatever the number
of labels.  Rows lie in blocks of numbers: ``lens`` entries ``(idx, tf)`` a row, ``tf`` as a place in the ``counts`` of the block, and an entry
is worth (1 + ln tf) * idf[idx] / norm[row].
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from siftline.session import durable

ITERATIONS, MEMORY, TOLERANCE, VALUES, PENALTY = 50, 10, 1e-6, 20, 0.01
BLOCK_SHAPE = "n long, lens binary, idx binary, count binary, counts binary, norm binary, label binary, weight binary"
# Entries of a block, so few that the numbers of a step stay in the cache of a core, and sums of tasks that the driver adds by itself.
ENTRIES, DRIVER_SUMS = 1 << 16, 64


def _narrow(numbers: np.ndarray) -> bytes:
    top = int(numbers.max(initial=0))
    return numbers.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)).tobytes()


def _wide(stored: bytes, n: int) -> np.ndarray:
    return np.frombuffer(stored, dtype=f"u{len(stored) // n}").astype(np.int64) if n else np.zeros(0, dtype=np.int64)


def packed(lens: np.ndarray, idx: np.ndarray, tf: np.ndarray, norm: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blocks of some ``ENTRIES`` as tables of one row; whole numbers take as few bytes as the largest of them needs."""
    ends = np.concatenate([[0], np.cumsum(lens)])
    cuts = np.unique([0, *(np.flatnonzero(np.diff(ends[:-1] // ENTRIES)) + 1), len(lens)])
    for a, b in zip(cuts[:-1], cuts[1:]):
        of = slice(ends[a], ends[b])
        counts, count = np.unique(tf[of], return_inverse=True)
        values = [_narrow(lens[a:b]), _narrow(idx[of]), _narrow(count), counts.astype(np.int64).tobytes(),
                  norm[a:b].astype(np.float64).tobytes(), _narrow(label[a:b]), weight[a:b].astype(np.float64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([b - a]), *(pa.array([v], pa.binary()) for v in values)], names=[c.split()[0] for c in BLOCK_SHAPE.split(", ")])


class _Block:
    def __init__(self, n, lens, idx, count, counts, norm, label, weight):
        self.lens, self.label, self.weight = _wide(lens, n), _wide(label, n), np.frombuffer(weight)
        entries = int(self.lens.sum())
        self.idx = _wide(idx, entries)
        self.log = np.take(1 + np.log(np.frombuffer(counts, dtype=np.int64)), _wide(count, entries))
        self.norm = np.where(self.lens > 0, np.frombuffer(norm), 1.0)
        self.filled = np.flatnonzero(self.lens)
        self.starts = (np.cumsum(self.lens) - self.lens)[self.filled]

    def margins(self, coefficients: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.lens))
        if len(self.filled):
            entries = np.take(coefficients, self.idx, mode="clip")
            entries *= self.log
            out[self.filled] = np.add.reduceat(entries, self.starts)
        return out / self.norm

    def by_feature(self, of_row: np.ndarray, size: int) -> np.ndarray:
        """The sum of ``of_row`` times the entries, for every feature and without its idf."""
        entries = np.repeat(of_row / self.norm, self.lens)
        entries *= self.log
        return np.bincount(self.idx, entries, minlength=size)


def _reduced(blocks: RDD, of_task: Callable, merge: Callable) -> np.ndarray:
    """The arrays that ``of_task`` makes of the blocks of each task, merged by the driver, or in tasks before if there are many."""
    sums = blocks.mapPartitions(of_task)
    return reduce(merge, sums.collect()) if sums.getNumPartitions() <= DRIVER_SUMS else sums.treeReduce(merge)


def _moments(idf: np.ndarray, labels: int) -> tuple[Callable, Callable]:
    """For every feature the weight, mean and sum of squared deviations of its entries; the weight of every label; the sum of squared weights."""
    size = len(idf)

    def of_block(stored):
        block = _Block(*stored)
        weight, value = np.repeat(block.weight, block.lens), block.log * idf[block.idx] / np.repeat(block.norm, block.lens)
        pivot = np.zeros(size)
        pivot[block.idx] = value  # one of the values, so equal ones deviate by nothing
        value -= pivot[block.idx]
        n, s, s2 = (np.bincount(block.idx, x, minlength=size) for x in (weight, weight * value, weight * value * value))
        mean = s / np.where(n > 0, n, 1.0)
        return np.concatenate([n, pivot + mean, s2 - s * mean, np.bincount(block.label, block.weight, minlength=labels), [np.sum(block.weight ** 2)]])

    def merge(a, b):
        (n, mean, m2), (o, other, o2) = (x[:3 * size].reshape(3, size) for x in (a, b))
        both = np.where(n + o > 0, n + o, 1.0)
        away = np.where((n > 0) & (o > 0), other - mean, 0.0)
        mean = np.where(n > 0, mean + away * o / both, other)
        return np.concatenate([n + o, mean, m2 + o2 + away * away * n * o / both, a[3 * size:] + b[3 * size:]])

    def of_task(blocks):
        total = None
        for stored in blocks:
            total = of_block(stored) if total is None else merge(total, of_block(stored))
        return [] if total is None else [total]

    return of_task, merge


def _losses(points: list[tuple[int, np.ndarray, float]], size: int) -> Callable:
    """For each of ``(label, coefficients, intercept)`` the loss, its slope by the intercept and its slopes by the coefficients."""
    def of_task(blocks):
        out = np.zeros((len(points), size + 2))
        for stored in blocks:
            block = _Block(*stored)
            for sums, (label, coefficients, intercept) in zip(out, points):
                margin, own = block.margins(coefficients) + intercept, block.label == label
                with np.errstate(over="ignore"):
                    slope = block.weight * (1 / (1 + np.exp(-margin)) - own)
                sums[0] += np.sum(block.weight * (np.logaddexp(0, -margin) + np.where(own, 0, margin)))
                sums[1] += slope.sum()
                sums[2:] += block.by_feature(slope, size)
        return [out]

    return of_task


class _NoStep(Exception):
    """The line search found no step."""


def _between(low: tuple, high: tuple) -> float:
    """The minimum of the cubic through two points ``(t, value, slope)``, kept off their ends."""
    (t0, f0, d0), (t1, f1, d1) = low, high
    a = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    b = np.sqrt(a * a - d0 * d1)
    t, wide = t1 - (t1 - t0) * (d1 + b - a) / (d1 - d0 + 2 * b), t1 - t0
    return t0 + 0.1 * wide if t < t0 + 0.1 * wide else t0 + 0.9 * wide if t > t0 + 0.9 * wide else t


def _step(x: np.ndarray, value: float, grad: np.ndarray, way: np.ndarray, t: float) -> Generator:
    """A step along ``way`` under the strong Wolfe conditions: the new point, value and gradient."""
    slope = grad @ way
    if slope > 0:
        raise _NoStep

    def tried(t):
        at = x + way * t
        f, g = yield at
        return (t, f, g @ way), (at, f, g)

    low, most = (0.0, value, slope), 10
    for i in range(most):
        now, point = yield from tried(t)
        if not np.isfinite(now[1]):
            t /= 2
            continue
        if now[1] > value + 1e-4 * t * slope or (now[1] >= low[1] and i > 0):
            low, high = low, now
        elif abs(now[2]) <= 0.9 * abs(slope):
            return t, point
        elif now[2] >= 0:
            low, high = now, low
        else:
            low, t = now, t * 1.5
            continue
        for _ in range(most):
            t = _between(high, low) if low[0] > high[0] else _between(low, high)
            now, point = yield from tried(t)
            if now[1] > value + 1e-4 * t * slope or now[1] >= low[1]:
                high = now
                continue
            if abs(now[2]) <= 0.9 * abs(slope):
                return t, point
            if now[2] * (high[0] - low[0]) >= 0:
                high = low
            low = now
        raise _NoStep
    raise _NoStep


def _downhill(grad: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    way, shares = grad.copy(), []
    for step, change in history:
        shares.append((step @ way) / (step @ change))
        way -= shares[-1] * change
    if history:
        scale = (history[0][0] @ history[0][1]) / (history[0][1] @ history[0][1])
        if not (scale >= 0 and np.isfinite(shares).all()):
            raise _NoStep
        way *= scale
    for (step, change), share in zip(reversed(history), reversed(shares)):
        way += (share - (change @ way) / (step @ change)) * step
    return -way


def search(x: np.ndarray) -> Generator:
    """L-BFGS as a generator: it yields points, is sent ``(value, gradient)`` of each, and returns the last point."""
    value, grad = yield x
    first, values, history, done, failed = value, [np.inf], [], 0, False
    while done < ITERATIONS and np.linalg.norm(grad) > max(TOLERANCE * abs(value), 1e-8):
        if len(values) > 1 and abs(value - max(values)) <= TOLERANCE * abs(first):
            break
        try:
            way = _downhill(grad, history)
            t, (at, f, g) = yield from _step(x, value, grad, way, 1.0 if done else 1 / np.linalg.norm(way))
            if t * np.linalg.norm(grad) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            history, failed = [], True
            continue
        history = [(at - x, g - grad), *history][:MEMORY]
        values = [*values, f][-VALUES:]
        x, value, grad, done, failed = at, f, g, done + 1, False
    return x


def fit_labels(blocks: DataFrame, idf: np.ndarray, labels: int) -> tuple[list[float], np.ndarray]:
    """Intercepts and coefficients, ``labels`` by features, of the rows of ``blocks`` (:func:`packed`), whose labels are numbers."""
    if labels == 1:  # nothing to tell apart
        return [float("inf")], np.zeros((1, len(idf)))
    # every step reads all blocks; what memory and disk do not hold any more is read from the table again
    parts = blocks.sparkSession.sparkContext.defaultParallelism
    held = durable(blocks.repartition(parts), "blocks").rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fitted(held, idf, labels)
    finally:
        held.unpersist()


def _fitted(blocks: RDD, idf: np.ndarray, labels: int) -> tuple[list[float], np.ndarray]:
    size = len(idf)
    found = _reduced(blocks, *_moments(idf, labels))
    (n, mean, m2), per_label, squares = found[:3 * size].reshape(3, size), found[3 * size:-1], found[-1]
    weight = per_label.sum()
    spread = weight - squares / weight
    # rows without an entry hold a zero
    deviation = np.sqrt(np.maximum((m2 + mean * mean * n * (weight - n) / weight) / spread, 0)) if spread > 0 else np.zeros(size)
    scale = np.divide(1.0, deviation, out=np.zeros(size), where=deviation > 0)
    center = mean * n / weight * scale
    searches = [search(np.append(np.zeros(size), np.log(own / (weight - own)))) for own in per_label]
    points, ends = {i: next(s) for i, s in enumerate(searches)}, {}
    while points:
        asked = [(i, x[:-1] * scale * idf, x[-1] - x[:-1] @ center) for i, x in points.items()]
        sums = _reduced(blocks, _losses(asked, size), np.add) / weight
        for (i, x), (loss, slope, *_), slopes in zip(list(points.items()), sums, sums[:, 2:]):
            loss += PENALTY / 2 * (x[:-1] @ x[:-1])
            grad = np.append(slopes * idf * scale - slope * center + PENALTY * x[:-1], slope)
            try:
                with np.errstate(all="ignore"):
                    points[i] = searches[i].send((loss, grad))
            except StopIteration as end:
                ends[i] = end.value
                del points[i]
    return [float(ends[i][-1] - ends[i][:-1] @ center) for i in range(labels)], np.array([ends[i][:-1] * scale for i in range(labels)])
