"""Sparse rule ensembles: paths of small boosted trees as rules, weighed by lasso logistic regression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 64


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is above, threshold) and its weight."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, t in self.terms:
            out &= (x[:, f] > t) == above
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    """Log-odds of label 1: intercept plus the weights of the rules that hold."""

    intercept: float
    rules: tuple[Rule, ...]
    names: tuple[str, ...]

    def column(self) -> Column:
        """The chance of label 1 as an expression over the statistics' columns."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            terms = [(F.col(self.names[f]) > t) if above else (F.col(self.names[f]) <= t) for f, above, t in rule.terms]
            total = total + F.when(reduce(Column.__and__, terms), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule in self.rules:
            total += rule.weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: int) -> tuple[list[tuple], np.ndarray]:
    """Paths of one tree on gradients, and its prediction. Splits by second-order gain over bins."""
    paths: list[tuple] = []
    out = np.zeros(len(g))
    todo = [(np.arange(len(g)), ())]
    while todo:
        rows, terms = todo.pop()
        if terms:
            paths.append(terms)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, 0)
        if len(terms) < depth and len(rows) >= 2 * least:
            for f in range(binned.shape[1]):
                size = len(edges[f]) + 1
                if size < 2:
                    continue
                b = binned[rows, f]
                left_g = np.cumsum(np.bincount(b, g[rows], size))[:-1]
                left_h = np.cumsum(np.bincount(b, h[rows], size))[:-1]
                left_n = np.cumsum(np.bincount(b, minlength=size))[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                gain[(left_n < least) | (len(rows) - left_n < least)] = 0
                if gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
        _, f, at = best
        if f < 0:
            out[rows] = -total_g / (total_h + 1)
            continue
        low = binned[rows, f] <= at
        threshold = float(edges[f][at])
        todo += [(rows[low], (*terms, (f, False, threshold))), (rows[~low], (*terms, (f, True, threshold)))]
    return paths, out


def fit(
    x: np.ndarray, y: np.ndarray, names: tuple[str, ...], trees: int = 24, depth: int = 3,
    rate: float = 0.3, penalty: float = 0.002, rounds: int = 400,
) -> RuleEnsemble:
    """Boost trees, take every path as a rule, keep what an L1-penalised logistic fit weighs.

    With no rows the score is 0.5, with one label only its smoothed share.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if len(y) < 4 or y.min() == y.max():
        return RuleEnsemble(base, (), names)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    least = max(2, len(y) // 500)
    margin, paths = np.full(len(y), base), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        found, step = _tree(binned, edges, p - y, p * (1 - p), depth, least)
        margin += rate * step
        paths |= dict.fromkeys(tuple(sorted(t)) for t in found)
    candidates = [Rule(t) for t in paths]
    held = np.column_stack([r.holds(x) for r in candidates]).astype(np.float64) if candidates else np.zeros((len(y), 0))
    weights, intercept = _lasso(held, y, base, penalty, rounds)
    kept = tuple(Rule(r.terms, float(w)) for r, w in zip(candidates, weights, strict=True) if abs(w) > 1e-4)
    return RuleEnsemble(intercept, kept, names)


def _lasso(a: np.ndarray, y: np.ndarray, intercept: float, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient for the L1-penalised log loss; the intercept is free."""
    n, m = a.shape
    w = z = np.zeros(m)
    b = c = intercept
    v = np.ones(m + 1)
    for _ in range(20):  # largest eigenvalue, for the step
        u = a @ v[:-1] + v[-1]
        v = np.r_[a.T @ u, u.sum()]
        scale = np.linalg.norm(v)
        v /= scale
    step, t = 4 * n / scale, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(a @ z + c))) - y) / n
        moved = z - step * (a.T @ error)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = c - step * error.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w, float(b)
