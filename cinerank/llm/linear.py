"""Small numpy fits on bounded samples: sparse logistic regression and non-negative PU risk."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def fit_sparse_logistic(lists: list[np.ndarray], y: np.ndarray, scale: np.ndarray, l2: float, epochs: int, rate: float, batch: int = 512, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights (already times ``scale``) and intercept for rows of 0/1 features times ``scale``.

    ``lists`` has each row's feature numbers.  Batches bound the memory: only one
    batch of rows is ever expanded.
    """
    n, d = len(y), len(scale)
    p0 = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 0.5
    w, b = np.zeros(d), np.log(p0 / (1 - p0))
    opt, rng = Adam(d + 1, rate), np.random.default_rng(seed)
    for turn in range(epochs if n else 0):
        order = rng.permutation(n)
        opt.rate = rate * (1 - turn / epochs)
        for at in range(0, n, batch):
            some = order[at : at + batch]
            cols = np.concatenate([lists[i] for i in some])
            rows = np.repeat(np.arange(len(some)), [len(lists[i]) for i in some])
            vals = scale[cols]
            z = np.bincount(rows, weights=w[cols] * vals, minlength=len(some)) + b
            r = (sigmoid(z) - y[some]) / len(some)
            g = np.bincount(cols, weights=r[rows] * vals, minlength=d) + l2 * w
            s = opt.step(np.append(g, r.sum()))
            w, b = w - s[:-1], b - s[-1]
    return w * scale, float(b)


def class_prior(score_p: np.ndarray, score_u: np.ndarray) -> float:
    """Share of positives among the unlabelled, by the best bin of a held-back split.

    Above any threshold the unlabelled hold at least ``prior`` times the
    positives' share, so the smallest ratio of the two shares (with a
    confidence margin that rules out tiny bins) bounds the prior from above
    and meets it where a bin is purely positive.
    """
    if len(score_p) == 0 or len(score_u) == 0:
        return 0.5
    cuts = np.quantile(score_p, np.linspace(0.0, 0.95, 96))
    qp = np.array([(score_p >= c).mean() for c in cuts])
    qu = np.array([(score_u >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(40.0) / (2 * len(score_p))) + np.sqrt(np.log(40.0) / (2 * len(score_u)))
    best = np.argmin((qu + slack) / np.maximum(qp, 1e-9))
    return float(np.clip(qu[best] / max(qp[best], 1e-9), 0.02, 0.99))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, l2: float, steps: int, rate: float, seed: int = 7, batch: int = 2048) -> tuple[np.ndarray, float]:
    """Linear weights and intercept that minimise the non-negative PU risk with logistic loss.

    Risk = prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); where a batch's
    negative part falls below zero the step descends on its overshoot instead,
    as the non-negative estimator prescribes.
    """
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    w, b = np.zeros(d), 0.0
    opt = Adam(d + 1, rate)
    for _ in range(steps if len(p) and len(u) else 0):
        xp = p[rng.integers(0, len(p), min(batch, len(p)))]
        xu = u[rng.integers(0, len(u), min(2 * batch, len(u)))]
        zp, zu = xp @ w + b, xu @ w + b
        neg = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gu, gp = sigmoid(zu) / len(zu), sigmoid(zp) / len(zp)
        gneg = np.append(xu.T @ gu - prior * (xp.T @ gp), gu.sum() - prior * gp.sum())
        if neg < 0:
            g = -gneg
        else:
            gpos = -sigmoid(-zp) / len(zp) * prior
            g = np.append(xp.T @ gpos, gpos.sum()) + gneg
        g[:-1] += l2 * w
        s = opt.step(g)
        w, b = w - s[:-1], b - s[-1]
    return w, float(b)
