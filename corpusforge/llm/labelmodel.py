"""A generative model over the votes of labelling functions.

Votes are small integers (0 abstains). Only the distinct vote patterns with their counts are needed,
so the model is fitted on a table whose size is bounded by the number of patterns, whatever the
data. The hidden class has two or more values, so that what is no match can be of several kinds (a
related thing, an unrelated one) that the functions treat differently. Given the class, each function depends on at most one other: the
dependency tree of greatest conditional mutual information (Chow and Liu) is found under the
current posterior, so correlated functions are not counted twice. Expectation-maximisation starts
from a soft guess, which should lean on functions known to err independently (a block of copies that
outweighs the rest at the start would be taken for the truth), and learns the class priors, each function's accuracies and the correlations.
"""

from __future__ import annotations

import numpy as np

MOST_PATTERNS = 200_000


def _tree(v: np.ndarray, w: np.ndarray, k: int) -> list[int]:
    """Parent of each function (-1: none) by greatest class-conditional mutual information. v: patterns x functions in 0..k-1; w: patterns x classes."""
    m = v.shape[1]
    info = np.zeros((m, m))
    total = w.sum()
    for i in range(m):
        for j in range(i + 1, m):
            for y in range(w.shape[1]):
                joint = np.zeros((k, k))
                np.add.at(joint, (v[:, i], v[:, j]), w[:, y])
                n = joint.sum()
                if n <= 0:
                    continue
                p = joint / n
                outer = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
                at = p > 0
                info[i, j] += n / total * (p[at] * np.log(p[at] / outer[at])).sum()
            info[j, i] = info[i, j]
    parent, inside = [-1] * m, [0]
    while len(inside) < m:
        gain, i, j = max((info[i, j], -i, -j) for i in inside for j in range(m) if j not in inside)
        i, j = -i, -j
        parent[j] = i if gain > 1e-3 else -1
        inside.append(j)
    return parent


def fit(votes: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int = 80, smooth: float = 0.5) -> tuple[np.ndarray, dict]:
    """(posterior: patterns x classes, what was learned). votes: patterns x functions; start: patterns x classes, the first guess."""
    if not len(votes):
        return np.zeros_like(start, float), {"prior": [], "parents": []}
    v = votes - votes.min()
    k, m, classes = int(v.max()) + 1, votes.shape[1], start.shape[1]
    q = start / start.sum(1, keepdims=True)
    parents = [-1] * m
    for turn in range(rounds):
        w = q * counts[:, None]
        if turn in (0, 3, 10, 25):
            parents = _tree(v, w, k)
        prior = (w.sum(0) + 1) / (w.sum() + classes)
        logp = np.log(prior)[None].repeat(len(v), 0)
        for i in range(m):
            for y in range(classes):
                own = np.bincount(v[:, i], w[:, y], k) + smooth
                own /= own.sum()
                if parents[i] < 0:
                    logp[:, y] += np.log(own[v[:, i]])
                    continue
                pa = v[:, parents[i]]
                joint = np.zeros((k, k))
                np.add.at(joint, (pa, v[:, i]), w[:, y])
                cond = (joint + 4 * smooth * own[None]) / (joint.sum(1, keepdims=True) + 4 * smooth)
                logp[:, y] += np.log(cond[pa, v[:, i]])
        new = np.exp(logp - logp.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        moved = np.abs(new - q).max()
        q = new
        if turn > 30 and moved < 1e-6:
            break
    return q, {"prior": prior.tolist(), "parents": parents}
