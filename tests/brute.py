"""Small in-memory reference for the rank iteration (numpy), used only by tests."""

from __future__ import annotations

import numpy as np


def brute_rank(nodes, edges, seeds=None, d=0.85, max_iter=100, eps=1e-6):
    """Return ``({id: rank}, iterations, converged)`` following the documented update rule."""
    ids = sorted(set(nodes))
    idx = {v: i for i, v in enumerate(ids)}
    n = len(ids)
    src = np.array([idx[s] for s, _ in edges], dtype=int)
    dst = np.array([idx[t] for _, t in edges], dtype=int)
    outdeg = np.bincount(src, minlength=n).astype(float) if len(edges) else np.zeros(n)
    if seeds:
        s = [idx[x] for x in set(seeds) if x in idx]
        tele = np.zeros(n)
        tele[s] = 1.0 / len(s)
    else:
        tele = np.full(n, 1.0 / n)
    r = np.full(n, 1.0 / n)
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        dm = r[outdeg == 0].sum()
        inc = np.zeros(n)
        if len(edges):
            np.add.at(inc, dst, r[src] / outdeg[src])
        new = tele * ((1 - d) + d * dm) + d * inc
        diff = np.abs(new - r).sum()
        r = new
        if diff < eps:
            converged = True
            break
    if max_iter == 0:
        it = 0
    return {v: r[i] for v, i in idx.items()}, it, converged
