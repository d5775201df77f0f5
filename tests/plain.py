"""Sequential NumPy versions, for checking only."""

import numpy as np


def distances(x, metric="euclidean"):
    if metric == "cosine":
        length = np.linalg.norm(x, axis=1)
        unit = x / np.where(length == 0, 1, length)[:, None]
        d = 0.5 * ((unit[:, None] - unit[None]) ** 2).sum(-1)
        d[length == 0, :] = 1
        d[:, length == 0] = 1
    else:
        gap = x[:, None] - x[None]
        d = np.abs(gap).sum(-1) if metric == "manhattan" else np.sqrt((gap**2).sum(-1))
    np.fill_diagonal(d, 0)
    return d


def dbscan(d, eps, min_samples):
    near = d <= eps
    core = near.sum(1) >= min_samples
    label, n = np.full(len(d), -1), 0
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], n
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core & (label < 0)):
                label[j] = n
                stack.append(j)
        n += 1
    out = label.copy()
    for i in np.flatnonzero(~core):
        found = label[near[i] & core]
        out[i] = found.min() if len(found) else -1
    return out


def linkage(d, method):
    n = len(d)
    d = d.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, node, alive, out = [1] * n, list(range(n)), list(range(n)), []
    for t in range(n - 1):
        part = d[np.ix_(alive, alive)]
        i, j = (alive[k] for k in np.unravel_index(part.argmin(), part.shape))
        i, j = min(i, j), max(i, j)
        h = d[i, j]
        out.append((min(node[i], node[j]), max(node[i], node[j]), h, size[i] + size[j]))
        for k in alive:
            if k in (i, j):
                continue
            a, b, m = d[i, k], d[j, k], size[k]
            if method == "single":
                v = min(a, b)
            elif method == "complete":
                v = max(a, b)
            elif method == "average":
                v = (size[i] * a + size[j] * b) / (size[i] + size[j])
            else:
                total = size[i] + size[j] + m
                v = np.sqrt(((size[i] + m) * a * a + (size[j] + m) * b * b - m * h * h) / total)
            d[i, k] = d[k, i] = v
        size[i] += size[j]
        node[i] = n + t
        alive.remove(j)
    return out


def silhouette(d, label):
    out = np.zeros(len(d))
    for i in range(len(d)):
        own = label == label[i]
        if own.sum() == 1:
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        out[i] = (b - a) / max(a, b)
    return out
