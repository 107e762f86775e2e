"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import math


def points_frame(spark, rows):
    return spark.createDataFrame([([float(v) for v in x], g) for x, g in rows], "features array<double>, grp string")


def sq(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(x, centers):
    best, index = math.inf, -1
    for i, c in enumerate(centers):
        if sq(x, c) < best:
            best, index = sq(x, c), i
    return index, best


def mean(points):
    return [sum(v) / len(points) for v in zip(*points)]


def fair_round(rows, centers):
    """One fair Lloyd round over [(point, group)]; returns centers, gamma, fa, fb, x."""
    k = len(centers)
    side = {"A": [[] for _ in range(k)], "B": [[] for _ in range(k)]}
    for x, g in rows:
        for name in side:
            if g.endswith(name):
                side[name][nearest(x, centers)[0]].append(x)
    total = {name: sum(map(len, parts)) for name, parts in side.items()}
    ma, mb, alpha, beta, ell = [], [], [], [], []
    for i in range(k):
        a, b = side["A"][i], side["B"][i]
        ca = mean(a) if a else mean(b) if b else list(centers[i])
        cb = mean(b) if b else ca
        ma.append(ca), mb.append(cb)
        alpha.append(len(a) / total["A"]), beta.append(len(b) / total["B"])
        ell.append(math.sqrt(sq(ca, cb)))
    fixed_a = sum(sq(x, ma[i]) for i in range(k) for x in side["A"][i]) / total["A"]
    fixed_b = sum(sq(x, mb[i]) for i in range(k) for x in side["B"][i]) / total["B"]
    weights = [0.5]
    for t in range(10):
        gamma = weights[-1]
        xs = []
        for i in range(k):
            both = gamma * alpha[i] + (1 - gamma) * beta[i]
            xs.append((1 - gamma) * beta[i] * ell[i] / both if both else 0.0)
        fa = fixed_a + sum(alpha[i] * xs[i] ** 2 for i in range(k))
        fb = fixed_b + sum(beta[i] * (ell[i] - xs[i]) ** 2 for i in range(k))
        if fa == fb:
            break
        weights.append(gamma + (1 if fa > fb else -1) * 0.25 / 2**t)
    moved = []
    for i in range(k):
        if ell[i] > 0:
            moved.append([((ell[i] - xs[i]) * p + xs[i] * q) / ell[i] for p, q in zip(ma[i], mb[i])])
        else:
            moved.append(ma[i])
    return moved, gamma, fa, fb, xs


def sketch_tables(items, h):
    cm, cs = {}, {}
    for x in items:
        for r in range(h.depth):
            c = (h.a[r] * x + h.b[r]) % h.p % h.width
            s = -1 if (h.sign_a[r] * x + h.sign_b[r]) % h.p % 2 == 0 else 1
            cm[r, c] = cm.get((r, c), 0) + 1
            cs[r, c] = cs.get((r, c), 0) + s
    return cm, cs


def estimates(x, tables, h):
    cm, cs = tables
    cells = [(r, (h.a[r] * x + h.b[r]) % h.p % h.width) for r in range(h.depth)]
    signs = [-1 if (h.sign_a[r] * x + h.sign_b[r]) % h.p % 2 == 0 else 1 for r in range(h.depth)]
    vals = sorted(s * cs.get(c, 0) for s, c in zip(signs, cells))
    mid = len(vals) // 2
    median = vals[mid] if len(vals) % 2 else math.floor((vals[mid - 1] + vals[mid]) / 2 + 0.5)
    return min(cm.get(c, 0) for c in cells), median
