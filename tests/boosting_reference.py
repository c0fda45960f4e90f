"""A plain single-process version of second-order boosting, with loops over rows' sets, to compare with."""

import hashlib
import math

import numpy as np

UNIT = 1 << 24


def edges_of(values, bins):
    """The largest value of each bin, by walking over the sorted values."""
    ordered = sorted(values)
    if len(set(ordered)) <= bins:
        return sorted(set(ordered))
    top = {}
    for place, value in enumerate(ordered, 1):
        if place == len(ordered) or ordered[place] != value:
            top[(place - 1) * bins // len(ordered)] = value
    return sorted(top.values())


def average_precision(labels, scores):
    total = sum(labels)
    area, hits, seen = 0.0, 0, 0
    for score in sorted(set(scores), reverse=True):
        here = [y for y, s in zip(labels, scores) if s == score]
        hits, seen = hits + sum(here), seen + len(here)
        area += hits / seen * sum(here)
    return area / total if total else 0.0


def boost(x, y, *, rounds, leaves, rate, least_rows, l2, bins, columns, seed, least_hessian=1e-3, held_out=None, patience=30):
    """(start, trees); a tree is a list of (node, feature, cut, gain, value, rows) with None where it does not apply."""
    n, n_features = x.shape
    positives = int(y.sum())
    weight = np.where(y == 1, max((n - positives) / positives, 1.0), 1.0)
    start = math.log(positives / (n - positives))
    edges = [edges_of(x[:, f].tolist(), bins) for f in range(n_features)]
    margin = np.full(n, start)
    outside = None if held_out is None else np.full(len(held_out[1]), start)
    trees, precision = [], []

    def strength(rows):
        gs, hs = int(g[rows].sum()) / UNIT, int(h[rows].sum()) / UNIT
        return gs * gs / (hs + l2)

    def split_of(rows, allowed):
        best = None
        whole = strength(rows)
        for f in allowed:
            for k, cut in enumerate(edges[f][:-1]):
                inside = x[rows, f] <= cut
                left, right = rows[inside], rows[~inside]
                if min(len(left), len(right)) < least_rows or min(h[left].sum(), h[right].sum()) < least_hessian * UNIT:
                    continue
                gain = strength(left) + strength(right) - whole
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, k)
        return best

    def values(data, tree):
        out = []
        for row in data:
            at = 1
            while tree[at][1] is not None:
                at = 2 * at + (row[tree[at][1]] > tree[at][2])
            out.append(tree[at][4])
        return np.array(out)

    while len(trees) < rounds:
        t = len(trees) + 1
        chance = 1 / (1 + np.exp(-margin))
        g = np.rint(weight * (chance - y) * UNIT).astype(np.int64)
        h = np.rint(weight * chance * (1 - chance) * UNIT).astype(np.int64)
        digests = sorted(range(n_features), key=lambda f: hashlib.sha256(f"{seed}:{t}:{f}".encode()).digest())
        allowed = sorted(digests[: max(1, round(columns * n_features))])
        ends = {1: np.arange(n)}
        best = {1: split_of(ends[1], allowed)}
        tree = {}
        while len(ends) < leaves:
            open_ends = [k for k in ends if best[k]]
            if not open_ends:
                break
            k = min(open_ends, key=lambda k: (-best[k][0], k))
            gain, f, place = best[k]
            rows = ends.pop(k)
            tree[k] = (k, f, edges[f][place], gain, None, len(rows))
            inside = x[rows, f] <= edges[f][place]
            for child, own in ((2 * k, rows[inside]), (2 * k + 1, rows[~inside])):
                ends[child], best[child] = own, split_of(own, allowed)
        if not tree:
            break
        for k, rows in ends.items():
            value = -rate * (int(g[rows].sum()) / UNIT) / (int(h[rows].sum()) / UNIT + l2)
            tree[k] = (k, None, None, None, value, len(rows))
        trees.append([tree[k] for k in sorted(tree)])
        margin = margin + values(x, tree)
        if outside is not None:
            outside = outside + values(held_out[0], tree)
            precision.append(average_precision(held_out[1].tolist(), outside.tolist()))
            top = precision.index(max(precision))
            if len(precision) - 1 - top >= patience:
                break
    if precision:
        trees = trees[: precision.index(max(precision)) + 1]
    return start, trees
