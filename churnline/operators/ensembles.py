"""Boosted trees as arrays: scores after any number of trees, and Shapley values in one walk per tree."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


TABLE_NODES = 10  # inner nodes of a tree whose patterns are tabled: 1,024 patterns

# Nodes of one tree, the root first, as arrays by name: feature, threshold, left, right (-1 below a
# leaf), cover, and value, what a leaf adds to the log-odds. A plain dict, so that it can be broadcast.
Tree = dict[str, np.ndarray]


def trees_of(nodes: pd.DataFrame) -> list[Tree]:
    """The trees of a node table, in fitting order. Log-odds are twice the ensemble's margin."""
    found = []
    for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
        place = pd.Series(np.arange(len(tree)), index=tree["node"])
        child = lambda side: place.reindex(tree[side]).fillna(-1).to_numpy().astype(np.int32)
        same = {c: tree[c].to_numpy() for c in ("feature", "threshold", "cover")}
        value = (2.0 * tree["weight"] * tree["prediction"]).to_numpy()
        found.append({**same, "left": child("left"), "right": child("right"), "value": value})
    return found


def answers(x: np.ndarray, tree: Tree) -> np.ndarray:
    """Which inner nodes of a tabled tree send each row of ``x`` (features x rows) left, one bit per node."""
    pattern = np.zeros(x.shape[1], dtype=np.int16)
    for bit, node in enumerate(tree["inner"]):
        answer = (x[int(tree["feature"][node])] <= tree["threshold"][node]).astype(np.int16)
        answer <<= bit
        pattern |= answer
    return pattern.astype(np.intp)


def tree_values(x: np.ndarray, tree: Tree) -> np.ndarray:
    """What the tree adds to the log-odds of each row of ``x`` (features x rows)."""
    if "table" in tree:
        return tree["said"].take(answers(x, tree))
    below = lambda node, rows: x[tree["feature"][node], rows] <= tree["threshold"][node]
    return _values(below, x.shape[1], tree)


def _values(below: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int, tree: Tree) -> np.ndarray:
    rows = np.arange(n)
    at = np.zeros(n, dtype=np.int32)
    while len(open_rows := rows[tree["left"][at] >= 0]):
        node = at[open_rows]
        at[open_rows] = np.where(below(node, open_rows), tree["left"][node], tree["right"][node])
    return tree["value"][at]


def prefix_scores(x: np.ndarray, trees: list[Tree], counts: list[int]) -> np.ndarray:
    """Probabilities (counts x rows) after the first ``counts`` trees, in one pass over all trees."""
    log_odds, out = np.zeros(x.shape[1]), {}
    for n, tree in enumerate(trees, start=1):
        log_odds += tree_values(x, tree)
        if n in counts:
            out[n] = 1 / (1 + np.exp(-log_odds))
    return np.array([out[n] for n in counts])


def _shares_by_pattern(share: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Shapley values (features x rows) of a product over features.

    A known feature's factor is 1 or 0 (``inside``), an unknown one's its cover share. The
    Shapley value is the integral over t of the others' mixed product (the multilinear
    extension); the integrand is a polynomial, so Gauss points make it exact.
    """
    points, weights = np.polynomial.legendre.leggauss((len(share) + 1) // 2)
    base = share[:, None]
    gap = inside - base
    out = np.zeros(gap.shape)
    for t, w in zip((points + 1) / 2, weights / 2):
        mixed = base + t * gap  # never 0: shares are over 0 and t under 1
        out += w * gap * (mixed.prod(axis=0) / mixed)
    return out


def _walk(below: Callable[[int], np.ndarray], n: int, tree: Tree, out: np.ndarray) -> None:
    """Add the Shapley values of one tree for ``n`` rows to ``out``; ``below`` says which rows a node sends left.

    A path carries one bit per row and feature on it: whether the row is still inside. At a leaf a
    row's value depends on its bits only, so values are worked out once per pattern of bits and
    looked up by the rows.
    """
    open_paths = [(0, np.zeros(n, dtype=np.int64), [], [])]
    while open_paths:
        node, bits, names, share = open_paths.pop()
        if tree["left"][node] < 0:
            if names:
                few = 1 << len(names) <= len(bits)
                patterns = np.arange(1 << len(names)) if few else bits
                inside = patterns >> np.arange(len(names))[:, None] & 1
                worth = tree["value"][node] * _shares_by_pattern(np.array(share), inside)
                out[names] += worth[:, bits] if few else worth
            continue
        feature, left = int(tree["feature"][node]), below(node)
        place = names.index(feature) if feature in names else len(names)
        for child, stays in ((tree["left"][node], left), (tree["right"][node], ~left)):
            ratio = tree["cover"][child] / tree["cover"][node]
            if place == len(names):
                open_paths.append((child, bits | stays.astype(np.int64) << place, [*names, feature], [*share, ratio]))
            else:
                narrowed = [s * ratio if i == place else s for i, s in enumerate(share)]
                open_paths.append((child, np.where(stays, bits, bits & ~(1 << place)), names, narrowed))


def tabled(trees: list[Tree]) -> list[Tree]:
    """The trees with their value and Shapley values per pattern of answers at their inner nodes, where these are few.

    A row's values depend on its answers only. Patterns that no row can have stay unused.
    """
    found = []
    for tree in trees:
        inner = np.flatnonzero(tree["left"] >= 0)
        if 0 < len(inner) <= TABLE_NODES:
            patterns = np.arange(1 << len(inner))
            place = {int(node): i for i, node in enumerate(inner)}
            names = np.unique(tree["feature"][inner]).astype(int)
            table = np.zeros((names[-1] + 1, len(patterns)))
            _walk(lambda node: (patterns >> place[int(node)] & 1).astype(bool), len(patterns), tree, table)  # noqa: B023
            bit = np.zeros(len(tree["left"]), dtype=int)
            bit[inner] = np.arange(len(inner))
            said = _values(lambda node, rows: (rows >> bit[node] & 1).astype(bool), len(patterns), tree)  # noqa: B023
            tree = {**tree, "inner": inner, "names": names, "table": table[names], "said": said}
        found.append(tree)
    return found


def shapley_values(x: np.ndarray, trees: list[Tree]) -> np.ndarray:
    """Path-dependent Shapley values (features x rows) of the summed trees in log-odds.

    Each tree is walked once, or looked up by the rows' answers if it is ``tabled``.
    """
    out = np.zeros(x.shape)
    for tree in trees:
        if "table" not in tree:
            _walk(lambda node: x[int(tree["feature"][node])] <= tree["threshold"][node], x.shape[1], tree, out)  # noqa: B023
            continue
        at = answers(x, tree)
        for name, values in zip(tree["names"], tree["table"]):
            out[name] += values.take(at)
    return out


def expected_value(trees: list[Tree]) -> float:
    """Mean log-odds over the training rows' covers."""
    total = 0.0
    for tree in trees:
        leaves = tree["left"] < 0
        total += float((tree["value"][leaves] * tree["cover"][leaves]).sum() / tree["cover"][0])
    return total
