"""Hard negatives against brute force, their bounds, and odd vectors."""

import random
from collections import defaultdict
from math import floor, isfinite

import numpy as np
import pytest

from burgage.llm import hardneg

ROWS = "vec_id long, label int, embedding array<double>, id string, v string, block int"


def plain(rows, anchor_ids, positives=5, negatives=5):
    """(anchor, positive, rank, negative, positive score, negative score) of rows with distinct ids."""
    good = [(i, x, [floor(256 * c) for c in v]) for i, x, v, *_ in rows
            if i is not None and x is not None and v is not None and all(
                c is not None and isfinite(c) for c in v)]
    out = set()
    for a, label, v in good:
        if a not in anchor_ids:
            continue
        scores = [(-sum(p * q for p, q in zip(v, w)), i, x) for i, x, w in good if i != a and len(v) == len(w)]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:positives]:
            inside = sorted((t, n) for t, n, x in scores if x != label and 80 * -s <= 100 * -t <= 100 * -s)
            out |= {(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(inside[:negatives])}
    return out


def got(rows, anchors, **more):
    return {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
            for r in hardneg.mine(rows, anchors, **more).collect()}


def vectors(rng, n, d, centres=4):
    mid = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(centres)]
    return [(i, rng.randrange(3), [c + rng.gauss(0, 0.1) for c in rng.choice(mid)], "x", None, 1) for i in range(n)]


@pytest.mark.parametrize("block", [hardneg.ANCHOR_VALUES, 60])
def test_equals_brute_force(frame, monkeypatch, block):
    """In one block of anchors and in several."""
    monkeypatch.setattr(hardneg, "ANCHOR_VALUES", block)
    rng = random.Random(3)
    rows = vectors(rng, 400, 8) + [(1000 + i, i % 3, [0.25 * (i % 2)] * 8, None, "y", 2) for i in range(30)]
    rows += [(2000 + i, i % 2, [rng.gauss(0, 1) for _ in range(5)], None, None, 3) for i in range(60)]
    table = frame(rows, ROWS)
    assert got(table, table.where("vec_id % 25 = 0")) == plain(rows, {i for i, *_ in rows if i % 25 == 0})


def test_bounds_save_scores():
    """Of clustered vectors most pairs are never scored in the second pass."""
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 256, (6, 16))
    v = np.floor(np.repeat(centre, 60, 0) + rng.normal(0, 4, (360, 16)))
    labels = np.repeat(np.arange(6), 60) % 3
    anchors = hardneg.Anchors(np.arange(0, 360, 6), labels[::6], v[::6])
    windows = np.array([(i, *hardneg._window(int((v[6 * i] ** 2).sum()))) for i in range(60)])
    state = hardneg.OtherLabels(anchors, windows, 5)
    state.meet(np.arange(360), labels, v)
    assert anchors.scored < 0.5 * anchors.pairs


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(40, 3))
    levels = hardneg.spanning_tree(v)
    edges = [(int(c), int(p), float(e)) for x in levels for c, p, e in zip(*x)]
    assert sorted(c for c, *_ in edges) == list(range(1, 40))
    assert all(np.isclose(e, np.linalg.norm(v[c] - v[p])) for c, p, e in edges)
    every = sorted((float(np.linalg.norm(v[i] - v[j])), i, j) for i in range(40) for j in range(i))
    up, total = list(range(40)), 0.0
    for d, i, j in every:
        a, b = up[i], up[j]
        if a != b:
            up, total = [a if x == b else x for x in up], total + d
    assert np.isclose(sum(e for *_, e in edges), total)
    assert hardneg.spanning_tree(v[:1]) == []


def test_very_large_components(frame):
    rows = [(i, i % 2, [x, -x, 1.0], None, None, 0) for i, x in enumerate([1e6, 2e9, 3e14, 1e150, 5e307, 0.5, 7.0, 1e6])]
    table = frame(rows, ROWS)
    # Beyond 2^53 whole numbers are used; beyond a long scores are its largest.
    few = [r for r in rows if abs(r[2][0]) < 1e7]
    only = frame(few, ROWS)
    assert got(only, only) == plain(few, {i for i, *_ in rows})
    most = 2**63 - 1
    for a, p, _, n, ps, ns in got(table, table):
        exact = {i: v for i, _, v, *_ in rows}
        want = [max(-most - 1, min(most, sum(floor(min(256 * x, 1e308)) * floor(min(256 * y, 1e308)) for x, y in zip(exact[a], exact[b]))))
                for b in (p, n)] if max(abs(exact[i][0]) for i in (a, p, n)) < 1e100 else [ps, ns]
        assert [ps, ns] == want and 80 * ps <= 100 * ns <= 100 * ps


def test_products_are_exact():
    a = np.array([[2.0**40 + 1, 3.0], [1.0, 2.0]])
    want = [[(2**40 + 1) ** 2 + 9, 2**40 + 7], [2**40 + 7, 5]]
    assert hardneg.products(a, a).tolist() == [[min(2**63 - 1, x) for x in r] for r in want]
    assert hardneg.products(a[1:], a[1:]).tolist() == [[5]]


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None, None)], [(0, 1, [], "", "", 0), (1, 2, [], "", "", 0), (2, 1, [], "", "", 0)],
    [(0, 1, [float("nan")], "", "", 0), (1, 1, [None], "", "", 0), (2, 1, [float("inf")], "", "", 0), (3, None, [1.0], "", "", 0)],
    [(0, 1, [0.0, 0.0], "", "", 0), (1, 1, [0.0, 0.0], "", "", 0), (2, 2, [0.0, 0.0], "", "", 0), (None, 2, [0.0, 0.0], "", "", 0)],
])
def test_odd_rows(frame, rows):
    table = frame(rows, ROWS)
    assert got(table, table) == plain(rows, {i for i, *_ in rows})


def test_repeated_rows(frame):
    """An id among the anchors twice stands for its smallest row; repeated rows are as many partners."""
    rows = [(0, 1, [1.0], "", "", 0)] * 2 + [(1, 1, [1.0], "", "", 0), (2, 2, [0.9], "", "", 0), (2, 2, [0.9], "", "", 0)]
    table = frame(rows, ROWS)
    found = hardneg.mine(table, table.where("vec_id = 0")).collect()
    ranks = defaultdict(list)
    for r in found:
        ranks[r.positive_id].append((r["rank"], r.negative_id))
    assert {k: sorted(v) for k, v in ranks.items()} == {1: [(1, 2), (2, 2)]}
