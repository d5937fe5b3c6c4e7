"""Comparison of two snapshots against plain dictionaries."""

import random

from loomweave.operators import snapshots as SN

SCHEMA = "thread_id string, path array<int>, kind string, fullname string, parent_fullname string, ptr_count long, text string"


def rows_of(trees):
    """``trees``: thread -> list of (node, text, children); a node starting with ``+`` is a pointer."""
    out = []

    def walk(thread, parent, kids, path):
        for i, (node, text, below) in enumerate(kids):
            here = [*path, i]
            more = node.startswith("+")
            out.append((thread, here, "more" if more else "t1", None if more else node, parent, int(text) if more else None, None if more else text))
            walk(thread, node, below, here)

    for t, kids in trees.items():
        walk(t, t, kids, [])
    return out


def plain(old, new):
    def index(rows):
        named = {}
        for t, path, kind, full, parent, count, text in rows:
            node = full if kind == "t1" else "more:" + parent
            inside = sorted((tuple(p[len(path):]), f, q if p != path else None, c, x) for u, p, k, f, q, c, x in rows
                            if u == t and p[:len(path)] == path)
            named[t, node] = (len(path) - 1, parent, path[-1], (count, text), str(inside), len(inside))
        return named

    a, b = index(old), index(new)
    out = set()
    for key in a.keys() | b.keys():
        x, y = a.get(key), b.get(key)
        change = ("added" if x is None else "removed" if y is None else "moved" if x[1:3] != y[1:3] else
                  "edited" if x[3] != y[3] else "below" if x[4] != y[4] else None)
        if change:
            out.add((*key, (y or x)[0], change, x and x[5], y and y[5]))
    return out


def diff(spark, old, new):
    got = SN.snapshot_diff(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["text"]).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def grow(rng, n, name):
    kids = []
    stack = [kids]
    for i in range(n):
        node = (f"{name}{i}", rng.choice(["a", "b", ""]), [])
        rng.choice(stack[-6:]).append(node)
        stack.append(node[2])
    if n:
        rng.choice(stack).append((f"+{name}", "4", []))
    return kids


def change(rng, kids, name):
    out = []
    for node, text, below in kids:
        roll = rng.random()
        if roll < 0.05:
            continue
        below = change(rng, below, name)
        if roll < 0.25 and not node.startswith("+"):
            text = text + "!"
        if roll > 0.95:
            below = [*below, (f"{node}n", "new", [])]
        out.append((node, text, below))
    if len(out) > 1 and rng.random() < 0.1:
        out.reverse()
    return out


def test_random_trees(spark):
    rng = random.Random(11)
    old = {f"t{i}": grow(rng, rng.choice([0, 1, 5, 60]), f"n{i}_") for i in range(14)}
    new = {t: change(rng, kids, t) if i % 3 else kids for i, (t, kids) in enumerate(old.items())}
    del new["t7"]
    new["only"] = grow(rng, 4, "o")
    a, b = rows_of(old), rows_of(new)
    want = plain(a, b)
    assert {c for _, _, _, c, _, _ in want} == {"added", "removed", "moved", "edited", "below"}
    assert diff(spark, a, b) == want


def test_equal_empty_and_deep(spark):
    chain = []
    for i in range(300):
        chain = [(f"c{i}", "x", chain)]
    a = rows_of({"t": chain})
    assert diff(spark, a, a) == set() and diff(spark, [], []) == set()
    assert {r[3] for r in diff(spark, [], a)} == {"added"}
    b = [(*r[:6], "y" if r[3] == "c0" else r[6]) for r in a]
    got = diff(spark, a, b)
    assert [r[1] for r in got if r[3] == "edited"] == ["c0"] and len([r for r in got if r[3] == "below"]) == 299
