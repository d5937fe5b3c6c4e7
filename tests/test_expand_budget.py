"""Expansion under caps against a plain one-request-at-a-time run on random threads."""

import random

import pytest
from test_forest import c, flatten, more, response

from loomweave.operators import expand as X
from loomweave.operators import forest as FR


class Thread:
    """A random thread: what the first response shows, and what a request for one comment brings."""

    def __init__(self, rng, name, size, reach):
        self.name, self.reach = name, reach
        self.kids = {None: []}
        ids = [None]
        for i in range(size):
            up = rng.choice(ids[-6:])
            ident = f"{name}{i}"
            self.kids[up].append(ident)
            self.kids[ident] = []
            ids.append(ident)
        self.dead = {i for i in ids[1:] if rng.random() < 0.15}

    def below(self, ident):
        return sum(1 + self.below(k) for k in self.kids[ident])

    def shown(self, ident, depth, left):
        """Children lists to ``left`` more levels; a pointer where a list is cut."""
        if not self.kids[ident]:
            return []
        if left == 0:
            return [("more", ident, self.below(ident), depth)]
        few = self.kids[ident][:2] if left == self.reach and ident is not None and len(self.kids[ident]) > 3 else self.kids[ident]
        out = [("t1", k, self.shown(k, depth + 1, left - 1), depth) for k in few]
        hidden = self.kids[ident][len(few):]
        return out + ([("more", ident, sum(1 + self.below(k) for k in hidden), depth)] if hidden else [])

    def depth_of(self, ident):
        up = next((p for p, ks in self.kids.items() if ident in ks), None)
        return 0 if up is None else 1 + self.depth_of(up)

    def base(self):
        return self.shown(None, 0, 2)

    def answer(self, ident):
        d = self.depth_of(ident)
        if ident in self.dead:
            return ("t1", ident, [], d)
        return ("t1", ident, [("t1", k, self.shown(k, d + 2, self.reach - 1), d + 1) for k in self.kids[ident]], d)


def things(items):
    out = []
    for kind, ident, rest, depth in items:
        out.append(more(f"t1_{ident}", rest, depth) if kind == "more" else c(ident, {"kind": "Listing", "data": {"after": None, "children": things(rest)}} if rest else "", depth=depth))
    return out


def count(items):
    return sum(1 + count(x[2]) for x in items if x[0] == "t1")


def plain_run(thread, budget, limit, answered):
    """(preorder of the forest, requests, dead ends, stop) of one request after the other."""
    forest = [list(x) for x in nested(thread.base())]
    dead, made = set(), 1

    def pointers(items):
        for x in items:
            if x[0] == "more":
                yield x
            else:
                yield from pointers(x[2])

    def find(items, ident):
        for x in items:
            if x[0] == "t1":
                if x[1] == ident:
                    return x
                if (hit := find(x[2], ident)):
                    return hit
        return None

    def merge(old, new):
        fresh, changed = [], False
        for x in new:
            known = find(forest, x[1]) if x[0] == "t1" else next((p for p in pointers(forest) if p[1:] == x[1:]), None)
            if known is None:
                fresh.append(x)
            elif x[0] == "t1":
                changed |= merge(known, x[2])
        if fresh:
            at = next((i for i, y in enumerate(old[2]) if y[0] == "more" and y[1] == old[1]), None)
            old[2][at if at is not None else len(old[2]):(at + 1 if at is not None else len(old[2]))] = fresh
        return changed or bool(fresh)

    stop = None
    while stop is None:
        ptr = next((p for p in pointers(forest) if p[1] not in dead), None)
        if ptr is None:
            stop = "tree_complete" if not any(True for _ in pointers(forest)) else "depth_capped"
        elif limit is not None and count(forest) >= limit:
            stop = "comment_limit"
        elif budget is not None and made >= budget:
            stop = "max_requests"
        elif answered is not None and made >= answered:
            stop = "rate_limited"
        else:
            made += 1
            if not merge(find(forest, ptr[1]), nested([thread.answer(ptr[1])])[0][2]):
                dead.add(ptr[1])
            if limit is not None and count(forest) > limit:
                stop = "comment_limit"

    def order(items):
        for x in items:
            yield ("more", f"t1_{x[1]}", x[2]) if x[0] == "more" else ("t1", f"t1_{x[1]}", None)
            if x[0] == "t1":
                yield from order(x[2])
    return list(order(forest)), made, {f"t1_{d}" for d in dead}, stop


def nested(items):
    return [[k, i, nested(r) if k == "t1" else r, d] for k, i, r, d in items]


@pytest.mark.parametrize("reach,budget,limit,answered", [(2, 4, None, None), (1, 5, 9, None), (3, 30, 20, 7)])
def test_equals_one_request_after_the_other(spark, reach, budget, limit, answered):
    rng = random.Random(reach * 100 + (budget or 0))
    threads = [Thread(rng, chr(97 + i), rng.randrange(1, 26), reach) for i in range(9)]
    nodes, drift = flatten(spark, [response(t.name, *things(t.base())) for t in threads])
    assert drift.count() == 0
    bodies = [response(t.name, *things([t.answer(k)])) for t in threads for k in t.kids if k is not None]
    snaps, drift = flatten(spark, bodies, subtree=True)
    assert drift.count() == 0
    own = spark.createDataFrame([(f"t3_{t.name}", answered) for t in threads], "thread_id string, answered int") if answered else None
    merged, done, dead = X.expand(nodes, snaps, max_requests=budget, limit=limit, answered=own)
    got = {}
    for r in FR.preorder(merged, kinds=("t1", "more")).orderBy("thread_id", "display_rank").collect():
        got.setdefault(r["thread_id"], []).append((r["kind"], r["fullname"] or r["ptr_parent_id"], r["ptr_count"]))
    made, ends = {}, {}
    for r in done.collect() + dead.collect():
        made[r["thread_id"]] = made.get(r["thread_id"], 1) + 1
    for r in dead.collect():
        ends.setdefault(r["thread_id"], set()).add(r["root"])
    refused = spark.createDataFrame([(t,) for t in got if answered and made.get(t, 1) >= answered and made.get(t, 1) < (budget or 99)], "thread_id string")
    capped = FR.cap(merged, limit) if limit else None
    stops = {r["thread_id"]: r["verdict"] for r in FR.verdict(merged, capped, limit, dead=dead, refused=refused).collect()}
    for t in threads:
        order, requests, dead_ends, stop = plain_run(t, budget, limit, answered)
        key = f"t3_{t.name}"
        assert got[key] == order, key
        assert made.get(key, 1) == requests and ends.get(key, set()) == dead_ends
        assert stops[key] == stop, key
