import random

import pytest

from tallyloom.operators.graph import build_levels, mutual_groups

from conftest import rows

SCHEMA = "src string, dst string"


def reach(edges):
    out = {}
    for s in {x for e in edges for x in e}:
        seen, todo = set(), [s]
        while todo:
            for a, b in edges:
                if a == todo[-1] and b not in seen:
                    break
            else:
                todo.pop()
                continue
            seen.add(b)
            todo.append(b)
        out[s] = seen
    return out


def brute_groups(edges):
    r = reach(edges)
    return sorted(((n, max({m for m in r[n] if n in r[m]} | {n})) for n in r if n in r[n]), key=repr)


def brute_levels(edges):
    r, out = reach([e for e in edges if e[0] != e[1]]), {}
    nodes = {x for e in edges for x in e}
    stuck = {n for n in nodes if n in r.get(n, ())}
    stuck |= {n for n in nodes if r.get(n, set()) & stuck}
    while len(out) < len(nodes - stuck):
        for n in nodes - stuck:
            below = [b for a, b in edges if a == n and b != n]
            if n not in out and all(b in out for b in below):
                out[n] = 1 + max([out[b] for b in below], default=-1)
    return sorted([*out.items(), *((n, None) for n in stuck)], key=repr)


CASES = {
    "none": [],
    "loop": [("a", "a"), ("b", "a")],
    "diamond": [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("d", "a"), ("d", "a")],
    "two circles and a bridge": [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "d"), ("f", "a"), ("e", "g")],
    "eight": [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "c"), ("x", "x")],
    "chain": [(f"n{k:02d}", f"n{k + 1:02d}") for k in range(12)],
}
for seed in range(3):
    r = random.Random(seed)
    CASES[f"random {seed}"] = [(f"t{r.randrange(14)}", f"t{r.randrange(14)}") for _ in range(18 + 3 * seed)]


@pytest.mark.parametrize("name", sorted(CASES))
def test_levels_and_groups(spark, name):
    edges = spark.createDataFrame(CASES[name] + [(None, "a")], SCHEMA)
    assert rows(build_levels(edges), "node", "level") == brute_levels(CASES[name])
    assert rows(mutual_groups(edges), "node", "group") == brute_groups(CASES[name])


def test_levels_leave_no_join_behind(spark):
    """Every level is written: a union of unwritten ones would run the joins of all levels in one task."""
    deep = spark.createDataFrame(CASES["chain"] + CASES["eight"], SCHEMA)
    plan = build_levels(deep)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "Join" not in plan
