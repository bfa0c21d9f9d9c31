"""Problem 5: groups equal those of a plain union-find, whatever the number of edges a task may hold."""

import random

import numpy as np
import pytest

from leadspark.llm.components import components, key_edges, union_find


def brute(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {x: find(x) for x in p}


def edges_of(seed, n=200, m=150):
    r = random.Random(seed)
    return [e for e in [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(300, 400)] if e[0] != e[1]]


@pytest.mark.parametrize("per_task", [1_000_000, 40, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, per_task):
    e = edges_of(seed)
    d = spark.createDataFrame(e + e[:5] + [(b, a) for a, b in e[:9]] + [(4, 4), (None, 3), (3, None)], "a long, b long").repartition(5)
    assert {r.id: r.group_id for r in components(d, edges_per_task=per_task).collect()} == brute(e)


def test_union_find():
    e = edges_of(3)
    ids, root = union_find(np.array([a for a, _ in e]), np.array([b for _, b in e]))
    assert dict(zip(ids.tolist(), root.tolist())) == brute(e)


def test_keys(spark):
    r = random.Random(4)
    rows = [(k, r.choice([None, "hot", f"p{r.randrange(20)}"]), r.choice([None, f"d{r.randrange(30)}", "hot"]), "x") for k in range(300)]
    d = spark.createDataFrame(rows, "id long, p string, q string, a string").repartition(7)
    want = brute([(x[0], y[0]) for n in (1, 2) for i, x in enumerate(rows) for y in rows[:i] if x[n] is not None and x[n] == y[n]])
    assert {x.id: x.group_id for x in components(key_edges(d, "id", ["p", "q"])).collect()} == want


def test_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
