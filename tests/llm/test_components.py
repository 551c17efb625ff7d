import random

import pytest

from seqloom.llm import components as module


def roots(edges):
    """Plain reachability."""
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo += near[node]
    return {k: r for k, r in out.items() if near[k] != {k}}


CASES = {
    "chain": [(i, i + 1) for i in range(300)],
    "star": [(0, i) for i in range(1, 200)] + [(i, 0) for i in range(150, 200)],
    "hub with the greatest id": [(10_000, i) for i in range(100)],
    "repeats and loops": [(3, 1), (1, 3), (3, 1), (5, 5), (2**62, -(2**62)), (7, 3)],
    "two": [(1, 2), (3, 4)],
    "random": [(random.Random(i).randrange(400), random.Random(-i - 1).randrange(400)) for i in range(300)],
}


@pytest.mark.parametrize("held", [3, 500_000])
@pytest.mark.parametrize("name", CASES)
def test_components(spark, monkeypatch, name, held):
    monkeypatch.setattr(module, "contracted", lambda edges, f=module.contracted: f(edges, held))
    edges = list(CASES[name])
    random.Random(1).shuffle(edges)
    rows = module.components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()
    assert len(rows) == len({r.node for r in rows})  # each node once
    assert {r.node: r.root for r in rows} == roots(edges)


def test_no_edges(spark):
    assert module.components(spark.createDataFrame([], "u long, v long")).count() == 0
