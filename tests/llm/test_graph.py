"""Connected components against union-find."""

from __future__ import annotations

import random

import pytest

from gridpull.llm.graph import connected_components

from . import brute


@pytest.mark.parametrize("kind", ["random", "chain", "star", "none", "loops"])
def test_components(spark, kind):
    rnd = random.Random(4)
    ids = rnd.sample(range(-500, 500), 200)
    edges = {
        "random": [(rnd.choice(ids), rnd.choice(ids)) for _ in range(120)],
        "chain": list(zip(ids, ids[1:])),
        "star": [(ids[7], x) for x in ids] + [(5000, 5001), (5001, 5000)],
        "none": [],
        "loops": [(ids[0], ids[0]), (ids[1], ids[2]), (ids[2], ids[1]), (ids[1], ids[2])],
    }[kind]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == brute.components(nodes, edges if not nodes else [e for e in edges if e[0] != e[1]])
