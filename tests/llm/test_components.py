"""Components of links against union-find."""

import random

import pytest

from vistaframe.llm.components import components


def brute(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


def rand(seed, n, m):
    r = random.Random(seed)
    return [(r.randrange(n), r.randrange(n)) for _ in range(m)]


CASES = {
    "none": [],
    "loops": [(3, 3), (4, 4)],
    "star": [(i, 0) for i in range(1, 300)],
    "star_of_largest": [(i, 999) for i in range(300)],
    "chain": [(i, i + 1) for i in range(60)],
    "backwards": [(60 - i, 59 - i) for i in range(60)],
    "shared_leaf": [(5, 1), (5, 2), (9, 7)],
    "leaf_and_centre": [(5, 3), (3, 1)],
    "repeated": [(2, 1), (1, 2), (2, 1), (4, 2)],
    "negative": [(-5, 3), (3, 8), (-7, 8)],
    "sparse": rand(1, 200, 120),
    "dense": rand(2, 40, 200),
}


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    links = CASES[case]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == brute(links)
