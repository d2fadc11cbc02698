import random

import pytest

from clearledger.llm.common import Tables
from clearledger.llm.components import connected_components


def expected(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


CASES = {
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(5, i) for i in range(6, 80)],
    "random": [(random.Random(7 + i).randrange(200), random.Random(99 + i).randrange(200)) for i in range(150)],
    "repeats": [(1, 2), (2, 1), (1, 2), (-3, 2)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = [(a, b) for a, b in CASES[name] if a != b]
    links = spark.createDataFrame([*edges, (9, 9), (None, 1), (3, None)], "a long, b long")
    got = connected_components(Tables(spark, "t"), links).collect()
    assert {r.id: r.component for r in got} == expected(edges)


def test_no_links(spark):
    assert connected_components(Tables(spark, "t"), spark.createDataFrame([], "a long, b long")).collect() == []
