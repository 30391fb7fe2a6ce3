import random

import pytest

from barpanel.llm.components import components
from tests.llm.helpers import least_reachable


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == least_reachable(nodes, edges)


def test_loops_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "a long, b long")
    assert components(df, "a", "b").count() == 0
