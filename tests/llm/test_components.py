import random

import pytest

pytest.importorskip("lakevec.llm")
from lakevec.llm import components  # noqa: E402


@pytest.mark.parametrize(("hub", "local"), [(3, 0), (1000, 0), (3, 60), (1000, 1000)])
def test_components_against_union_find(spark, monkeypatch, hub, local):
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(140)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(600, 640)] + [(700, 700)]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in parent}


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
