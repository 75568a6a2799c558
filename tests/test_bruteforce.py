"""Rank job against a plain-Python loop on random small graphs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rankgrad.plans.pagerank import pagerank

nodes = st.sampled_from(["a", "b", "c", "d", "e", "f", "Talk:x", ""])
graphs = st.lists(st.tuples(nodes, nodes), min_size=1, max_size=40)


def brute(edges, iterations):
    out = defaultdict(list)
    for s, d in edges:
        out[s].append(d)
    ranks = {s: 1.0 for s in out}
    for _ in range(iterations):
        acc = defaultdict(float)
        for s, r in ranks.items():
            targets = out.get(s, [])
            for d in targets:
                acc[d] += r / len(targets)
        ranks = {d: 0.15 + 0.85 * v for d, v in acc.items()}
    return ranks


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=graphs, iterations=st.integers(min_value=1, max_value=4),
       hot=st.sampled_from([None, 1]))
def test_pagerank_equals_brute_force(spark, edges, iterations, hot):
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.rank for r in
           pagerank(df, iterations, checkpoint_every=2, hot_threshold=hot).collect()}
    want = brute(edges, iterations)
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k]))
