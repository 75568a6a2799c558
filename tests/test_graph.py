"""Rank-job properties (a)-(c), (g) and the layout / skew paths."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from conftest import SF01
from rankgrad.operators import graph
from rankgrad.plans import fixtures as fx
from rankgrad.plans.pagerank import completed_saves, pagerank, pagerank_graph
from rankgrad.session import scratch_path


def as_dict(df):
    return {r.node: r.rank for r in df.collect()}


def close(a, b, tol=1e-9):
    return a.keys() == b.keys() and all(abs(a[k] - b[k]) <= tol * max(1, abs(a[k])) for k in a)


@pytest.fixture(scope="module")
def part_ranks(spark):
    return as_dict(pagerank(fx.g_part(spark, SF01), 10))


def test_rank_sum_closed_form(spark, part_ranks):
    # every supplier receives, parts never do: m = 100 keys, S0 = 2000 sources
    assert len(part_ranks) == 100
    expected = 100 + (2000 - 100) * 0.85 ** 10
    assert abs(sum(part_ranks.values()) - expected) < 1e-6


def test_key_set_is_walk_ends(spark):
    # even parts only: dangling targets keep a rank but pass nothing on
    e = fx.g_part(spark, SF01).filter(F.col("src") % 2 == 0)
    pairs = [(r.src, r.dst) for r in e.collect()]
    ends = {s for s, _ in pairs}
    for k in range(1, 4):
        ends = {d for s, d in pairs if s in ends}
        r = pagerank(e, k)
        assert {row.node for row in r.collect()} == ends
        assert r.columns == ["node", "rank"]


def test_acyclic_graph_empties_with_schema(spark):
    r = pagerank(fx.g_page(spark, SF01), 3)
    assert r.count() == 0
    assert [f.dataType.simpleString() for f in r.schema.fields] == ["string", "double"]


@pytest.mark.parametrize("kw", [
    {"partitions": 30},
    {"storage_level": StorageLevel.DISK_ONLY},
    {"storage_level": StorageLevel.MEMORY_ONLY},
    {"storage_level": None, "checkpoint_every": None},
    {"hot_threshold": 20},
    {"checkpoint_every": 1},
    {"edge_store": "table"},
])
def test_layout_variants_agree(spark, part_ranks, kw):
    assert close(as_dict(pagerank(fx.g_part(spark, SF01), 10, **kw)), part_ranks)


def test_resume_reopens_stored_edges(spark, part_ranks):
    save = scratch_path(spark, "test-saves")
    e = fx.g_part(spark, SF01)
    pagerank(e, 6, save_dir=save, edge_store="table")
    resumed = pagerank(e, 10, save_dir=save, resume_from=save, edge_store="table")
    assert close(as_dict(resumed), part_ranks)
    for other in (e.limit(0), e.union(e.limit(1)), graph.reverse_edges(e)):
        with pytest.raises(ValueError, match="its edges"):
            pagerank(other, 10, save_dir=save, resume_from=save, edge_store="table")
    with pytest.raises(ValueError, match="stored layout"):
        pagerank(e, 10, resume_from=save, partitions=5, edge_store="table")


def test_saves_of_another_run_are_refused(spark):
    save = scratch_path(spark, "test-saves")
    a = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("c", "a"), ("c", "b")], "src string, dst string")
    b = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    pagerank(a, 10, save_dir=save)
    with pytest.raises(ValueError, match="another run"):
        pagerank(b, 4, save_dir=save)
    with pytest.raises(ValueError, match="its edges"):
        pagerank(b, 10, save_dir=save, resume_from=save)
    for changed in ({"damping": 0.5}, {"base": 0.2}):
        with pytest.raises(ValueError, match="cannot resume"):
            pagerank(a, 12, save_dir=save, resume_from=save, **changed)
    with pytest.raises(ValueError, match="no run record"):
        pagerank(a, 4, resume_from=scratch_path(spark, "none"))
    fresh = scratch_path(spark, "test-saves")
    pagerank(b, 4, save_dir=fresh)
    assert as_dict(pagerank(b, 10, save_dir=fresh, resume_from=fresh)) == pytest.approx({"a": 1.0, "b": 1.0})


def test_saves_follow_the_cadence_with_hot_sources(spark):
    e = fx.g_part(spark, SF01)
    for cadence, want in ((None, [6]), (2, [2, 4, 6])):
        for threshold in (None, 20):
            save = scratch_path(spark, "test-saves")
            pagerank(e, 6, save_dir=save, checkpoint_every=cadence, hot_threshold=threshold)
            assert completed_saves(spark, save) == want


def test_null_keys_are_rejected(spark):
    for rows in ([("a", None)], [(None, "a")]):
        with pytest.raises(Exception, match="null node key"):
            pagerank(spark.createDataFrame([("a", "b"), *rows], "src string, dst string"), 1)


@pytest.mark.parametrize("threshold", [None, 20])
def test_part_count_holds_without_broadcast(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    g = graph.weight_edges(fx.g_part(spark, SF01), parts=30, hot_threshold=threshold)
    try:
        assert g.laid.rdd.getNumPartitions() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        g.unpersist()


def test_scratch_holds_only_live_state(spark):
    from rankgrad.session import ensure_checkpoint_dir, release
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders():
        return {s.getPath().getName() for s in fs.listStatus(root) }

    before, tables = folders(), {t.name for t in spark.catalog.listTables()}
    out = pagerank(fx.g_part(spark, SF01), 7, checkpoint_every=2, edge_store="table")
    assert out.count() == 100
    kept = folders() - before
    assert len(kept) == 1 and kept.pop().startswith("live-ranks-")  # the result itself, until it is freed
    assert release(out) == 1
    assert folders() == before and {t.name for t in spark.catalog.listTables()} == tables


def test_cluster_without_a_shared_folder_is_refused():
    from rankgrad.session import one_process
    assert all(map(one_process, ("local", "local[4]", "local[*]", "local[2,3]")))
    assert not any(map(one_process, ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", "k8s://x")))


def test_resume_equals_straight_run(spark, part_ranks):
    save = scratch_path(spark, "test-saves")
    pagerank(fx.g_part(spark, SF01), 6, checkpoint_every=3, save_dir=save)
    assert completed_saves(spark, save) == [3, 6]
    resumed = pagerank(fx.g_part(spark, SF01), 10, checkpoint_every=3, save_dir=save,
                       resume_from=save)
    assert close(as_dict(resumed), part_ranks)


def test_reverse_twice_is_identity(spark):
    e = fx.g_nation(spark, SF01)
    back = graph.reverse_edges(graph.reverse_edges(e))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, e.collect()))


def test_hot_sources_split_and_adjacency_parts(spark):
    g = graph.weight_edges(fx.g_user(spark, SF01), hot_threshold=50)
    try:
        assert g.hot_keys.count > 0 and g.keys == ["src", "salt"]
        plain = graph.weight_edges(fx.g_user(spark, SF01))
        assert plain.keys == ["src"]
        assert close(as_dict(pagerank_graph(g, 5)), as_dict(pagerank_graph(plain, 5)))
        flat = sorted(map(tuple, graph.adjacency(g).collect()))
        assert flat == sorted(map(tuple, graph.adjacency(plain).collect()))
        lists = graph.adjacency_lists(g, max_targets=10)
        assert lists.agg(F.max("part")).first()[0] > 0
        # parts of one source together hold its whole out-degree
        per_src = lists.select("src", "out_degree", F.aggregate(
            "targets", F.lit(0).cast("long"), lambda a, t: a + t.m).alias("s")) \
            .groupBy("src", "out_degree").agg(F.sum("s").alias("s"))
        assert per_src.filter(F.col("s") != F.col("out_degree")).count() == 0
        r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
        a = graph.contributions_from_adjacency(lists, r0).groupBy("dst").agg(F.sum("contribution"))
        b = graph.contributions(g, r0).groupBy("dst").agg(F.sum("contribution"))
        assert close({r[0]: r[1] for r in a.collect()}, {r[0]: r[1] for r in b.collect()})
        plain.unpersist()
    finally:
        g.unpersist()


def _kids(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _name(node):
    return node.getClass().getSimpleName()


def _reaches_scan_without_exchange(node):
    name = _name(node)
    if name in ("InMemoryTableScanExec", "FileSourceScanExec"):
        return True
    if "Exchange" in name:
        return False
    return any(_reaches_scan_without_exchange(k) for k in _kids(node))


def _joins(node):
    out = [node] if _name(node) in ("SortMergeJoinExec", "ShuffledHashJoinExec") else []
    for k in _kids(node):
        out += _joins(k)
    return out


@pytest.mark.parametrize("store", [False, True])
def test_loop_does_not_shuffle_edges(spark, store):
    # the plan used at scale: no side small enough to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    g = graph.weight_edges(fx.g_part(spark, SF01),
                           store_dir=scratch_path(spark, "edges") if store else None)
    try:
        r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
        r2 = graph.rank_step(g, graph.rank_step(g, r0))
        plan = r2._jdf.queryExecution().executedPlan().inputPlan()
        joins = _joins(plan)
        assert len(joins) == 2  # one per iteration
        for j in joins:
            # the persisted edges feed every join without a new Exchange
            assert _reaches_scan_without_exchange(j.left()), j.toString()
        assert close(as_dict(r2), as_dict(pagerank_graph(g, 2)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        g.unpersist()


def test_top_ranks(spark, part_ranks):
    top = graph.top_ranks(pagerank(fx.g_part(spark, SF01), 10), 3).collect()
    want = sorted(part_ranks.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [r.node for r in top] == [k for k, _ in want]


def test_partition_profile(spark):
    prof = graph.partition_profile(fx.g_part(spark, SF01), 30, "src").collect()
    assert sum(r.rows for r in prof) == 60000
    assert len(prof) <= 30


def test_default_threshold_splits_the_hot_source(spark):
    g = graph.weight_edges(fx.g_skew(spark, SF01))
    try:
        assert g.hot_keys.count == 1
        assert [(r.src, r.salts > 1) for r in g.hot_keys.frame.collect()] == [(0, True)]
        assert g.laid.filter("src = 0").select("salt").distinct().count() == g.hot_keys.frame.first().salts
        # no source or salt holds more than about the threshold
        sizes = [r["count"] for r in g.laid.groupBy("src", "salt").count().collect()]
        assert max(sizes) < 1.2 * g.hot_keys.threshold
    finally:
        g.unpersist()


def test_forced_hot_set_above_the_bound_is_not_broadcast(spark, part_ranks):
    from rankgrad.operators import skew
    stats = graph.source_stats(graph.edge_multiplicity(fx.g_part(spark, SF01)))
    ok = skew.find_hot_keys(stats, "src", "n_targets", 8, threshold=1, max_broadcast_rows=5000)
    assert ok.count == 2000 and ok.small
    big = skew.find_hot_keys(stats, "src", "n_targets", 8, threshold=1, max_broadcast_rows=100)
    assert big.count == 2000 and not big.small
    default = skew.find_hot_keys(stats, "src", "n_targets", 8)
    assert default.count == 0 and default.threshold >= 10_000
    g = graph.weight_edges(fx.g_part(spark, SF01), hot_threshold=20)
    g.hot_keys.small = False
    assert close(as_dict(pagerank_graph(g, 10)), part_ranks)
    g.unpersist()


def test_lineage_cut_keeps_ranks_co_partitioned(spark):
    from rankgrad.plans.pagerank import Cuts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    g = graph.weight_edges(fx.g_part(spark, SF01))
    cuts = Cuts(spark, g.parts)
    try:
        r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
        r1 = cuts.cut(graph.rank_step(g, r0))
        r2 = graph.rank_step(g, r1)
        joins = _joins(r2._jdf.queryExecution().executedPlan().inputPlan())
        assert len(joins) == 1
        # edges and the cut ranks both reach the join without an Exchange
        assert _reaches_scan_without_exchange(joins[0].left())
        assert _reaches_scan_without_exchange(joins[0].right())
        assert close(as_dict(r2), as_dict(pagerank_graph(g, 2)))
    finally:
        cuts.close()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        g.unpersist()
