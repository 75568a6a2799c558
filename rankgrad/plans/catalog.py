"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` with an optional DuckDB twin
in ``ORACLE``. Doubles are rounded to 6 places on both sides (sum order
differs between engines); arrays are returned in long form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as Q
from ..functions import clean, features, model
from ..operators import gradients, graph, sample, steps
from ..session import ensure_checkpoint_dir, read_table, scratch_path
from ..sources import steplog, text, vectors
from . import fixtures as fx
from . import train
from .pagerank import pagerank, pagerank_grid, pagerank_numbered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = Q.positive_zero(sql)
        return run
    return deco


def r6(c) -> F.Column:
    return F.round(c if isinstance(c, F.Column) else F.col(c), 6)


def _rounded_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.select("node", r6("rank").alias("rank"))


def _vectors(spark, sf_dir):
    return vectors.read_vectors(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet")


def _positions(df: DataFrame) -> DataFrame:
    return sample.with_positions(df, [sample.hash_order_key("vec_id"), F.col("vec_id")], "pos")


def _long(df: DataFrame, col: str, id_col: str = "vec_id") -> DataFrame:
    return df.select(id_col, F.posexplode(col).alias("j", "v")) \
        .select(id_col, F.col("j").cast("int").alias("j"), r6("v").alias("v"))


# ---- 2.1 sources and sinks --------------------------------------------------

def _edge_file(spark, sf) -> str:
    """The edge lines as text files; the folder's path."""
    path = scratch_path(spark, "edge-lines")
    fx.edge_lines(spark, sf).write.text(path)
    return path


@register("edges_from_text", Q.edges_from_edge_lines_sql())
def edges_from_text_q(spark, sf):
    """Edge-list text files (prefix comments, first two fields), read by path."""
    return text.edges_from_text(spark, _edge_file(spark, sf), "prefix", "first_two")


@register("link_files", f"SELECT value FROM ({Q.LINK_LINES})")
def link_files_q(spark, sf):
    """Lines written to link_a/link_b plus decoys (.link_hidden, other), read back
    through the link-file name filter."""
    lines = fx.link_lines(spark, sf)
    base = scratch_path(spark, "links")
    even = F.col("event_id") % 2 == 0
    lines.filter(even).select("value").write.text(f"{base}/link_a")
    lines.filter(~even).select("value").write.text(f"{base}/link_b")
    lines.select("value").write.text(f"{base}/.link_hidden")
    lines.select("value").write.text(f"{base}/other")
    return text.read_link_files(spark, base)


@register("vector_split",
          "SELECT vec_id, label, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS part "
          "FROM embeddings")
def vector_split_q(spark, sf):
    tr, te = train.split(_vectors(spark, sf))
    return tr.select("vec_id", "label", F.lit("train").alias("part")) \
        .unionByName(te.select("vec_id", "label", F.lit("test").alias("part")))


@register("rank_sink_roundtrip",
          Q.rank_ctes(Q.G_PART, 10) + "\nSELECT CAST(node AS VARCHAR) AS node, "
          "ROUND(rank, 6) AS rank FROM r10")
def rank_sink_roundtrip_q(spark, sf):
    """Ranks written as ('node', rank) text lines and parsed back."""
    path = scratch_path(spark, "ranks-text")
    text.write_ranks(pagerank(fx.g_part(spark, sf), 10), path, fmt="text")
    back = text.read_rank_lines(spark, path)
    return back.select("node", r6("rank").alias("rank"))


@register("rank_sink_single_file",
          Q.rank_ctes(Q.G_PART, 10) + "\nSELECT CAST(node AS VARCHAR) AS node, "
          "ROUND(rank, 6) AS rank, CAST(1 AS BIGINT) AS files FROM r10")
def rank_sink_single_file_q(spark, sf):
    """The same text sink with one output file."""
    path = scratch_path(spark, "ranks-text")
    text.write_ranks(pagerank(fx.g_part(spark, sf), 10), path, fmt="text", single_file=True)
    files = spark.read.text(path).select("_metadata.file_path").agg(F.countDistinct("file_path").alias("files"))
    return text.read_rank_lines(spark, path).select("node", r6("rank").alias("rank")).crossJoin(files)


@register("step_log_roundtrip",
          "SELECT CAST(0 AS INTEGER) AS epoch, CAST(i AS INTEGER) AS iteration, true AS timed FROM "
          "(SELECT unnest(range(1, CAST(ceil(count(*) / 256.0) AS BIGINT) + 1)) AS i FROM embeddings)")
def step_log_roundtrip_q(spark, sf):
    """Step log of one training epoch, written as CSV and read back: its steps, and
    whether each took time."""
    res = train.train_softmax(_vectors(spark, sf), order=train.fixture_order())
    path = scratch_path(spark, "steplog")
    steplog.write_step_log(res.steps, path)
    return steplog.read_step_log(spark, path).select("epoch", "iteration", (F.col("elapsed") > 0).alias("timed"))


_SUMMARY_SQL = (
    "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total, "
    "ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS sd, "
    "ROUND(MIN(value), 6) AS min, ROUND(MAX(value), 6) AS max, "
    "ROUND(ARG_MIN(value, event_id), 6) AS first, ROUND(ARG_MAX(value, event_id), 6) AS last, "
    "ROUND((SUM(value) - ARG_MIN(value, event_id) - ARG_MAX(value, event_id)) / (COUNT(*) - 2), 6) "
    "AS mean_mid, ROUND(QUANTILE_CONT(value, 0.5), 6) AS median FROM events GROUP BY event_type")


@register("step_log_summary", _SUMMARY_SQL)
def step_log_summary_q(spark, sf):
    """Step-log summary statistics, over events: value by event type."""
    ev = read_table(spark, sf, "events")
    s = steps.summarise_steps(ev, value="value", order="event_id", by=["event_type"])
    return s.select("event_type", "n", *[r6(c).alias(c) for c in
                                          ("total", "mean", "sd", "min", "max", "first",
                                           "last", "mean_mid", "median")])


# ---- 2.2 projections, filters, scalar functions ---------------------------

@register("filter_comment_anywhere",
          f"SELECT event_id, value FROM ({Q.LINK_LINES}) WHERE NOT contains(value, '#') "
          "AND value <> ''")
def filter_comment_anywhere_q(spark, sf):
    return clean.drop_comments(fx.link_lines(spark, sf), "anywhere")


@register("filter_comment_prefix",
          f"SELECT event_id, value FROM ({Q.LINK_LINES}) WHERE NOT starts_with(value, '#')")
def filter_comment_prefix_q(spark, sf):
    return clean.drop_comments(fx.link_lines(spark, sf), "prefix")


@register("split_strict",
          "SELECT f[1] AS src, f[2] AS dst FROM (SELECT string_split(value, chr(9)) AS f "
          f"FROM ({Q.EDGE_LINES}) WHERE NOT contains(value, '#') AND value <> '')")
def split_strict_q(spark, sf):
    """Comment-anywhere filter, then strict two-field split (fails on other lines)."""
    return clean.parse_edges(clean.drop_comments(fx.edge_lines(spark, sf), "anywhere"), "strict")


@register("split_first_two", Q.edges_from_edge_lines_sql())
def split_first_two_q(spark, sf):
    """Prefix filter, then the first two fields; a line with one would fail."""
    return clean.parse_edges(clean.drop_comments(fx.edge_lines(spark, sf), "prefix"), "first_two")


@register("filter_two_fields",
          f"SELECT lower(value) AS value FROM ({Q.LINK_LINES}) "
          "WHERE len(string_split(lower(value), chr(9))) = 2")
def filter_two_fields_q(spark, sf):
    low = fx.link_lines(spark, sf).select(F.lower("value").alias("value"))
    return low.filter(clean.field_count_is(2))


@register("wiki_clean", Q.clean_links_sql("Category:"))
def wiki_clean_q(spark, sf):
    return clean.clean_links(fx.link_lines(spark, sf), "faithful")


@register("wiki_clean_intended", Q.clean_links_sql("category:"))
def wiki_clean_intended_q(spark, sf):
    return clean.clean_links(fx.link_lines(spark, sf), "intended")


@register("reverse_edges", f"SELECT dst AS src, src AS dst FROM ({Q.G_PART})")
def reverse_edges_q(spark, sf):
    return graph.reverse_edges(fx.g_part(spark, sf))


@register("initial_ranks",
          f"SELECT DISTINCT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM ({Q.G_PART})")
def initial_ranks_q(spark, sf):
    return graph.initial_ranks(fx.g_part(spark, sf))


def _dbl(values) -> str:
    return ", ".join(f"CAST({v!r} AS DOUBLE)" for v in values)


_NORM_FIXED_SQL = (
    "WITH " + Q.VEC_LONG + "\nSELECT vec_id, CAST(j AS INTEGER) AS j, ROUND((v - "
    f"list_extract([{_dbl(features.CHANNEL_MEAN)}], (j % 3) + 1)) / "
    f"list_extract([{_dbl(features.CHANNEL_STD)}], (j % 3) + 1), 6) AS v "
    "FROM xl")


@register("normalize_fixed", _NORM_FIXED_SQL)
def normalize_fixed_q(spark, sf):
    """Per-channel normalisation with the reference's fixed constants."""
    return _long(features.normalize(_vectors(spark, sf)), "embedding")


@register("normalize_fitted",
          "WITH " + Q.VEC_LONG + ",\nst AS (SELECT j, AVG(v) AS mu, STDDEV_POP(v) AS sd "
          "FROM xl GROUP BY j)\nSELECT x.vec_id, CAST(x.j AS INTEGER) AS j, "
          "ROUND((x.v - st.mu) / st.sd, 6) AS v FROM xl x JOIN st ON x.j = st.j")
def normalize_fitted_q(spark, sf):
    """Element-wise standardisation with mean and deviation fitted on the table."""
    df = _vectors(spark, sf)
    mu, sd = features.fit_normalizer(df)
    return _long(features.normalize(df, mean=mu, std=sd), "embedding")


_CROP_SQL = ("WITH " + ",\n".join((Q.VEC_LONG, *Q.crop_ctes("xl", "cr"))) +
             "\nSELECT vec_id, CAST(j AS INTEGER) AS j, ROUND(v, 6) AS v FROM cr")
_FLIP_SQL = ("WITH " + ",\n".join((Q.VEC_LONG, Q.flip_cte("xl", "fl"))) +
             "\nSELECT vec_id, CAST(j AS INTEGER) AS j, ROUND(v, 6) AS v FROM fl")


@register("augment_crop", _CROP_SQL)
def augment_crop_q(spark, sf):
    """Repeatable random crop of the 8x8 grid view (pad 4, epoch 0)."""
    return _long(features.random_crop(_vectors(spark, sf), epoch=0), "embedding")


@register("augment_flip", _FLIP_SQL)
def augment_flip_q(spark, sf):
    """Repeatable random horizontal flip (epoch 0)."""
    return _long(features.random_flip(_vectors(spark, sf), epoch=0), "embedding")


def _centroid_scores(spark, sf) -> DataFrame:
    df = _vectors(spark, sf)
    p = model.fit_centroids(df)
    return model.scores(df, p)


@register("linear_scores",
          "WITH " + Q.scores_ctes() + "\nSELECT vec_id, CAST(k AS INTEGER) AS k, ROUND(z, 6) AS z "
          "FROM sc")
def linear_scores_q(spark, sf):
    """Linear-layer scores with class-mean parameters fitted on the table."""
    s = _centroid_scores(spark, sf)
    return s.select("vec_id", F.posexplode("scores").alias("k", "z")) \
        .select("vec_id", F.col("k").cast("int").alias("k"), r6("z").alias("z"))


@register("cross_entropy",
          "WITH " + Q.scores_ctes() + "\nSELECT vec_id, label, ROUND(loss, 6) AS loss FROM ce")
def cross_entropy_q(spark, sf):
    s = model.with_loss(_centroid_scores(spark, sf))
    return s.select("vec_id", "label", r6("loss").alias("loss"))


@register("argmax_predict",
          "WITH " + Q.scores_ctes() + "\nSELECT vec_id, label, CAST(pred AS INTEGER) AS pred, "
          "CAST(pred = label AS INTEGER) AS hit FROM ce")
def argmax_predict_q(spark, sf):
    s = model.with_prediction(_centroid_scores(spark, sf))
    return s.select("vec_id", "label", "pred", (F.col("pred") == F.col("label")).cast("int")
                    .alias("hit"))


@register("loss_trace_sampled",
          "SELECT step, event_type, value FROM (SELECT row_number() OVER (ORDER BY ts, event_id) "
          "- 1 AS step, event_type, value FROM events) WHERE step % 20 = 0")
def loss_trace_sampled_q(spark, sf):
    """Every 20th step of a step table (events in time order as steps)."""
    ev = read_table(spark, sf, "events").select("ts", "event_id", "event_type", "value")
    st = sample.with_positions(ev, [F.col("ts"), F.col("event_id")], "step")
    return sample.every_nth(st, "step", 20).select("step", "event_type", "value")


# ---- 2.3 / 2.4 joins and aggregations -----------------------------------------

def _weighted(spark, sf, g=fx.g_part, **kw) -> graph.WeightedGraph:
    # one pass over the layout: nothing to persist (and nothing left cached)
    return graph.weight_edges(g(spark, sf), storage_level=None, **kw)


@register("contributions",
          f"WITH e AS ({Q.G_PART}), d AS (SELECT src, COUNT(*) AS deg FROM e GROUP BY src)\n"
          "SELECT e.src, e.dst, ROUND(SUM(CAST(1.0 AS DOUBLE) / d.deg), 6) AS contribution FROM e "
          "JOIN d ON e.src = d.src GROUP BY e.src, e.dst")
def contributions_q(spark, sf):
    """Per-pair contributions of the initial ranks (inner join on the node key)."""
    g = _weighted(spark, sf)
    r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    return graph.contributions(g, r0).select("src", "dst", r6("contribution").alias("contribution"))


@register("adjacency",
          f"WITH e AS ({Q.G_PART}), d AS (SELECT src, COUNT(*) AS out_degree FROM e GROUP BY src)\n"
          "SELECT e.src, e.dst, COUNT(*) AS m, MAX(d.out_degree) AS out_degree FROM e JOIN d "
          "ON e.src = d.src GROUP BY e.src, e.dst")
def adjacency_q(spark, sf):
    """Adjacency in flat form, with multiplicities."""
    return graph.adjacency(_weighted(spark, sf))


@register("out_degree",
          f"SELECT src, COUNT(*) AS out_degree FROM ({Q.G_PART}) GROUP BY src")
def out_degree_q(spark, sf):
    return graph.out_degree(fx.g_part(spark, sf))


@register("contributions_from_adjacency",
          Q.rank_ctes(Q.G_USER, 1) + "\nSELECT e.src, e.dst, ROUND(SUM(r.rank / d.deg), 6) "
          "AS contribution FROM e JOIN d ON e.src = d.src JOIN r1 r ON e.src = r.node "
          "GROUP BY e.src, e.dst")
def contributions_from_adjacency_q(spark, sf):
    """Fan-out from adjacency lists, with the ranks after one iteration."""
    g = _weighted(spark, sf, fx.g_user)
    r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    r1 = graph.rank_step(g, r0)
    c = graph.contributions_from_adjacency(graph.adjacency_lists(g, max_targets=100), r1)
    return c.select("src", "dst", r6("contribution").alias("contribution"))


@register("rank_one_iteration", Q.pagerank_sql(Q.G_PART, 1))
def rank_one_iteration_q(spark, sf):
    g = _weighted(spark, sf)
    r0 = g.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    return _rounded_ranks(graph.rank_step(g, r0))


def _grad_sql(how: str) -> str:
    agg = "AVG(g)" if how == "gather" else "SUM(g / 4)"
    return (
        "WITH " + Q.layout_sql(4, 1 << 30) + ",\n" + Q.scores_ctes() + ",\n"
        "x1 AS (SELECT vec_id, j, v FROM xl UNION ALL SELECT vec_id, len(embedding) AS j, "
        "CAST(1.0 AS DOUBLE) AS v FROM embeddings),\n"
        "se AS (SELECT s.vec_id, SUM(EXP(s.z - m.m)) AS t FROM sc s JOIN mx m "
        "ON s.vec_id = m.vec_id GROUP BY s.vec_id),\n"
        "dz AS (SELECT s.vec_id, s.k, EXP(s.z - m.m) / se.t - CASE WHEN s.k = s.label THEN 1.0 "
        "ELSE 0.0 END AS dz FROM sc s JOIN mx m ON s.vec_id = m.vec_id JOIN se "
        "ON se.vec_id = s.vec_id),\n"
        "n AS (SELECT shard, COUNT(*) AS n FROM lay GROUP BY shard),\n"
        "gs AS (SELECT l.shard, dz.k, x1.j, SUM(dz.dz * x1.v) / MAX(n.n) AS g FROM lay l "
        "JOIN dz ON dz.vec_id = l.vec_id JOIN x1 ON x1.vec_id = l.vec_id JOIN n "
        "ON n.shard = l.shard GROUP BY l.shard, dz.k, x1.j)\n"
        f"SELECT CAST(k AS INTEGER) AS k, CAST(j AS INTEGER) AS j, ROUND({agg}, 6) AS g "
        "FROM gs GROUP BY k, j")


def _shard_grads(spark, sf) -> DataFrame:
    df = _vectors(spark, sf)
    p = model.fit_centroids(df)
    laid = sample.assign_shards(_positions(df.select("vec_id", "label", "embedding")), 4)
    return gradients.shard_gradients(laid.withColumn("x", features.as_double("embedding")),
                                     p, feat="x")


@register("grad_gather_mean", _grad_sql("gather"))
def grad_gather_mean_q(spark, sf):
    """Shard mean gradients (4 shards, class-mean parameters) averaged at one place."""
    g = gradients.mean_gradients(_shard_grads(spark, sf), "gather")
    return g.select("k", "j", r6("g").alias("g"))


@register("grad_allreduce", _grad_sql("allreduce"))
def grad_allreduce_q(spark, sf):
    """Same gradients, averaged the all-reduce way (divide, then sum)."""
    g = gradients.mean_gradients(_shard_grads(spark, sf), "allreduce", n_shards=4)
    return g.select("k", "j", r6("g").alias("g"))


@register("pagerank_topk",
          Q.rank_ctes(Q.G_PART, 10) + "\nSELECT node, ROUND(rank, 6) AS rank FROM r10 "
          "ORDER BY ROUND(rank, 6) DESC, node LIMIT 10")
def pagerank_topk_q(spark, sf):
    """The ten highest ranks (a top-k report)."""
    return graph.top_ranks(_rounded_ranks(pagerank(fx.g_part(spark, sf), 10)), 10)


_EVAL_SQL = (
    "WITH " + Q.scores_ctes("vec_id % 5 <> 0", "x.vec_id % 5 = 0") + ",\n"
    "b AS (SELECT loss, pred = label AS hit, (row_number() OVER (ORDER BY vec_id) - 1) // 256 "
    "AS batch FROM ce),\n"
    "bm AS (SELECT batch, AVG(loss) AS l, SUM(CAST(hit AS BIGINT)) AS c, COUNT(*) AS n "
    "FROM b GROUP BY batch)\n"
    "SELECT ROUND(AVG(l), 6) AS test_loss, CAST(SUM(c) AS BIGINT) AS correct, "
    "CAST(SUM(n) AS BIGINT) AS total, "
    "ROUND(100.0 * CAST(SUM(c) AS DOUBLE) / CAST(SUM(n) AS DOUBLE), 6) AS accuracy FROM bm")


@register("evaluate", _EVAL_SQL)
def evaluate_q(spark, sf):
    """Test loss (mean of batch means) and accuracy of class-mean parameters
    fitted on the training part."""
    tr, te = train.split(_vectors(spark, sf))
    ev = train.evaluate(te, model.fit_centroids(tr), batch_size=256)
    return ev.select(r6("test_loss").alias("test_loss"), "correct", "total",
                     r6("accuracy").alias("accuracy"))


# ---- 2.5 / 2.6 union, splits, shards, batches ---------------------------------

@register("union_link_sources",
          f"SELECT value FROM ({Q.LINK_LINES}) UNION ALL SELECT value FROM ({Q.EDGE_LINES}) "
          "UNION ALL SELECT src || chr(9) || dst AS value FROM (" + Q.G_PAGE + ")")
def union_link_sources_q(spark, sf):
    """n-ary bag union of three line sources."""
    pages = fx.g_page(spark, sf).select(F.concat_ws("\t", "src", "dst").alias("value"))
    return clean.union_sources(fx.link_lines(spark, sf).select("value"),
                               fx.edge_lines(spark, sf), pages)


_LI_ORDER = "(l_orderkey * 7919 + l_linenumber) % 10007, l_orderkey, l_linenumber"


@register("balanced_split_ordered",
          "WITH o AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY "
          f"{_LI_ORDER}) - 1 AS p FROM lineitem)\n"
          "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN p < 30 * ((SELECT COUNT(*) FROM o) // 30) "
          "THEN p // ((SELECT COUNT(*) FROM o) // 30) ELSE p - 30 * ((SELECT COUNT(*) FROM o) // 30) "
          "END AS INTEGER) AS slice FROM o")
def balanced_split_ordered_q(spark, sf):
    """Equal-size split of line items into 30 slices, repeatable order."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    key = (F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 10007
    return sample.balanced_split(li, 30, [key, F.col("l_orderkey"), F.col("l_linenumber")])


@register("balanced_random_split",
          f"WITH n AS (SELECT COUNT(*) AS n FROM ({Q.clean_links_sql('Category:')}))\n"
          "SELECT CAST(i AS INTEGER) AS slice, n // 30 + CASE WHEN i < n % 30 THEN 1 ELSE 0 END AS rows "
          "FROM n, range(30) t(i) WHERE n // 30 > 0 OR i < n % 30")
def balanced_random_split_q(spark, sf):
    """Equal-size split of the cleaned link pairs into 30 slices, seeded order:
    the rows of each slice."""
    e = clean.clean_links(fx.link_lines(spark, sf))
    return sample.random_split(e, 30).groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))


@register("shard_assign",
          "WITH " + Q.layout_sql(4, 64) + "\nSELECT vec_id, pos, shard FROM lay")
def shard_assign_q(spark, sf):
    laid = sample.assign_shards(_positions(_vectors(spark, sf).select("vec_id")), 4)
    return laid.select("vec_id", "pos", "shard")


@register("shard_assign_padded",
          "WITH " + Q.layout_sql(3, 64) + "\nSELECT vec_id, pos, shard FROM lay")
def shard_assign_padded_q(spark, sf):
    """Three shards: the first rows repeat at the end so all shards are equal."""
    laid = sample.assign_shards(_positions(_vectors(spark, sf).select("vec_id")), 3)
    return laid.select("vec_id", "pos", "shard")


@register("minibatch_assign",
          "WITH " + Q.layout_sql(4, 64) + "\nSELECT vec_id, pos, shard, batch_id FROM lay")
def minibatch_assign_q(spark, sf):
    """Four shards, 64 rows per shard batch."""
    laid = sample.assign_shards(_positions(_vectors(spark, sf).select("vec_id")), 4)
    return sample.assign_batches(laid, 64).select("vec_id", "pos", "shard", "batch_id")


# ---- 2.7 iterative jobs --------------------------------------------------------

@register("pagerank_edges", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_edges_q(spark, sf):
    """Flagship: 10 iterations over the part -> supplier graph."""
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10))


@register("pagerank_nation", Q.pagerank_sql(Q.G_NATION, 10))
def pagerank_nation_q(spark, sf):
    return _rounded_ranks(pagerank(fx.g_nation(spark, sf), 10))


@register("pagerank_user", Q.pagerank_sql(Q.G_USER, 10))
def pagerank_user_q(spark, sf):
    return _rounded_ranks(pagerank(fx.g_user(spark, sf), 10))


@register("pagerank_page", Q.pagerank_sql(Q.G_PAGE, 10))
def pagerank_page_q(spark, sf):
    """Acyclic graph: the rank table is empty from iteration 2 on."""
    return _rounded_ranks(pagerank(fx.g_page(spark, sf), 10))


_WIKI_EDGES = Q.clean_links_sql("Category:")


@register("pagerank_wiki_3", Q.pagerank_sql(_WIKI_EDGES, 3))
def pagerank_wiki_3_q(spark, sf):
    return _rounded_ranks(pagerank(clean.clean_links(fx.link_lines(spark, sf)), 3))


@register("pagerank_wiki_10", Q.pagerank_sql(_WIKI_EDGES, 10))
def pagerank_wiki_10_q(spark, sf):
    return _rounded_ranks(pagerank(clean.clean_links(fx.link_lines(spark, sf)), 10))


@register("pagerank_wiki_numbered", Q.pagerank_sql(_WIKI_EDGES, 10))
def pagerank_wiki_numbered_q(spark, sf):
    """Links job on node numbers: titles leave before the loop and come back after it."""
    return _rounded_ranks(pagerank_numbered(clean.clean_links(fx.link_lines(spark, sf)), 10))


@register("pagerank_grid", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_grid_q(spark, sf):
    """Edges in 4 x 4 cells: partial sums meet within a cell before they are shuffled."""
    return _rounded_ranks(pagerank_grid(fx.g_part(spark, sf), 10))


@register("pagerank_wiki_grid", Q.pagerank_sql(_WIKI_EDGES, 10))
def pagerank_wiki_grid_q(spark, sf):
    """Links job in cells so small that most are cut further."""
    return _rounded_ranks(pagerank_grid(clean.clean_links(fx.link_lines(spark, sf)), 10, blocks=2, max_cell=50))


@register("pagerank_page_1", Q.pagerank_sql(Q.G_PAGE, 1))
def pagerank_page_1_q(spark, sf):
    """The acyclic graph after one iteration, before its ranks are gone."""
    return _rounded_ranks(pagerank(fx.g_page(spark, sf), 1))


@register("pagerank_text", Q.pagerank_sql(Q.edges_from_edge_lines_sql(), 10))
def pagerank_text_q(spark, sf):
    """Rank job from edge-list text files (string node keys), read by path."""
    return _rounded_ranks(pagerank(text.edges_from_text(spark, _edge_file(spark, sf)), 10))


@register("pagerank_wiki_partitioned_disk", Q.pagerank_sql(_WIKI_EDGES, 10))
def pagerank_wiki_partitioned_disk_q(spark, sf):
    """Links job with edges and ranks in 30 parts and the edges on disk."""
    return _rounded_ranks(pagerank(clean.clean_links(fx.link_lines(spark, sf)), 10, partitions=30,
                                   storage_level=StorageLevel.DISK_ONLY))


@register("pagerank_partitioned", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_partitioned_q(spark, sf):
    """Edges hash-partitioned into 30 parts."""
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, partitions=30))


@register("pagerank_disk", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_disk_q(spark, sf):
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, storage_level=StorageLevel.DISK_ONLY))


@register("pagerank_memory", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_memory_q(spark, sf):
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10,
                                   storage_level=StorageLevel.MEMORY_ONLY))


@register("pagerank_hot_split", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_hot_split_q(spark, sf):
    """Skew path forced: sources above a low threshold are split over salts."""
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, hot_threshold=25))


@register("pagerank_skewed", Q.pagerank_sql(Q.G_SKEW, 10))
def pagerank_skewed_q(spark, sf):
    """One source owns ~3/7 of the edges: above the default threshold its edges
    are split over several parts."""
    return _rounded_ranks(pagerank(fx.g_skew(spark, sf), 10))


@register("pagerank_resumed", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_resumed_q(spark, sf):
    """6 iterations saved every 3, then a new run resumes from the last save to 10."""
    save = scratch_path(spark, "ranks-saves")
    pagerank(fx.g_part(spark, sf), 6, checkpoint_every=3, save_dir=save)
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, checkpoint_every=3,
                                   save_dir=save, resume_from=save))


@register("pagerank_bucketed", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_bucketed_q(spark, sf):
    """Edge layout written as a table bucketed by source in the shared folder."""
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, edge_store="table"))


@register("pagerank_resumed_stored", Q.pagerank_sql(Q.G_PART, 10))
def pagerank_resumed_stored_q(spark, sf):
    """Resume that reopens the stored edge layout instead of rebuilding it."""
    save = scratch_path(spark, "ranks-saves")
    pagerank(fx.g_part(spark, sf), 6, checkpoint_every=3, save_dir=save, edge_store="table")
    return _rounded_ranks(pagerank(fx.g_part(spark, sf), 10, checkpoint_every=3,
                                   save_dir=save, resume_from=save, edge_store="table"))


def _params_long(spark, p: model.Params) -> DataFrame:
    return p.long_form(spark).select("k", "j", r6("w").alias("w"))


@register("sgd_single", Q.sgd_sql(2, 1, 256))
def sgd_single_q(spark, sf):
    """One epoch, one shard, batches of 256; final parameters."""
    res = train.train_softmax(_vectors(spark, sf), shards=1, batch_size=256,
                              order=train.fixture_order())
    return _params_long(spark, res.params)


@register("sgd_sharded", Q.sgd_sql(2, 4, 64))
def sgd_sharded_q(spark, sf):
    """One epoch, four shards of 64 rows per step, all-reduce mean."""
    res = train.train_softmax(_vectors(spark, sf), shards=4, batch_size=64,
                              order=train.fixture_order())
    return _params_long(spark, res.params)


@register("train_and_evaluate",
          Q.train_eval_sql(2, 1, 256, "vec_id % 5 <> 0", "vec_id % 5 = 0", 256))
def train_and_evaluate_q(spark, sf):
    """Train one epoch on the training part, evaluate on the test part.

    The SQL twin unrolls two steps: the 400 training rows of the 500-row
    fixture tables make two batches of 256."""
    _, ev = train.train_and_evaluate(_vectors(spark, sf), order=train.fixture_order())
    return ev.select(r6("test_loss").alias("test_loss"), "correct", "total",
                     r6("accuracy").alias("accuracy"))


@register("train_and_evaluate_transformed",
          Q.train_eval_sql(2, 1, 256, "vec_id % 5 <> 0", "vec_id % 5 = 0", 256,
                           extra=Q.transform_ctes(features.CHANNEL_MEAN, features.CHANNEL_STD),
                           train_feat="tr", test_feat="te"))
def train_and_evaluate_transformed_q(spark, sf):
    """The reference's data pipeline: crop + flip + normalise for training,
    normalise for testing; one epoch, then evaluation."""
    _, ev = train.train_and_evaluate(_vectors(spark, sf), order=train.fixture_order(),
                                     transforms=True)
    return ev.select(r6("test_loss").alias("test_loss"), "correct", "total",
                     r6("accuracy").alias("accuracy"))


# ---- 2.8 layout ------------------------------------------------------------------

@register("partition_profile",
          f"SELECT COUNT(*) AS rows, COUNT(DISTINCT src) AS keys, CAST(0 AS BIGINT) AS torn_keys, true AS as_dealt FROM ({Q.G_PART})")
def partition_profile_q(spark, sf):
    """The edges hash-partitioned by source into 30: all rows, keys, keys in several
    parts, and whether the profile's parts are those of a real repartition."""
    e = fx.g_part(spark, sf)
    profile = graph.partition_profile(e, 30, "src")
    dealt = e.repartition(30, "src").groupBy(F.spark_partition_id().alias("part"), "src").agg(F.count(F.lit(1)).alias("n"))
    real = dealt.groupBy("part").agg(F.sum("n").alias("n"))
    keys = dealt.groupBy("src").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n")).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"), F.count(F.when(F.col("parts") > 1, 1)).alias("torn_keys"))
    same = profile.join(real, "part", "full").agg(F.bool_and(F.col("rows").eqNullSafe(F.col("n"))).alias("as_dealt"))
    return keys.crossJoin(same)  # one row each
