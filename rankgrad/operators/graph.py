"""Graph operators: single steps of the rank job as DataFrame plans.

Edges are flat rows ``(src, dst)``; node keys keep the type they arrive
with (strings from text, integers from tables). Duplicate edges count with
their multiplicity and self-loops stay. Multiplicity is folded once into a
weight ``w = m / out_degree(src)`` so that the loop reads one row per
distinct pair instead of one per raw edge.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path
from .skew import HotKeys, every_salt, find_hot_keys, salt_of

# fixed values of the rank formula (rank = BASE + DAMPING * sum of contributions)
BASE = 0.15
DAMPING = 0.85


def reverse_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Swap source and target: the reversed graph."""
    return edges.select(F.col(dst).alias(src), F.col(src).alias(dst))


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, out_degree)``: edge count per source, duplicates included."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def edge_multiplicity(edges: DataFrame) -> DataFrame:
    """``(src, dst, m)``: one row per distinct pair, ``m`` = number of copies.

    A partial aggregate runs before the shuffle, so a pair repeated a
    billion times costs one row per map task.
    """
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))


def source_stats(pairs: DataFrame) -> DataFrame:
    """``(src, out_degree, n_targets)`` from folded pairs."""
    return pairs.groupBy("src").agg(
        F.sum("m").alias("out_degree"), F.count(F.lit(1)).alias("n_targets"))


def initial_ranks(edges: DataFrame) -> DataFrame:
    """Rank 1.0 for every node that has an out-edge (and only those)."""
    return edges.select(F.col("src").alias("node")).distinct() \
        .withColumn("rank", F.lit(1.0))


def checked_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst)``; a null key fails the job instead of losing its edges."""
    def known(c):
        return F.when(F.col(c).isNotNull(), F.col(c)) \
            .otherwise(F.raise_error(F.lit(f"null node key in {c}"))).alias(c)
    return edges.select(known("src"), known("dst"))


@dataclass
class WeightedGraph:
    """Weighted edges laid out for the rank loop.

    ``laid``: ``(src, dst, m, w)``, hash-partitioned by ``src`` into ``parts``
    (the same layout the per-iteration ``groupBy(dst)`` gives the ranks, so
    the join needs no shuffle of the edges). If sources have more targets
    than the threshold, it also has ``salt`` and is partitioned by
    ``(src, salt)``: a hot source's edges lie in several parts, and its rank
    is sent to each. ``sources``: ``(src, out_degree, n_targets)``.
    """

    laid: DataFrame
    hot_keys: HotKeys
    sources: DataFrame
    parts: int
    persisted: list = field(default_factory=list)
    tables: list = field(default_factory=list)  # catalog names of a stored layout
    folder: str | None = None  # scratch folder that goes with the graph
    exact: bool = False  # ``parts`` holds for the ranks too, whatever the session's setting is when the plan runs

    @property
    def keys(self) -> list[str]:
        return ["src", "salt"] if self.hot_keys.count else ["src"]

    def edges(self) -> DataFrame:
        """All weighted edges ``(src, dst, w)``."""
        return self.laid.select("src", "dst", "w")

    def spread(self, by_source: DataFrame) -> DataFrame:
        """Rows with one ``src`` each, repeated for every salt of hot sources."""
        if not self.hot_keys.count:
            return by_source
        return by_source.join(self.hot_keys.table(), "src", "left") \
            .withColumn("salt", every_salt()).drop("salts")

    def dealt(self, rows: DataFrame, *keys: str) -> DataFrame:
        """``rows`` in the graph's parts by ``keys``, as an exchange of the plan, if the graph is ``exact``."""
        return rows.repartition(self.parts, *keys) if self.exact else rows

    def unpersist(self) -> None:
        for df in self.persisted:
            df.unpersist()
        self.persisted.clear()
        if self.hot_keys.frame is not None:
            self.hot_keys.frame.unpersist()
        spark = self.laid.sparkSession
        for name in self.tables:
            # external tables: the catalog entry goes, the files stay
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()
        if self.folder:
            drop_path(spark, self.folder)
            self.folder = None


def weight_edges(edges: DataFrame, parts: int | None = None,
                 storage_level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
                 hot_threshold: int | None = None, store_dir: str | None = None,
                 folded: bool = False) -> WeightedGraph:
    """Fold multiplicity into weights and lay the edges out for the loop.

    ``folded``: the edges are one row per pair already, with their number in ``m``.

    Both sides of the weight join are dealt into ``parts`` explicitly, so the
    part count holds whether the planner broadcasts a side or sorts and
    merges. With ``storage_level=None`` nothing is persisted (each use
    recomputes); otherwise the weighted edges are persisted at that level and
    materialised here, once. With ``store_dir`` (a folder under the shared
    checkpoint folder) the layout is written there instead, bucketed by its
    keys into ``parts``: reading it back keeps the co-partitioning, a lost
    executor costs a file re-read instead of a recomputed fold, and a later
    run can reopen it with ``open_weighted``.
    """
    spark = edges.sparkSession
    if parts is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = edges.select("src", "dst", "m") if folded else edge_multiplicity(checked_edges(edges))
    sources = source_stats(pairs)
    if storage_level is not None:
        pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
        # filled by the hot-key job below, then reused by the joins and the loop
        sources = source_stats(pairs).persist(StorageLevel.MEMORY_AND_DISK)
    hot = find_hot_keys(sources, "src", "n_targets", parts, threshold=hot_threshold)
    graph = WeightedGraph(pairs, hot, sources, parts)
    dealt = pairs
    if hot.count:
        dealt = pairs.join(hot.table(), "src", "left").withColumn("salt", salt_of("dst")).drop("salts")
    degrees = graph.spread(sources.select("src", "out_degree"))
    laid = dealt.repartition(parts, *graph.keys) \
        .join(degrees.repartition(parts, *graph.keys), graph.keys) \
        .select(*graph.keys, "dst", "m", (F.col("m") / F.col("out_degree")).alias("w"))
    graph.laid = laid

    if store_dir is not None:
        stored = _store(graph, store_dir)
        if storage_level is not None:
            sources.unpersist()
            pairs.unpersist()
        return stored
    if storage_level is not None:
        graph.laid = laid.persist(storage_level)
        graph.persisted += [graph.laid, sources]
        graph.laid.count()
        pairs.unpersist()
    return graph


def _bucketed_table(spark, path: str, schema, parts: int, names: list, keys: list[str]) -> DataFrame:
    """Register the Parquet files at ``path`` as a table bucketed by ``keys``."""
    name = f"rankgrad_{uuid.uuid4().hex[:16]}"
    names.append(name)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({', '.join(keys)}) "
              f"INTO {parts} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _store(graph: WeightedGraph, store_dir: str) -> WeightedGraph:
    spark = graph.laid.sparkSession
    root = store_dir.rstrip("/")
    # bucket files carry their bucket id in the name; the bucket spec itself
    # is re-declared when the files are opened (open_weighted)
    for df, sub, keys in ((graph.laid, "laid", graph.keys), (graph.sources, "sources", ["src"])):
        name = f"rankgrad_{uuid.uuid4().hex[:16]}"
        try:
            df.write.mode("overwrite").bucketBy(graph.parts, *keys) \
                .option("path", f"{root}/{sub}").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # reopened below under fresh names
    if graph.hot_keys.count:
        graph.hot_keys.frame.write.mode("overwrite").parquet(f"{root}/hot_keys")
    spark.createDataFrame([(graph.parts, graph.hot_keys.threshold, graph.hot_keys.count, graph.hot_keys.small)],
                          "parts int, threshold long, hot long, small boolean") \
        .write.mode("overwrite").parquet(f"{root}/layout")
    graph.unpersist()
    return open_weighted(spark, root)


def open_weighted(spark, store_dir: str) -> WeightedGraph:
    """Reopen a layout written by ``weight_edges(store_dir=...)``."""
    root = store_dir.rstrip("/")
    meta = spark.read.parquet(f"{root}/layout").first()
    keys = HotKeys(spark.read.parquet(f"{root}/hot_keys") if meta.hot else None, meta.threshold, meta.hot, meta.small)
    graph = WeightedGraph(None, keys, None, meta.parts)
    graph.laid = _bucketed_table(spark, f"{root}/laid", spark.read.parquet(f"{root}/laid").schema,
                                 meta.parts, graph.tables, graph.keys)
    graph.sources = _bucketed_table(spark, f"{root}/sources", spark.read.parquet(f"{root}/sources").schema,
                                    meta.parts, graph.tables, ["src"])
    return graph


def layout_exists(spark, store_dir: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{store_dir.rstrip('/')}/layout/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def contributions(graph: WeightedGraph, ranks: DataFrame) -> DataFrame:
    """``(src, dst, contribution)``: ``rank(src) * w`` per distinct pair.

    Inner join: sources without a rank contribute nothing. The ranks are read
    once, with or without hot sources.
    """
    r = graph.spread(ranks.select(F.col("node").alias("src"), "rank"))
    if graph.hot_keys.count:
        r = graph.dealt(r, *graph.keys)
    return graph.laid.join(r, graph.keys) \
        .select("src", "dst", (F.col("rank") * F.col("w")).alias("contribution"))


def rank_step(graph: WeightedGraph, ranks: DataFrame, damping: float = DAMPING,
              base: float = BASE) -> DataFrame:
    """One iteration: ``base + damping * sum(contribution)`` by target.

    Only nodes that receive a contribution appear in the result; nodes
    without in-edges drop out, dangling targets keep a rank but pass on
    nothing. The sum runs as partial + final aggregate. An ``exact`` graph's ranks
    are then dealt into its parts.
    """
    c = contributions(graph, ranks)
    return graph.dealt(c.groupBy(F.col("dst").alias("node")).agg(
        (F.lit(base) + F.lit(damping) * F.sum("contribution")).alias("rank")), "node")


def adjacency(graph: WeightedGraph | DataFrame) -> DataFrame:
    """Adjacency in flat form, ``(src, dst, m, out_degree)``: one row per
    distinct pair with its number of copies, of a laid-out graph or of raw
    ``(src, dst)`` edges."""
    if isinstance(graph, DataFrame):
        graph = weight_edges(graph, storage_level=None)
    degrees = graph.spread(graph.sources.select("src", "out_degree"))
    return graph.laid.join(degrees, graph.keys).select("src", "dst", "m", "out_degree")


def adjacency_lists(graph: WeightedGraph | DataFrame, max_targets: int) -> DataFrame:
    """Adjacency lists ``(src, part, out_degree, targets)`` of at most about
    ``max_targets`` targets each.

    ``targets`` is a sorted array of ``struct(dst, m)``. A source with more
    distinct targets is split over ``ceil(n / max_targets)`` rows by a hash of
    the target, so no row or task holds an unbounded list.
    """
    if isinstance(graph, DataFrame):
        graph = weight_edges(graph, storage_level=None)
    stats = graph.spread(graph.sources.select(
        "src", "out_degree", F.greatest(F.lit(1), F.ceil(F.col("n_targets") / F.lit(max_targets))).alias("n_parts")))
    return graph.laid.join(stats, graph.keys) \
        .withColumn("part", F.pmod(F.xxhash64("dst"), F.col("n_parts")).cast("int")) \
        .groupBy("src", "part").agg(
            F.first("out_degree").alias("out_degree"),
            F.sort_array(F.collect_list(F.struct("dst", "m"))).alias("targets"))


def contributions_from_adjacency(lists: DataFrame, ranks: DataFrame) -> DataFrame:
    """Fan out adjacency lists: ``(src, dst, contribution)`` per listed target.

    The join key is ``(src, part)``: a source's rank goes to each of its
    lists, which may lie in different tasks.
    """
    parts = lists.groupBy("src").agg(F.max("part").alias("last"))
    r = ranks.select(F.col("node").alias("src"), "rank").join(parts, "src") \
        .select("src", "rank", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("part"))
    return lists.join(r, ["src", "part"]) \
        .select("src", "rank", "out_degree", F.explode("targets").alias("t")) \
        .select("src", F.col("t.dst").alias("dst"),
                (F.col("rank") * F.col("t.m") / F.col("out_degree")).alias("contribution"))


def top_ranks(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest ranks, ties broken by node (TakeOrderedAndProject)."""
    return ranks.orderBy(F.col("rank").desc(), F.col("node").asc()).limit(k)


def partition_profile(df: DataFrame, n: int, key: str) -> DataFrame:
    """Rows per part after hash partitioning by ``key`` into ``n`` parts.

    The hash is the one ``repartition`` uses, so the rows need not move: an
    aggregate of ``n`` rows.
    """
    return df.groupBy(F.pmod(F.hash(key), F.lit(n)).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
