"""The rank job: a driver loop of join + aggregate over persisted edges.

Faithful semantics: ranks start at 1.0 for sources only, each iteration
keeps only nodes that receive a contribution, ``rank = 0.15 + 0.85 * sum``,
no normalisation and no dangling redistribution, fixed iteration count.

Fault tolerance: every ``checkpoint_every`` iterations the ranks are saved
reliably, bucketed by node (which keeps them co-partitioned with the edges),
in the shared checkpoint folder or, with ``save_dir``, under
``save_dir/iter=K``; the final ranks are checkpointed. A later call with
``resume_from`` continues from the last complete save instead of iteration 0,
after comparing the folder's run record with its own edges and parameters.
"""

from __future__ import annotations

import re
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import (BASE, DAMPING, WeightedGraph, checked_edges, edge_multiplicity,
                               layout_exists, open_weighted, rank_step, weight_edges)
from ..operators.grid import grid_edges, grid_step
from ..operators.numbers import name_nodes, node_numbers, number_edges
from ..session import Scratch, drop_path, ensure_checkpoint_dir, live_table, release, scratch_path

_ITER_DIR = re.compile(r"iter=(\d+)$")


def _hadoop_fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def completed_saves(spark, save_dir: str) -> list[int]:
    """Iteration numbers saved completely (``_SUCCESS`` written) under ``save_dir``."""
    fs, root = _hadoop_fs(spark, save_dir)
    if not fs.exists(root):
        return []
    done = []
    for st in fs.listStatus(root):
        m = _ITER_DIR.search(st.getPath().getName())
        if m and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                st.getPath(), "_SUCCESS")):
            done.append(int(m.group(1)))
    return sorted(done)


def edge_fingerprint(edges: DataFrame, folded: bool = False) -> str:
    """Count and hash sum of the edges: equal for equal bags, in any order."""
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("src", "dst", *["m"] * folded).cast("decimal(38,0)")).alias("h")).first()
    return f"{row.n}:{row.h}"


def read_record(spark, save_dir: str):
    """The run record of a save folder, or None."""
    fs, p = _hadoop_fs(spark, f"{save_dir.rstrip('/')}/run/_SUCCESS")
    return spark.read.parquet(f"{save_dir.rstrip('/')}/run").first() if fs.exists(p) else None


def _new_record(spark, save_dir: str, record: dict) -> None:
    fs, p = _hadoop_fs(spark, save_dir)
    if fs.exists(p) and len(fs.listStatus(p)):
        raise ValueError(f"{save_dir} holds another run's saves: resume from it, or give an empty folder")
    spark.createDataFrame([tuple(record.values())], "edges string, damping double, base double") \
        .coalesce(1).write.parquet(f"{save_dir.rstrip('/')}/run")


def _check_record(spark, save_dir: str, record: dict) -> None:
    found = read_record(spark, save_dir)
    if found is None:
        raise ValueError(f"{save_dir} has no run record to resume from")
    for name, value in record.items():
        if found[name] != value:
            raise ValueError(f"cannot resume from {save_dir}: its {name} is {found[name]!r}, not {value!r}")


def pagerank(edges: DataFrame, iterations: int = 10, damping: float = DAMPING,
             base: float = BASE, partitions: int | None = None,
             storage_level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
             checkpoint_every: int | None = 3, save_dir: str | None = None,
             resume_from: str | None = None, hot_threshold: int | None = None,
             materialize: bool = True, edge_store: str = "cache", folded: bool = False) -> DataFrame:
    """Ranks ``(node, rank)`` after ``iterations`` steps over ``edges(src, dst)``.

    ``partitions``: hash parts of the edge layout, of the ranks in every iteration
    and of the result (default: the session's shuffle partitions). They are exchanges
    of the plan itself, so they hold whenever it runs; the partial sums still meet in
    the session's partitions first, so a given count costs one more shuffle of
    node-sized data per iteration. ``storage_level``: level of
    the persisted weighted edges, ``None`` for no persistence.
    ``edge_store="table"``: write the edge layout bucketed by source under
    ``save_dir/edges`` (or a fresh scratch folder, freed at the end) instead of
    caching it; a resumed run reopens it rather than rebuilding it.
    ``materialize``: save the final ranks reliably and drop the persisted
    edges before returning; without ``save_dir`` the caller frees the saved ranks
    with ``session.release``. ``folded``: ``edges(src, dst, m)`` has one row per pair.

    ``save_dir`` must be empty or, with ``resume_from``, hold saves of the same
    edges, damping and base: its run record is compared, and a mismatch raises.
    """
    spark = edges.sparkSession
    if edge_store not in ("cache", "table"):
        raise ValueError(f"unknown edge store {edge_store!r}")
    save_dir, resume_from = (d and d.rstrip("/") for d in (save_dir, resume_from))
    if save_dir or resume_from:
        record = {"edges": edge_fingerprint(edges, folded), "damping": float(damping), "base": float(base)}
        if resume_from:
            _check_record(spark, resume_from, record)
        if save_dir and save_dir != resume_from:
            _new_record(spark, save_dir, record)
    stored = f"{resume_from}/edges" if resume_from and layout_exists(spark, f"{resume_from}/edges") else None
    if stored:
        graph = open_weighted(spark, stored)
        if partitions not in (None, graph.parts) or hot_threshold not in (None, graph.hot_keys.threshold):
            asked = (partitions, hot_threshold)
            had = (graph.parts, graph.hot_keys.threshold)
            graph.unpersist()
            raise ValueError(f"the stored layout has parts and threshold {had}, not {asked}")
    else:
        own = scratch_path(spark, "edges") if edge_store == "table" and not save_dir else None
        store_dir = own or (f"{save_dir}/edges" if edge_store == "table" else None)
        graph = weight_edges(edges, parts=partitions, storage_level=storage_level,
                             hot_threshold=hot_threshold, store_dir=store_dir, folded=folded)
        graph.folder = own
    graph.exact = partitions is not None
    cuts = Cuts(spark, graph.parts)
    try:
        start, ranks = 0, None
        if resume_from:
            saves = [k for k in completed_saves(spark, resume_from) if k <= iterations]
            if saves:
                start = saves[-1]
                ranks = graph.dealt(spark.read.parquet(f"{resume_from}/iter={start}"), "node")
        if ranks is None:
            ranks = graph.dealt(graph.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank")), "node")
        if checkpoint_every and not save_dir:
            ensure_checkpoint_dir(spark)
        for i in range(start + 1, iterations + 1):
            ranks = rank_step(graph, ranks, damping=damping, base=base)
            if checkpoint_every and i % checkpoint_every == 0 and i < iterations:
                ranks = cuts.cut(ranks, f"{save_dir}/iter={i}" if save_dir else None)
        done = start == iterations  # resumed at the target: the save is the answer
        if materialize and not done and (graph.persisted or graph.tables or cuts.name):
            if save_dir:
                ranks.write.mode("overwrite").parquet(f"{save_dir}/iter={iterations}")
                ranks = graph.dealt(spark.read.parquet(f"{save_dir}/iter={iterations}"), "node")
            else:
                ranks = graph.dealt(live_table(ranks, "ranks"), "node")
    finally:
        if materialize:
            cuts.close()
            graph.unpersist()
    return ranks


def pagerank_numbered(edges: DataFrame, iterations: int = 10, **options) -> DataFrame:
    """``pagerank`` with titles numbered before the loop and joined back once after it.

    No title passes through the loop's joins and shuffles. ``options`` as for
    ``pagerank``, without ``materialize``; saves hold numbers, which are the same for
    the same edges.
    """
    spark = edges.sparkSession
    with Scratch(spark, "numbers") as scratch:
        pairs = scratch.save(edge_multiplicity(checked_edges(edges)), "pairs")
        ids = node_numbers(pairs, scratch)
        ranks = pagerank(scratch.save(number_edges(pairs, ids), "coded"), iterations, folded=True, **options)
        named = live_table(name_nodes(ranks, ids), "ranks")
        release(ranks)
    return named


def pagerank_grid(edges: DataFrame, iterations: int = 10, damping: float = DAMPING, base: float = BASE,
                  blocks: int = 4, max_cell: int = 1_000_000, checkpoint_every: int = 3) -> DataFrame:
    """``pagerank`` over edges in a grid of cells (``operators.grid``).

    Node keys that aren't whole numbers are numbered first.
    """
    spark = edges.sparkSession
    whole = all(isinstance(edges.schema[c].dataType, T.IntegralType) for c in ("src", "dst"))
    with Scratch(spark, "grid") as scratch:
        pairs = scratch.save(edge_multiplicity(checked_edges(edges)), "pairs")
        ids = None if whole else node_numbers(pairs, scratch)
        coded = number_edges(pairs, ids) if ids else pairs.select(F.col("src").cast("long"), F.col("dst").cast("long"), "m")
        grid = grid_edges(coded, scratch, blocks, max_cell, folded=True)
        try:
            ranks = grid.routes.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
            for i in range(1, iterations + 1):
                ranks = grid_step(grid, ranks, damping, base)
                if i % checkpoint_every == 0 and i < iterations:
                    ranks = scratch.save(ranks, f"ranks-{i}")
            if ids:
                ranks = name_nodes(ranks, ids)
            elif iterations:
                kind = edges.schema["dst"].dataType
                ranks = ranks.select(F.col("node").cast(kind).alias("node"), "rank")
            return live_table(ranks, "ranks")
        finally:
            grid.unpersist()


class Cuts:
    """Lineage cuts of a rank loop: the last one is live, earlier ones are freed.

    A cut writes the ranks as a table bucketed by ``node``. A bucketed scan
    reports the same hash partitioning the edges have, so the next iteration's
    join reads the ranks without a shuffle; a plain checkpoint under adaptive
    execution would lose it. Cuts at a given path are a run's saves and stay;
    the others lie in scratch folders that go once the next cut is committed.
    """

    def __init__(self, spark, parts: int):
        self.spark, self.parts, self.name, self.scratch = spark, parts, None, None

    def cut(self, ranks: DataFrame, path: str | None = None) -> DataFrame:
        scratch = None if path else scratch_path(self.spark, "ranks")
        name = f"rankgrad_{uuid.uuid4().hex[:16]}"
        try:
            ranks.write.mode("overwrite").bucketBy(self.parts, "node").option("path", path or scratch).saveAsTable(name)
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            raise
        self.close()
        self.name, self.scratch = name, scratch
        return self.spark.table(name)

    def close(self) -> None:
        if self.name:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if self.scratch:
            drop_path(self.spark, self.scratch)
        self.name = self.scratch = None


def pagerank_graph(graph: WeightedGraph, iterations: int = 10,
                   damping: float = DAMPING, base: float = BASE) -> DataFrame:
    """Loop over an already laid-out graph, lazy: nothing runs before an action."""
    ranks = graph.dealt(graph.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank")), "node")
    for _ in range(iterations):
        ranks = rank_step(graph, ranks, damping=damping, base=base)
    return ranks
