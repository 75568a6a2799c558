"""Edges in a grid of cells, for graphs with many edges per node.

A node's block is a hash of it; the cell of an edge is (block of the source, block of
the target). An iteration sends a rank once to every cell that has edges of its node
(at most ``blocks`` of them), and a cell adds up what it has for a target before
anything leaves it (at most ``blocks`` partial sums per target). So at most
``2 * blocks * nodes`` rows are shuffled, and never more than two per edge, where a
layout by source alone can send a partial sum per edge.

A cell is joined in one task with NumPy, so its size is bounded: a cell with more than
``max_cell`` edges is cut further by a hash of the edge, which also splits a hot source
or target. A cell is packed into one row once, its edges as places among its sources
and targets, so that an iteration neither sorts edges nor sends them row by row. Node
keys are longs (titles: see ``numbers``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .graph import BASE, DAMPING, weight_edges

#: Bits of a cell's number that count the cuts of one (source block, target block).
CUT_BITS = 24


@dataclass
class EdgeGrid:
    """``cells``: ``(cell, src, dst, w)``. ``packed``: a row per cell, dealt by cell. ``routes``: ``(src, cells)``, dealt by source."""

    cells: DataFrame
    packed: DataFrame
    routes: DataFrame
    blocks: int

    def unpersist(self) -> None:
        self.packed.unpersist()
        self.routes.unpersist()


def grid_edges(edges: DataFrame, scratch: Scratch, blocks: int = 4, max_cell: int = 1_000_000,
               folded: bool = False) -> EdgeGrid:
    """Weighted edges of ``edges(src, dst)`` cut into ``blocks * blocks`` cells or more."""
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the layout by source is read once, so it isn't kept
    graph = weight_edges(edges, storage_level=None, folded=folded)
    try:
        block = lambda c: F.pmod(F.xxhash64(F.lit("block"), c), F.lit(blocks))
        plain = scratch.save(graph.edges().withColumn("at", block("src") * blocks + block("dst")), "plain")
    finally:
        graph.unpersist()
    # one row per (source block, target block): blocks * blocks of them
    cuts = plain.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_cell)).alias("cuts"))
    cell = F.shiftleft(F.col("at"), CUT_BITS) + F.pmod(F.xxhash64("src", "dst"), F.col("cuts"))
    cells = plain.join(F.broadcast(cuts) if blocks * blocks <= 1_000_000 else cuts, "at") \
        .select(cell.alias("cell"), "src", "dst", "w")
    packed = scratch.save(cells.groupBy("cell").applyInArrow(_packers(), PACKED), "cells").repartition(parts, "cell").sortWithinPartitions("cell").persist()
    # a source's cells are few: its blocks of targets, or, of cut cells, one per max_cell edges
    sent = packed.select("cell", "sources").mapInArrow(_senders(), "src long, cell long")
    routes = scratch.save(sent.groupBy("src").agg(F.collect_list("cell").alias("cells")), "routes").repartition(parts, "src").persist()
    return EdgeGrid(cells, packed, routes, blocks)


#: A cell: its sources and targets (longs, sorted), each edge's places among them (ints) and its weight (double).
PACKED = "cell long, sources binary, targets binary, src binary, dst binary, w binary"


def _packers():
    def pack(edges: pa.Table) -> pa.Table:
        sources, src = np.unique(edges["src"].to_numpy(), return_inverse=True)
        targets, dst = np.unique(edges["dst"].to_numpy(), return_inverse=True)
        parts = (sources, targets, src.astype(np.int32), dst.astype(np.int32), edges["w"].to_numpy())
        return pa.table({"cell": edges["cell"].slice(0, 1).combine_chunks()}
                        | {n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("sources", "targets", "src", "dst", "w"), parts)})

    return pack


def _senders():
    def send(batches):
        for b in batches:
            for cell, sources in zip(b.column(0), b.column(1)):
                names = np.frombuffer(sources.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(names), cell.as_py()))], names=["src", "cell"])

    return send


def routed(grid: EdgeGrid, ranks: DataFrame) -> DataFrame:
    """``(cell, src, rank)``: each rank once for every cell with edges of its node."""
    return grid.routes.join(ranks.select(F.col("node").alias("src"), "rank"), "src") \
        .select(F.explode("cells").alias("cell"), "src", "rank")


def _adders():
    def add(ranks: pa.Table, cell: pa.Table) -> pa.Table:
        names, values = ranks["src"].to_numpy(), ranks["rank"].to_numpy()
        if not len(names) or not cell.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "partial": pa.array([], pa.float64())})
        sources, targets, src, dst, w = (np.frombuffer(cell[n][0].as_py(), kind) for n, kind in (
            ("sources", np.int64), ("targets", np.int64), ("src", np.int32), ("dst", np.int32), ("w", np.float64)))
        at = np.minimum(np.searchsorted(sources, names), len(sources) - 1)
        mine = sources[at] == names
        rank, ranked = np.zeros(len(sources)), np.zeros(len(sources), bool)
        rank[at[mine]], ranked[at[mine]] = values[mine], True
        if not ranked.all():  # sources without a rank contribute nothing
            edges = ranked[src]
            src, dst, w = src[edges], dst[edges], w[edges]
        reached = np.bincount(dst, minlength=len(targets)) > 0
        sums = np.bincount(dst, rank[src] * w, len(targets))
        return pa.table({"node": pa.array(targets[reached], pa.int64()), "partial": pa.array(sums[reached], pa.float64())})

    return add


def cell_sums(grid: EdgeGrid, ranks: DataFrame) -> DataFrame:
    """``(node, partial)``: each cell's sum of contributions for each of its targets."""
    return routed(grid, ranks).groupBy("cell").cogroup(grid.packed.groupBy("cell")) \
        .applyInArrow(_adders(), "node long, partial double")


def grid_step(grid: EdgeGrid, ranks: DataFrame, damping: float = DAMPING, base: float = BASE) -> DataFrame:
    """One iteration, with the semantics of ``graph.rank_step``."""
    return cell_sums(grid, ranks).groupBy("node").agg(
        (F.lit(base) + F.lit(damping) * F.sum("partial")).alias("rank"))
