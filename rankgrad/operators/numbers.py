"""Node numbers: titles become longs before the rank loop and titles again after it.

The numbers are positions of the distinct titles in sorted order, taken partition by
partition (``with_positions``), so no task sees all titles. Edges are numbered by two
joins against the dictionary, whose rows are unique; a hot title's edges are salted by
their other end and its dictionary row is sent to every salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .sample import with_positions
from .skew import every_salt, find_hot_keys, salt_of


def node_numbers(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, id)``: every node of ``edges(src, dst)`` with a gapless number from 0."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return with_positions(nodes, [F.col("node")], "id", scratch=scratch).select("node", "id")


def number_edges(pairs: DataFrame, ids: DataFrame, parts: int | None = None,
                 hot_threshold: int | None = None) -> DataFrame:
    """Folded ``pairs(src, dst, m)`` with the numbers of ``ids(node, id)`` for both ends."""
    parts = parts or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = pairs
    for key, other in (("src", "dst"), ("dst", "src")):
        left, right, keys = out, ids.select(F.col("node").alias(key), "id"), [key]
        hot = find_hot_keys(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "n", parts, threshold=hot_threshold)
        if hot.count:
            left = left.join(hot.table(), key, "left").withColumn("salt", salt_of(other)).drop("salts")
            right = right.join(hot.table(), key, "left").withColumn("salt", every_salt()).drop("salts")
            keys = [key, "salt"]
        # the number replaces the title in this column only
        out = left.join(right, keys).drop(*keys).withColumnRenamed("id", key)
    return out.select("src", "dst", "m")


def name_nodes(ranks: DataFrame, ids: DataFrame) -> DataFrame:
    """``ranks(node, rank)`` by number, back by title; both sides are unique."""
    return ranks.select(F.col("node").alias("id"), "rank").join(ids, "id").select("node", "rank")
