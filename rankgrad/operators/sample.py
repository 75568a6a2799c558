"""Positions, balanced splits, shards and mini-batches (re-aimed loaders).

Global positions never go through one task: the rows are range-partitioned
by the sort key (ties broken by the caller's extra keys), each partition
numbers its own rows, per-partition counts (one row per partition) give
offsets, and the offsets reach the rows through a broadcast whose size is
the partition count. The sorted rows are first written as a table with their
partition and row number as columns, so every later job sees the same numbers
even if executors are lost and stages recompute. The table has an owner: the
``Scratch`` that the caller gives, or else the frame's user, who frees it with
``session.release``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, live_table

# fixed values of the repeatable "shuffle" order used in the fixtures
ORDER_MULTIPLIER = 7919
ORDER_MODULUS = 10007


def hash_order_key(id_col: str) -> Column:
    """Repeatable pseudo-random order: ``(id * 7919) % 10007``, SQL-portable."""
    return (F.col(id_col) * F.lit(ORDER_MULTIPLIER)) % F.lit(ORDER_MODULUS)


def random_order_key(cols: list[str], seed: int = 123) -> Column:
    """Seeded random order from a hash of the row's columns."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])


def with_positions(df: DataFrame, order_by: list[Column], name: str = "pos",
                   total: str | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Add a 0-based global position in ``order_by`` order, and with ``total``
    the row count as a column of that name.

    ``order_by`` should be a total order (end with a unique key) for the
    positions to be repeatable, and for rows that repeat to be dealt evenly.
    """
    part = F.spark_partition_id()
    tagged = df.orderBy(*order_by).withColumn("_pid", part) \
        .withColumn("_row", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33))
    tagged = scratch.save(tagged, "positions") if scratch else live_table(tagged, "positions")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-partition window here is bounded
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_total"))
    return tagged.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, F.col("_off") + F.col("_row")) \
        .withColumnRenamed("_total", total or "_total") \
        .drop("_pid", "_row", "_off", *([] if total else ["_total"]))


def balanced_split(df: DataFrame, n: int, order_by: list[Column],
                   name: str = "slice", scratch: Scratch | None = None) -> DataFrame:
    """Split rows in ``order_by`` order into ``n`` slices of equal size.

    Slice ``i`` takes positions ``[i*q, (i+1)*q)`` with ``q = N // n``; the
    ``N % n`` leftover rows go one each to slices ``0, 1, ...``. Sizes differ
    by at most one. The slices are read from one table (see ``with_positions``).
    """
    pos = with_positions(df, order_by, "_pos", total="_rows", scratch=scratch)
    p, q = F.col("_pos"), F.floor(F.col("_rows") / F.lit(n))
    slice_col = F.when(p < q * n, F.floor(p / q)).otherwise(p - q * n)
    return pos.withColumn(name, slice_col.cast("int")).drop("_pos", "_rows")


def random_split(df: DataFrame, n: int, seed: int = 123, name: str = "slice",
                 scratch: Scratch | None = None) -> DataFrame:
    """``balanced_split`` in a seeded random order.

    Every row gets its own key, so copies of one row are dealt like others.
    """
    tagged = df.withColumn("_copy", F.monotonically_increasing_id())
    key = random_order_key([*df.columns, "_copy"], seed)
    return balanced_split(tagged, n, [key, F.col("_copy")], name, scratch).drop("_copy")


def assign_shards(positioned: DataFrame, n: int, pos: str = "pos",
                  pad: bool = True) -> DataFrame:
    """Distributed-sampler layout: ``shard = pos % n``, ``shard_pos = pos // n``.

    With ``pad``, the first ``ceil(N/n)*n - N`` rows are repeated at the end
    (positions ``N, N+1, ...``) so that all shards are equally long.
    """
    out = positioned
    if pad and n > 1:
        total = (positioned.agg(F.max(pos)).first()[0] or 0) + 1
        extra = (-total) % n
        if extra:
            repeat = positioned.filter(F.col(pos) < F.lit(extra)) \
                .withColumn(pos, F.col(pos) + F.lit(total))
            out = positioned.unionByName(repeat)
    return out.withColumn("shard", (F.col(pos) % F.lit(n)).cast("int")) \
        .withColumn("shard_pos", F.floor(F.col(pos) / F.lit(n)).cast("long"))


def assign_batches(df: DataFrame, size: int, pos: str = "shard_pos") -> DataFrame:
    """Consecutive mini-batches of ``size`` rows; the short last one is kept."""
    return df.withColumn("batch_id", F.floor(F.col(pos) / F.lit(size)).cast("long"))


def every_nth(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Rows whose 0-based step number is a multiple of ``n``."""
    return df.filter(F.col(col) % F.lit(n) == 0)
