"""Summaries of step logs and other measurements, grouped or global.

All statistics are partial + final aggregates except the median, which is
exact: rows are sorted globally by (group, value, tie-breaker) with range
partitioning, numbered without a single-task window (see ``with_positions``),
and the one or two middle rows of each group are picked and averaged. No
group is ever gathered into one task, however large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import with_positions


def exact_median(df: DataFrame, value: str, by: list[str] | None = None,
                 tiebreak: str | None = None) -> DataFrame:
    """``(by..., median)``: mean of the middle value(s), as ``quantile_cont(0.5)``."""
    by = by or []
    data = df.select(*by, value).filter(F.col(value).isNotNull())
    if tiebreak is None:
        data = data.withColumn("_tb", F.monotonically_increasing_id())
        tiebreak = "_tb"
    pos = with_positions(data, [*[F.col(c) for c in by], F.col(value), F.col(tiebreak)], "_pos")
    groups = pos.groupBy(*by).agg(F.min("_pos").alias("_start"),
                                  F.count(F.lit(1)).alias("_n"))
    # the one or two middle positions of each group, as global positions
    targets = groups.select(F.explode(F.array_distinct(F.array(
        (F.col("_start") + F.floor((F.col("_n") - 1) / 2)).cast("long"),
        (F.col("_start") + F.ceil((F.col("_n") - 1) / 2)).cast("long")))).alias("_pos"))
    # _pos is unique on both sides: an even equi-join, whatever the group sizes
    return pos.join(targets, "_pos").groupBy(*by).agg(F.avg(value).alias("median"))


def summarise_steps(df: DataFrame, value: str = "elapsed", order: str = "iteration",
                    by: list[str] | None = None, median: str | None = "exact") -> DataFrame:
    """count, total, mean, sd, min, max, first, last, mean without first and
    last (by ``order``), and the median, per group.

    ``median``: ``"exact"`` (global sort, see ``exact_median``), ``"approx"``
    (``percentile_approx``: a bounded sketch per group, one pass), or ``None``.
    """
    by = by or []
    v = F.col(value)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.sum(v).alias("total"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("sd"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.min_by(v, F.col(order)).alias("first"),
        F.max_by(v, F.col(order)).alias("last"),
    ]
    if median == "approx":
        aggs.append(F.percentile_approx(v, 0.5).cast("double").alias("median"))
    elif median not in ("exact", None):
        raise ValueError(f"unknown median mode {median!r}")
    stats = df.groupBy(*by).agg(*aggs).withColumn(
        "mean_mid", F.when(F.col("n") > 2, (F.col("total") - F.col("first") - F.col("last"))
                           / (F.col("n") - 2)))
    if median != "exact":
        return stats
    med = exact_median(df, value, by)
    if by:
        return stats.join(med, by)
    # global: the median is one number
    return stats.withColumn("median", F.lit(med.first()[0]).cast("double"))
