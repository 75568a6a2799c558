"""Hot-key detection with a proven size bound.

A key is *hot* when it owns more than ``total / parts`` rows. Since the
counts sum to ``total``, fewer than ``parts`` keys can be hot, so the hot
set is bounded by the partition count, not by the data, and so is the sum
of their salts. A forced threshold has no such bound: its set is counted and
broadcast only up to ``max_broadcast_rows``; beyond, the same joins shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class HotKeys:
    frame: DataFrame | None  # (key, salts) rows; None when there is no hot key
    threshold: int
    count: int
    small: bool = True  # counted and within the broadcast bound

    def table(self) -> DataFrame:
        """The hot set for a join: broadcast if its counted size allows."""
        assert self.frame is not None
        return F.broadcast(self.frame) if self.small else self.frame


def find_hot_keys(counts: DataFrame, key: str, count_col: str, parts: int,
                  threshold: int | None = None, min_threshold: int = 10_000,
                  max_broadcast_rows: int = 1_000_000) -> HotKeys:
    """Keys whose ``count_col`` exceeds ``threshold``, with ``ceil(count / threshold)`` salts.

    ``counts`` holds one row per key (already aggregated, so small per key).
    The default threshold is ``max(ceil(total / parts), min_threshold)``:
    fewer than ``parts`` keys can exceed it.
    """
    if threshold is None:
        row = counts.agg(F.sum(count_col).alias("t"), F.max(count_col).alias("m")).first()
        total, largest = row.t or 0, row.m or 0
        threshold = max(math.ceil(total / max(parts, 1)), min_threshold)
        if largest <= threshold:  # the common case: one job, no hot key
            return HotKeys(None, threshold, 0)
    hot = counts.filter(F.col(count_col) > threshold).select(
        key, F.ceil(F.col(count_col) / F.lit(threshold)).cast("int").alias("salts"))
    n = hot.count()
    if n == 0:
        return HotKeys(None, threshold, 0)
    return HotKeys(hot.cache(), threshold, n, n <= max_broadcast_rows)


def salt_of(other: str, salts: str = "salts") -> F.Column:
    """A row's salt: a hash of ``other`` for hot keys, 0 for the rest."""
    return F.when(F.col(salts).isNotNull(), F.pmod(F.xxhash64(other), F.col(salts))) \
        .otherwise(F.lit(0)).cast("int")


def every_salt(salts: str = "salts") -> F.Column:
    """All salts of a key, for the side with one row per key."""
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1))
