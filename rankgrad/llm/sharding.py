"""Sharding by Karmarkar-Karp differencing: near-equal bytes, equal texts together.

A group is all documents of one text; it is never divided. The few large groups
(at least ``1 / (64 * shards)`` of all bytes, so at most ``64 * shards`` of them)
are differenced first. The others are hashed into parts of bounded size; every
part starts from its share of the large groups' loads, an uneven partial
partition, and repeatedly combines the two partial partitions of largest spread,
oppositely ordered. So each part fills what the large groups leave, and the sum
over the parts is even without any task that sees all groups.

Defined results: a null text is an empty one (size 1, the same group); null ids
are sharded like others; repeated rows are placed row by row; no rows give none.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, saved, shuffle_parts

SHARDS = 16


def difference(sums: np.ndarray) -> np.ndarray:
    """Shard of every slot of every partial partition in ``sums`` (n x shards).

    Row i holds the bytes in the slots of partial partition i; the result has
    the shard that each slot ends up in.
    """
    n, k = sums.shape
    places = np.empty((n, k), np.int32)
    if not n:
        return places
    order = np.argsort(-sums, axis=1, kind="stable")
    rows: list[list[int]] = np.take_along_axis(sums, order, 1).tolist()
    heap = [(r[-1] - r[0], i) for i, r in enumerate(rows)]  # most spread first
    heapq.heapify(heap)
    merged: list[tuple[int, int, list[int]]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = [x + y for x, y in zip(rows[a], reversed(rows[b]), strict=True)]
        by_size = sorted(range(k), key=lambda i: -both[i])
        rows[a] = rows[b] = None
        rows.append([both[i] for i in by_size])
        merged.append((a, b, by_size))
        heapq.heappush(heap, (rows[-1][-1] - rows[-1][0], len(rows) - 1))
    shard = {n + len(merged) - 1: list(range(k))}  # by position in the sorted sums
    for at in range(len(merged) - 1, -1, -1):
        a, b, by_size = merged[at]
        here = shard.pop(n + at)
        first, second = [0] * k, [0] * k
        for position, i in enumerate(by_size):
            first[i] = second[k - 1 - i] = here[position]
        shard[a], shard[b] = first, second
    for i in range(n):
        places[i, order[i]] = shard[i]
    return places


def _leaves(sizes: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((len(sizes), k), np.int64)
    out[:, 0] = sizes
    return out


def assign_groups(groups: DataFrame, shards: int = SHARDS, part_groups: int = 8192) -> DataFrame:
    """``(key, shard)`` for groups ``(key, bytes)``; ``groups`` should be a stored table."""
    spark = groups.sparkSession
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    floor = max(total / (64 * shards), 1)
    large = groups.where(F.col("bytes") >= floor).orderBy(F.desc("bytes"), "key").toPandas()  # 64 * shards at most
    places = difference(_leaves(large["bytes"].to_numpy(np.int64), shards))[:, 0] if len(large) else np.zeros(0, np.int32)
    loads = np.bincount(places, large["bytes"], shards) if len(large) else np.zeros(shards)
    parts = max(1, -(-(n - len(large)) // part_groups))
    share = (loads / parts).astype(np.int64)

    def place(pdf):
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        sums = np.vstack([share[None, :], _leaves(pdf["bytes"].to_numpy(np.int64), shards)])
        slots = difference(sums)
        to = np.empty(shards, np.int32)  # the loads' slots are the shards' numbers
        to[slots[0]] = np.arange(shards)
        return pdf.assign(shard=to[slots[1:, 0]])[["key", "shard"]]

    kinds = groups.select("key", F.lit(0).alias("shard")).schema
    small = (groups.where(F.col("bytes") < floor)
             .withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
             .groupBy("part").applyInPandas(lambda pdf: place(pdf.drop(columns="part")), kinds))
    fixed = spark.createDataFrame([(bytes(k), int(p)) for k, p in zip(large["key"], places)], kinds)
    return small.unionByName(fixed)


def with_slots(rows: DataFrame, by: str, order: list[str], slot: str = "slot", bucket_rows: int = 20_000) -> DataFrame:
    """``rows`` with gapless positions from 0 within each ``by``; ``rows`` must be a stored table.

    ``row_id`` (unique per row) deals the rows of one ``by`` into buckets that
    are numbered apart and then shifted by the buckets before.
    """
    n = rows.count()
    buckets = max(1, -(-n // bucket_rows), shuffle_parts(rows.sparkSession) // 4)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("row_id"), F.lit(buckets)))
    counts = dealt.groupBy(by, "bucket").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(by, "bucket").orderBy(*order, "row_id")
    return (dealt.withColumn("place", F.row_number().over(inside))
            .join(starts, [by, "bucket"])
            .withColumn(slot, F.col("start") + F.col("place") - 1)
            .drop("bucket", "place", "start"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, size, text_crc32, shard and slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    with Scratch(docs.sparkSession, "shards") as scratch:
        placed = _placed(docs, shards, id_col, text, scratch)
    return with_slots(placed, "shard", ["doc_id"]).drop("row_id")


def _placed(docs: DataFrame, shards: int, id_col: str, text, scratch: Scratch) -> DataFrame:
    rows = scratch.save(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 40)).alias("key")), "rows")
    groups = scratch.save(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    # a text's rows may be a third of all: the join on its key is one that AQE splits
    return saved(rows.join(assign_groups(groups, shards), "key")
                 .select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("row_id")), "shard-placed")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards under the law ``bytes``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = shard_documents(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
