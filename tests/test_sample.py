"""Positions, balanced splits (f), shards with padding, median."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from rankgrad.operators import sample, steps
from rankgrad.session import read_table


def test_positions_equal_row_number(spark):
    li = read_table(spark, SF01, "lineitem").select("l_orderkey", "l_linenumber") \
        .repartition(13)
    order = [F.col("l_linenumber"), F.col("l_orderkey")]
    got = {(r.l_orderkey, r.l_linenumber): r.pos
           for r in sample.with_positions(li, order).collect()}
    want = li.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)
    assert got == {(r.l_orderkey, r.l_linenumber): r.pos for r in want.collect()}


def test_balanced_split_sizes(spark):
    ev = read_table(spark, SF01, "events").select("event_id")
    for n in (3, 7, 30):
        s = sample.balanced_split(ev, n, [sample.random_order_key(["event_id"]), F.col("event_id")])
        sizes = [r["count"] for r in s.groupBy("slice").count().orderBy("slice").collect()]
        assert len(sizes) == n and sum(sizes) == 10000
        assert max(sizes) - min(sizes) <= 1
        assert sizes == sorted(sizes, reverse=True)  # the extra rows go to the first slices


def test_random_split_deals_copies_evenly(spark):
    hot = spark.range(0, 20_000, 1, 6).select(F.when(F.col("id") % 10 > 0, "a").otherwise(F.col("id").cast("string")).alias("src"), F.lit("b").alias("dst"))
    split = sample.random_split(hot, 30)
    assert split.columns == ["src", "dst", "slice"]
    sizes = [r["count"] for r in split.groupBy("slice").count().orderBy("slice").collect()]
    assert sum(sizes) == 20_000 and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    parts = [len(p) for p in split.rdd.glom().collect() if p]
    assert max(parts) <= 2 * sum(parts) / len(parts)  # no partition holds more than twice its share
    assert sample.random_split(hot.limit(0), 3).count() == 0
    assert sorted(r.slice for r in sample.random_split(hot.limit(2), 3).collect()) == [0, 1]


def test_shards_padded(spark):
    emb = read_table(spark, SF01, "embeddings").select("vec_id")
    pos = sample.with_positions(emb, [sample.hash_order_key("vec_id"), F.col("vec_id")])
    three = sample.assign_shards(pos, 3)
    sizes = [r["count"] for r in three.groupBy("shard").count().collect()]
    assert sizes == [167, 167, 167]
    four = sample.assign_batches(sample.assign_shards(pos, 4), 64)
    per = four.groupBy("shard", "batch_id").count().collect()
    assert sorted(r["count"] for r in per) == [61] * 4 + [64] * 4


def test_exact_median_matches_numpy(spark):
    ev = read_table(spark, SF01, "events")
    med = {r.event_type: r.median for r in steps.exact_median(ev, "value", ["event_type"]).collect()}
    pdf = ev.select("event_type", "value").toPandas()
    for t, g in pdf.groupby("event_type"):
        assert abs(med[t] - float(np.median(g["value"]))) < 1e-12
    glob = steps.summarise_steps(ev, value="value", order="event_id").first()
    assert abs(glob.median - float(np.median(pdf["value"]))) < 1e-12
    assert glob.n == 10000


def test_approx_median_is_close(spark):
    ev = read_table(spark, SF01, "events")
    exact = {r.event_type: r.median for r in
             steps.summarise_steps(ev, "value", "event_id", ["event_type"]).collect()}
    approx = {r.event_type: r.median for r in
              steps.summarise_steps(ev, "value", "event_id", ["event_type"], "approx").collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        assert abs(exact[k] - approx[k]) <= 0.05 * abs(exact[k]) + 1.0


def test_seeded_order_changes_per_epoch(spark):
    from rankgrad.plans import train
    emb = read_table(spark, SF01, "embeddings").select("vec_id")
    order = train.seeded_order()
    e0 = {r.vec_id: r.pos for r in sample.with_positions(emb, order(0)).collect()}
    e1 = {r.vec_id: r.pos for r in sample.with_positions(emb, order(1)).collect()}
    again = {r.vec_id: r.pos for r in sample.with_positions(emb, order(0)).collect()}
    assert sorted(e0.values()) == list(range(500)) and e0 == again and e0 != e1
