"""Inputs derived from the driver tables: graphs and text lines.

Every fixture is a DataFrame plan over the given tables, so its size grows
with them. The SQL twins of these definitions live in ``rankgrad.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table


def g_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> supplier, one edge per line item."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def g_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hot source: line items 1-3 of every order (about 3/7 of all rows)
    leave node 0, the rest their part; targets are orders."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.when(F.col("l_linenumber") <= 3, F.lit(0).cast("bigint"))
                     .otherwise(F.col("l_partkey")).alias("src"),
                     F.col("l_orderkey").alias("dst"))


def g_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer nation -> supplier nation per line item (dense, multi-edges)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(o, li.l_orderkey == o.o_orderkey) \
        .join(c, o.o_custkey == c.c_custkey) \
        .join(s, li.l_suppkey == s.s_suppkey) \
        .select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst"))


def g_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user -> value bucket, one edge per event."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("src"),
                     F.pmod(F.floor(F.col("value") * 10).cast("bigint"), F.lit(150))
                     .cast("bigint").alias("dst"))


def g_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page url -> each href in its html (acyclic: targets are never urls)."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        F.col("url").alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))
        .alias("dst"))


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per event, covering the parsing edge cases.

    The case is ``event_id % 11`` (T = event_type, TAB = chr(9)):
    0 ``# T``; 1 ``T#<TAB>User u``; 2 empty; 3 ``T``; 4 ``T<TAB>x<TAB>y``;
    5 ``T<TAB>``; 6 ``T<TAB>Category:T``; 7 ``T<TAB>Talk:T``; 8 ``Talk:T<TAB>T``;
    9, 10 ``U{user_id}<TAB>u{floor(value*10) % 150}``.
    """
    ev = read_table(spark, sf_dir, "events")
    t = F.col("event_type")
    case = F.col("event_id") % 11
    tab = F.lit("\t")
    bucket = F.pmod(F.floor(F.col("value") * 10).cast("bigint"), F.lit(150))
    line = (F.when(case == 0, F.concat(F.lit("# "), t))
            .when(case == 1, F.concat(t, F.lit("#"), tab, F.lit("User u")))
            .when(case == 2, F.lit(""))
            .when(case == 3, t)
            .when(case == 4, F.concat(t, tab, F.lit("x"), tab, F.lit("y")))
            .when(case == 5, F.concat(t, tab))
            .when(case == 6, F.concat(t, tab, F.lit("Category:"), t))
            .when(case == 7, F.concat(t, tab, F.lit("Talk:"), t))
            .when(case == 8, F.concat(F.lit("Talk:"), t, tab, t))
            .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"), tab,
                                F.lit("u"), bucket.cast("string"))))
    return ev.select(F.col("event_id"), line.alias("value"))


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated web edge list with comment lines, from the tables.

    One line ``partkey<TAB>suppkey`` per line item, plus one comment line
    ``# supplier <key> <name>`` per supplier.
    """
    li = read_table(spark, sf_dir, "lineitem")
    sup = read_table(spark, sf_dir, "supplier")
    edges = li.select(F.concat_ws("\t", F.col("l_partkey").cast("string"),
                                  F.col("l_suppkey").cast("string")).alias("value"))
    comments = sup.select(F.concat(F.lit("# supplier "), F.col("s_suppkey").cast("string"),
                                   F.lit(" "), F.col("s_name")).alias("value"))
    return edges.unionByName(comments)
