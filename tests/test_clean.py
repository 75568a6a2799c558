"""Line cleaning, parsing and the link-file source: edge cases of the fixtures."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF01
from rankgrad.functions import clean
from rankgrad.plans import fixtures as fx
from rankgrad.sources import text


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fixture_counts(spark):
    ll = fx.link_lines(spark, SF01)
    assert ll.count() == 10000
    assert clean.drop_comments(ll, "anywhere").count() == 7272
    assert clean.drop_comments(ll, "prefix").count() == 9090
    low = ll.select(F.lower("value").alias("value"))
    assert low.filter(clean.field_count_is(2)).count() == 6363
    assert clean.clean_links(ll, "faithful").count() == 4545
    assert clean.clean_links(ll, "intended").count() == 5454
    pairs = clean.parse_edges(low, "lenient")
    assert pairs.filter(F.col("dst") == "").count() == 909


def test_comment_modes(spark):
    df = lines(spark, ["# c", "a#\tb", "", "a\tb"])
    assert [r.value for r in clean.drop_comments(df, "anywhere").collect()] == ["a\tb"]
    assert sorted(r.value for r in clean.drop_comments(df, "prefix").collect()) == \
        sorted(["", "a#\tb", "a\tb"])


def test_strict_parse_fails_on_other_field_counts(spark):
    ok = clean.parse_edges(lines(spark, ["a\tb", "c\t"]), "strict").collect()
    assert [(r.src, r.dst) for r in ok] == [("a", "b"), ("c", "")]
    for bad in (["one"], ["a\tb\tc"]):
        with pytest.raises(PySparkException):
            clean.parse_edges(lines(spark, bad), "strict").collect()


def test_first_two_ignores_rest_and_fails_on_one_field(spark):
    got = clean.parse_edges(lines(spark, ["a\tb\tc"]), "first_two").collect()
    assert (got[0].src, got[0].dst) == ("a", "b")
    with pytest.raises(PySparkException):
        clean.parse_edges(lines(spark, [""]), "first_two").collect()


def test_namespace_filter_modes(spark):
    df = lines(spark, ["A\tCategory:X", "B\tTalk:Y", "Talk:C\tD", "E\tF"])
    faithful = {(r.src, r.dst) for r in clean.clean_links(df, "faithful").collect()}
    intended = {(r.src, r.dst) for r in clean.clean_links(df, "intended").collect()}
    assert faithful == {("talk:c", "d"), ("e", "f")}
    assert intended == faithful | {("a", "category:x")}


def test_link_files_name_filter(spark, tmp_dir):
    files = {"link_a": "a\tb\nc\td\n", "link_b": "e\tf\n", ".link_hidden": "x\ty\n",
             "other": "p\tq\n"}
    for name, body in files.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(body)
    got = sorted(r.value for r in text.read_link_files(spark, tmp_dir).collect())
    assert got == ["a\tb", "c\td", "e\tf"]


def test_union_over_two_folders(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    os.makedirs(a)
    os.makedirs(b)
    for d, body in ((a, "x\ty\n"), (b, "x\ty\nz\tw\n")):
        with open(os.path.join(d, "link-1"), "w") as fh:
            fh.write(body)
    u = clean.union_sources(text.read_link_files(spark, a), text.read_link_files(spark, b))
    assert sorted(r.value for r in u.collect()) == ["x\ty", "x\ty", "z\tw"]
    assert text.read_link_files(spark, [a, b]).count() == 3


def test_edges_from_text_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "web.txt")
    with open(path, "w") as fh:
        fh.write("# header\n1\t2\n1\t3\textra\n2\t1\n")
    e = text.edges_from_text(spark, path)
    assert sorted((r.src, r.dst) for r in e.collect()) == [("1", "2"), ("1", "3"), ("2", "1")]


def test_rank_text_sink_roundtrip(spark, tmp_dir):
    ranks = spark.createDataFrame([("n1", 0.15), ("n2", 1.2345678), ("o'neil", 12345678.5),
                                   ("back\\slash", 0.1 + 0.2)], "node string, rank double")
    path = os.path.join(tmp_dir, "out")
    text.write_ranks(ranks, path, single_file=True, fmt="text")
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    raw = sorted(r.value for r in spark.read.text(path).collect())
    want = sorted(str((r.node, r.rank)) for r in ranks.collect())
    assert raw == want
    assert "(\"o'neil\", 12345678.5)" in raw and "('n1', 0.15)" in raw
    back = sorted(tuple(r) for r in text.read_rank_lines(spark, path).collect())
    assert back == sorted(tuple(r) for r in ranks.collect())
    with pytest.raises(Exception):
        text.write_ranks(ranks, path, fmt="text")  # target exists


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rank_table_sinks(spark, tmp_dir, fmt):
    ranks = spark.createDataFrame([("n1", 0.15), ("n2", 2.5)], "node string, rank double")
    path = os.path.join(tmp_dir, fmt)
    text.write_ranks(ranks, path, fmt=fmt)
    reader = spark.read.schema("node string, rank double")
    back = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    assert sorted(map(tuple, back.collect())) == [("n1", 0.15), ("n2", 2.5)]
