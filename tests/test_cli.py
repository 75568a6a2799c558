"""The command line runs the batch jobs end to end."""

import os

from conftest import SF01
from rankgrad import cli
from rankgrad.plans import fixtures as fx
from rankgrad.plans.pagerank import pagerank
from rankgrad.sources import text


def test_pagerank_edges_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "web.txt")
    with open(src, "w") as fh:
        fh.write("# a comment\na\tb\na\tc\tx\nb\ta\nc\ta\n")
    out = os.path.join(tmp_dir, "out")
    cli.run(cli.parser().parse_args(["pagerank-edges", src, out, "--iterations", "3",
                                     "--single-file"]), spark)
    got = {r.node: r.rank for r in text.read_rank_lines(spark, out).collect()}
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a"), ("c", "a")], "src string, dst string")
    want = {r.node: r.rank for r in pagerank(e, 3).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_pagerank_links_job_with_save_and_resume(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "dump")
    lines = fx.link_lines(spark, SF01).select("value")
    lines.write.text(os.path.join(folder, "link_part"))
    save, out = os.path.join(tmp_dir, "save"), os.path.join(tmp_dir, "out")
    args = ["pagerank-links", folder, out, "--iterations", "3", "--format", "parquet",
            "--save-dir", save, "--edge-store", "table"]
    cli.run(cli.parser().parse_args(args), spark)
    first = {r.node: r.rank for r in spark.read.parquet(out).collect()}
    assert len(first) == 150
    cli.run(cli.parser().parse_args(args[:2] + [out + "2"] + args[3:] + ["--resume"]), spark)
    again = {r.node: r.rank for r in spark.read.parquet(out + "2").collect()}
    assert again == first


def test_train_job(spark, tmp_dir):
    out = os.path.join(tmp_dir, "train")
    cli.run(cli.parser().parse_args(["train", f"{SF01}/embeddings.parquet", out,
                                     "--shards", "4", "--batch-size", "64"]), spark)
    m = spark.read.option("header", True).csv(f"{out}/metrics").first()
    assert int(m.total) == 100
    assert spark.read.parquet(f"{out}/params").count() == 650
    assert spark.read.option("header", True).csv(f"{out}/steps").count() == 2
