"""Command line for the batch jobs: ``input output`` in, files out.

Run ``python -m rankgrad.cli JOB ...``, or ``spark-submit`` a two-line
script calling ``rankgrad.cli.main()``. The session comes from
``SparkSession.builder.getOrCreate()``, so master, memory and
``spark.checkpoint.dir`` are whatever the launcher sets.

    pagerank-edges INPUT OUTPUT   edge-list text: comment lines, tab-separated pairs
    pagerank-links INPUT OUTPUT   folder of link* files from a dump, cleaned first
    train INPUT OUTPUT            labelled-vector Parquet: one epoch of SGD, then
                                  evaluation; writes the step log and the metrics
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from .functions.clean import clean_links
from .plans.pagerank import pagerank
from .plans.train import train_and_evaluate
from .session import ensure_checkpoint_dir
from .sources.steplog import write_step_log
from .sources.text import edges_from_text, read_link_files, write_ranks
from .sources.vectors import read_vectors

_LEVELS = {"memory_and_disk": StorageLevel.MEMORY_AND_DISK, "disk": StorageLevel.DISK_ONLY,
           "memory": StorageLevel.MEMORY_ONLY, "none": None}


def _rank_args(p: argparse.ArgumentParser, iterations: int) -> None:
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--iterations", type=int, default=iterations)
    p.add_argument("--partitions", type=int, default=None,
                   help="hash parts of the edge layout (default: shuffle partitions)")
    p.add_argument("--persist", choices=sorted(_LEVELS), default="memory_and_disk")
    p.add_argument("--edge-store", choices=["cache", "table"], default="cache")
    p.add_argument("--checkpoint-every", type=int, default=3)
    p.add_argument("--save-dir", default=None, help="save ranks every k iterations here")
    p.add_argument("--resume", action="store_true", help="continue from --save-dir")
    p.add_argument("--format", choices=["text", "parquet", "csv"], default="text")
    p.add_argument("--single-file", action="store_true",
                   help="one output file (funnels the output through one task)")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="rankgrad")
    ap.add_argument("--checkpoint-dir", default=None,
                    help="shared folder for lineage cuts, used when the session "
                         "sets no spark.checkpoint.dir")
    sub = ap.add_subparsers(dest="job", required=True)
    e = sub.add_parser("pagerank-edges", help="rank an edge-list text file")
    _rank_args(e, 10)
    e.add_argument("--comments", choices=["prefix", "anywhere"], default="prefix")
    e.add_argument("--split", choices=["first_two", "strict"], default="first_two")
    lk = sub.add_parser("pagerank-links", help="rank a folder of link* files")
    _rank_args(lk, 10)
    lk.add_argument("--category", choices=["faithful", "intended"], default="faithful")
    t = sub.add_parser("train", help="SGD epochs on a vector table, then evaluation")
    t.add_argument("input")
    t.add_argument("output")
    t.add_argument("--shards", type=int, default=1)
    t.add_argument("--batch-size", type=int, default=256)
    t.add_argument("--epochs", type=int, default=1)
    t.add_argument("--transforms", action="store_true", help="crop + flip + normalise")
    return ap


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    if getattr(args, "checkpoint_dir", None):
        ensure_checkpoint_dir(spark, fallback=args.checkpoint_dir)
    if args.job in ("pagerank-edges", "pagerank-links"):
        if args.job == "pagerank-edges":
            edges = edges_from_text(spark, args.input, args.comments, args.split)
        else:
            edges = clean_links(read_link_files(spark, args.input), args.category)
        ranks = pagerank(edges, args.iterations, partitions=args.partitions,
                         storage_level=_LEVELS[args.persist], edge_store=args.edge_store,
                         checkpoint_every=args.checkpoint_every, save_dir=args.save_dir,
                         resume_from=args.save_dir if args.resume else None)
        write_ranks(ranks, args.output, single_file=args.single_file, fmt=args.format)
    elif args.job == "train":
        res, ev = train_and_evaluate(read_vectors(spark, args.input), shards=args.shards,
                                     batch_size=args.batch_size, epochs=args.epochs,
                                     transforms=args.transforms)
        write_step_log(res.steps, f"{args.output.rstrip('/')}/steps")
        ev.write.option("header", True).csv(f"{args.output.rstrip('/')}/metrics")
        res.params.long_form(spark).write.parquet(f"{args.output.rstrip('/')}/params")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"rankgrad-{args.job}").getOrCreate()
    run(args, spark)


if __name__ == "__main__":
    main()
