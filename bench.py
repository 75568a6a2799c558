"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf", ...}. Each query runs to completion
through a no-op sink (every row computed, nothing collected). The training
queries also report mean seconds per SGD step, the unit of the published
baseline.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankgrad.plans import catalog, fixtures, train  # noqa: E402
from rankgrad.session import local_session  # noqa: E402
from rankgrad.sources import vectors  # noqa: E402

HEADLINE = [
    "pagerank_edges",
    "pagerank_wiki_10",
    "pagerank_nation",
    "pagerank_resumed",
    "pagerank_skewed",
    "wiki_clean",
    "contributions",
    "step_log_summary",
    "evaluate",
    "grad_allreduce",
    "normalize_fitted",
    "minibatch_assign",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="rankgrad-bench-")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8,
                          checkpoint_dir=os.path.join(scratch, "ck"))
    # warm-up at the smallest scale, not timed: JIT, codegen, Python workers
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(warm):
        for name in ("pagerank_edges", "grad_allreduce"):
            run(catalog.QUERIES[name](spark, warm))
    run(fixtures.g_part(spark, sf_dir).limit(1000))

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.time()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)

    vec = vectors.read_vectors(spark, f"{sf_dir}/embeddings.parquet")
    rows = vec.count()
    extra = {}
    for name, shards, batch in (("sgd_single", 1, 256), ("sgd_sharded", 4, 64)):
        t0 = time.time()
        res = train.train_softmax(vec, shards=shards, batch_size=batch,
                                  order=train.fixture_order())
        times[name] = round(time.time() - t0, 3)
        steps = [r.elapsed for r in res.steps.collect()]
        extra[f"{name}_steps"] = len(steps)
        extra[f"{name}_step_mean_sec"] = round(sum(steps) / len(steps), 4)
        # rows per second over the step loop (the baseline's throughput unit)
        extra[f"{name}_rows_per_sec"] = round(rows / sum(steps), 1)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
