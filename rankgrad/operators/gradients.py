"""Per-shard softmax gradients and their mean (gather or all-reduce).

The kernel is NumPy inside ``mapInPandas``: each task folds its Arrow
batches into one fixed-size row per shard (count, loss sum, gradient sums),
so what leaves a task is bounded by the model size, never by the data.
Those rows are summed by a Spark aggregate keyed by (shard, slot), and a second
one, keyed by slot, averages over the shards: the driver gets one model, however
many shards and tasks there are.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.model import Params


def _folder(feat: str, label: str, shard: str):
    """A function from batches and ``(w, b)`` to one frame ``(shard, stats)``; pickled by value, as are all that use it."""
    def fold(batches, w, b):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf[feat].to_numpy()).astype(np.float64)
            y = pdf[label].to_numpy().astype(np.int64)
            s = pdf[shard].to_numpy().astype(np.int64)
            z = x @ w.T + b
            z -= z.max(axis=1, keepdims=True)
            e = np.exp(z)
            tot = e.sum(axis=1, keepdims=True)
            rows = np.arange(len(y))
            loss = np.log(tot[:, 0]) - z[rows, y]
            dz = e / tot
            dz[rows, y] -= 1.0
            for sh in np.unique(s):
                m = s == sh
                g = np.concatenate([dz[m].T @ x[m], dz[m].sum(axis=0)[:, None]], axis=1)
                part = np.concatenate([[m.sum(), loss[m].sum()], g.ravel()])
                acc[int(sh)] = acc.get(int(sh), 0.0) + part
        if acc:
            yield pd.DataFrame({"shard": list(acc.keys()),
                                "stats": [v.tolist() for v in acc.values()]})

    return fold


def _kernel(w: np.ndarray, b: np.ndarray, feat: str, label: str, shard: str):
    fold = _folder(feat, label, shard)
    return lambda batches: fold(batches, w, b)


def shard_stats(df: DataFrame, params: Params, feat: str = "embedding", label: str = "label",
                shard: str = "shard") -> DataFrame:
    """``(shard, slot, v, n)`` sums: slot 0 = rows, 1 = loss sum, 2.. = gradient sums
    of the ``K x (d+1)`` matrix ``[W | b]`` (row-major); ``n`` = rows of the shard."""
    fold = _kernel(params.w, params.b, feat, label, shard)
    partial = df.select(feat, label, shard).mapInPandas(fold, "shard int, stats array<double>")
    return partial.select("shard", F.col("stats")[0].alias("n"), F.posexplode("stats").alias("slot", "v")) \
        .groupBy("shard", "slot").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))


def shard_gradients(df: DataFrame, params: Params, feat: str = "embedding",
                    label: str = "label", shard: str = "shard") -> DataFrame:
    """Long form ``(shard, k, j, g)``: each shard's mean gradient (``j = d`` is the bias)."""
    k, d = params.w.shape
    g = shard_stats(df, params, feat, label, shard).filter(F.col("slot") >= 2)
    idx = F.col("slot") - 2
    return g.select("shard", (F.floor(idx / (d + 1))).cast("int").alias("k"),
                    (idx % (d + 1)).cast("int").alias("j"),
                    (F.col("v") / F.col("n")).alias("g"))


def step_sums(df: DataFrame, params: Params, feat: str = "embedding", label: str = "label",
              shard: str = "shard") -> DataFrame:
    """``(slot, total, shards)``: per slot the sum of the shards' means, and how many there are.

    Two levels: sums by (shard, slot), then means by slot. ``K*(d+1) + 1`` rows (slot 1
    is the loss), whatever the number of shards; none for a step without rows.
    """
    return shard_stats(df, params, feat, label, shard).filter(F.col("slot") >= 1) \
        .groupBy("slot").agg(F.sum(F.col("v") / F.col("n")).alias("total"), F.count(F.lit(1)).alias("shards"))


def mean_gradients(shard_grads: DataFrame, how: str = "allreduce",
                   n_shards: int | None = None) -> DataFrame:
    """Average shard gradients: ``gather`` = mean at one place, ``allreduce``
    = each shard divides by the shard count, then all are summed."""
    if how == "gather":
        return shard_grads.groupBy("k", "j").agg(F.avg("g").alias("g"))
    if how == "allreduce":
        if n_shards is None:
            raise ValueError("allreduce needs n_shards")
        return shard_grads.groupBy("k", "j").agg(F.sum(F.col("g") / F.lit(n_shards)).alias("g"))
    raise ValueError(f"unknown mean {how!r}")


def collect_step(df: DataFrame, params: Params, n_shards: int, feat: str = "embedding",
                 label: str = "label", shard: str = "shard") -> tuple[np.ndarray, float]:
    """One step's averaged gradient (flat ``K*(d+1)``) and mean shard loss.

    The average over shards is taken on the cluster (``step_sums``); the driver gets
    one row per model parameter and one for the loss. A shard without rows counts as a
    gradient of zero and has no loss; a step without rows has the loss NaN.
    """
    k, d = params.w.shape
    total, shards = np.zeros(k * (d + 1) + 2), 0
    for slot, value, found in step_sums(df, params, feat, label, shard).collect():
        total[slot], shards = value, found
    # all-reduce mean: divide by the shard count, then sum
    return total[2:] / n_shards, float(total[1] / shards) if shards else float("nan")


def collect_run(df: DataFrame, steps: range, params: Params, velocity: np.ndarray | None, n_shards: int,
                update: Callable[[np.ndarray, np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray]],
                feat: str = "embedding", label: str = "label", shard: str = "shard",
                step: str = "batch_id") -> tuple[Params, np.ndarray, list[tuple[float, float]]]:
    """Consecutive small steps as one job: parameters and velocity after them, and (loss, seconds) of each.

    A step needs the parameters of the one before, so a run of steps is one task, which
    must hold the run's rows; what ``collect_step`` gives for a step and ``update`` (of
    flat parameters, gradient and velocity) make the next parameters there. A step's
    seconds are its own and its share of the job's.
    """
    k, d = params.w.shape
    fold, start = _folder(feat, label, shard), params.flat()

    def run(batches):
        rows = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({step: []})])
        by = dict(list(rows.groupby(step)))
        now, moved = start, velocity
        for at in steps:
            began, total, found = time.perf_counter(), np.zeros(k * (d + 1) + 1), 0
            m = now.reshape(k, d + 1)
            for part in fold([by[at]] if at in by else [], m[:, :d], m[:, d]):
                for stats in map(np.asarray, part["stats"]):
                    total, found = total + stats[1:] / stats[0], found + 1
            now, moved = update(now, total[1:] / n_shards, moved)
            last = at == steps[-1]
            yield pd.DataFrame({"step": [at], "loss": [total[0] / found if found else float("nan")], "seconds": [time.perf_counter() - began],
                                "params": [now.tolist() if last else None], "velocity": [moved.tolist() if last else None]})

    clock = time.time()
    got = df.select(step, feat, label, shard).coalesce(1).mapInPandas(
        run, "step long, loss double, seconds double, params array<double>, velocity array<double>").collect()
    got.sort(key=lambda r: r.step)
    share = max(0.0, time.time() - clock - sum(r.seconds for r in got)) / len(got)
    return (Params.from_flat(np.array(got[-1].params), k, d), np.array(got[-1].velocity),
            [(r.loss, r.seconds + share) for r in got])
