"""Synchronous mini-batch SGD and evaluation as Spark jobs.

Layout per epoch: rows get global positions in a (seeded) order, are padded
to a multiple of the shard count, and carry ``shard`` and ``batch_id``. The
laid-out epoch is written once under the shared checkpoint folder,
partitioned by ``block`` (a run of consecutive batches), so each step's
read is pruned to one block's files instead of scanning the epoch.

Per step, one Spark job computes the shard gradients on executors
(``mapInPandas`` kernel), adds them up and averages them over the shards; the
driver gets one gradient, applies the SGD update (momentum, weight decay), and the
new parameters travel in the next step's closure. A job costs far more than a step of
a few hundred rows, so small steps run a block of the log at a time, one job a block,
in a task that goes through the same gradients and updates in order.

The step log is written block by block as the run goes. With ``save_dir``, every
block also saves parameters, velocity, epoch and step there; a later call with
``resume`` goes on from the last complete save, after comparing the folder's run
record with its own data and settings.
"""

from __future__ import annotations

import json
import math
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import test_transform, train_transform
from ..functions.model import (Params, argmax_expr, cross_entropy_expr, label_range, scores_expr)
from ..operators.gradients import collect_run, collect_step
from ..operators.sample import (assign_batches, assign_shards, hash_order_key,
                                random_order_key, with_positions)
from ..session import LIVE, Scratch, drop_path
from ..sources.steplog import StepLog
from .pagerank import _hadoop_fs

# fixed values of the reference's optimiser and loaders
LEARNING_RATE = 0.1
MOMENTUM = 0.9
WEIGHT_DECAY = 0.0001
BATCH_SIZE = 256
SEED = 123
LOG_EVERY = 20
TEST_MOD = 5

# row-group size of a staged epoch: what one step reads at least
STEP_ROW_GROUP_BYTES = 512 * 1024
# a run of steps in one task: rows of a step at most, steps at least
RUN_STEP_ROWS = 4096
RUN_STEPS = 16
# rows of a block that one task writes, about
WRITER_ROWS = 125_000


def split(df: DataFrame, test_mod: int = TEST_MOD, id_col: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """Train / test parts: ``id % test_mod <> 0`` / ``= 0``."""
    is_test = F.col(id_col) % F.lit(test_mod) == 0
    return df.filter(~is_test), df.filter(is_test)


def fixture_order(id_col: str = "vec_id") -> Callable[[int], list[Column]]:
    """The repeatable order of the fixtures (same every epoch)."""
    return lambda epoch: [hash_order_key(id_col), F.col(id_col)]


def seeded_order(id_col: str = "vec_id", seed: int = SEED) -> Callable[[int], list[Column]]:
    """A fresh seeded permutation per epoch, like a sampler seeded with seed + epoch."""
    return lambda epoch: [random_order_key([id_col], seed + epoch), F.col(id_col)]


def layout_epoch(df: DataFrame, shards: int, batch_size: int, order: list[Column],
                 scratch: Scratch | None = None) -> DataFrame:
    """Positions, padding, shard and batch columns for one epoch."""
    pos = with_positions(df, order, "pos", scratch=scratch)
    return assign_batches(assign_shards(pos, shards, "pos", pad=True), batch_size, "shard_pos")


def stage_epoch(laid: DataFrame, path: str, batches_per_block: int, writers: int = 1) -> DataFrame:
    """Write a laid-out epoch once and return it read back.

    Rows go to ``block = batch_id // batches_per_block`` folders, dealt over
    ``writers`` files each, sorted by batch within a file and written in small
    row groups: a step's filter prunes to one folder, then to the few row
    groups whose batch_id range holds it (footer statistics).
    """
    blocked = laid.withColumn("block", F.floor(F.col("batch_id") / batches_per_block).cast("long"))
    if writers > 1:
        blocked = blocked.repartition("block", F.pmod(F.xxhash64("batch_id", "shard", "x"), F.lit(writers)))
    else:
        blocked = blocked.repartition("block")
    blocked.sortWithinPartitions("block", "batch_id") \
        .write.option("parquet.block.size", STEP_ROW_GROUP_BYTES) \
        .partitionBy("block").parquet(path)
    return laid.sparkSession.read.parquet(path)


def step_rows(staged: DataFrame, step: int, batches_per_block: int) -> DataFrame:
    """The rows of one step: a folder prune plus a pushed ``batch_id`` filter."""
    return staged.filter((F.col("block") == step // batches_per_block)
                         & (F.col("batch_id") == step))


def run_rows(staged: DataFrame, steps: range, batches_per_block: int) -> DataFrame:
    """The rows of consecutive steps, pruned like ``step_rows``."""
    return staged.filter(F.col("block").between(steps[0] // batches_per_block, steps[-1] // batches_per_block)
                         & F.col("batch_id").between(steps[0], steps[-1]))


@dataclass
class TrainResult:
    params: Params
    steps: DataFrame   # (epoch, iteration, elapsed): the step log
    losses: DataFrame  # (epoch, step, loss): 0-based step, mean shard loss


def sgd_rule(lr: float, momentum: float, weight_decay: float):
    """``sgd_update`` of flat parameters, as a function that is pickled by value."""
    def update(w, grad, velocity):
        dvec = grad + weight_decay * w
        v = dvec if velocity is None else momentum * velocity + dvec
        return w - lr * v, v

    return update


def sgd_update(params: Params, grad: np.ndarray, velocity: np.ndarray | None,
               lr: float, momentum: float, weight_decay: float) -> tuple[Params, np.ndarray]:
    """``d = g + wd * w``; ``v = mu * v + d`` (``v = d`` at first); ``w -= lr * v``."""
    w, v = sgd_rule(lr, momentum, weight_decay)(params.flat(), grad, velocity)
    return Params.from_flat(w, *params.w.shape), v


class TrainRun:
    """A training run's folder: its record, its step log and its last saved state.

    Without a folder the log is a live table (``session.release``) and nothing is saved.
    """

    _STATE = re.compile(r"state=(\d+)-(\d+)$")

    def __init__(self, spark, folder: str | None, record: dict, resume: bool, csv_path: str | None):
        self.spark, self.folder = spark, folder.rstrip("/") if folder else None
        self.params = self.velocity = None
        self.epoch = self.step = 0  # steps of this epoch that are done
        if self.folder:
            self._open(record, resume)
        elif resume:
            raise ValueError("resume needs save_dir")
        self.log = StepLog(spark, f"{self.folder}/log" if self.folder else Scratch(spark, f"{LIVE}-steps").path("log"), csv_path)

    def _open(self, record: dict, resume: bool) -> None:
        fs, root = _hadoop_fs(self.spark, self.folder)
        found = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
        if not resume:
            if found:
                raise ValueError(f"{self.folder} holds another run: resume it, or give an empty folder")
            self.spark.createDataFrame([(json.dumps(record),)], "record string").coalesce(1).write.parquet(f"{self.folder}/run")
            return
        if "run" not in found:
            raise ValueError(f"{self.folder} has no run record to resume from")
        known = json.loads(self.spark.read.parquet(f"{self.folder}/run").first()[0])
        for name, value in record.items():
            if known.get(name) != value:
                raise ValueError(f"cannot resume {self.folder}: its {name} is {known.get(name)!r}, not {value!r}")
        done = self._states()
        if done:
            self.epoch, self.step = done[-1]
            saved = self.spark.read.parquet(self._state(*done[-1])).first()
            self.params = Params.from_flat(np.array(saved.params), saved.k, saved.d)
            self.velocity = np.array(saved.velocity)

    def _state(self, epoch: int, step: int) -> str:
        return f"{self.folder}/state={epoch}-{step}"

    def _states(self) -> list[tuple[int, int]]:
        """(epoch, step) of the complete saves, in order."""
        fs, root = _hadoop_fs(self.spark, self.folder)
        marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = []
        for st in fs.listStatus(root):
            if (m := self._STATE.search(st.getPath().getName())) and fs.exists(marker(st.getPath(), "_SUCCESS")):
                found.append((int(m[1]), int(m[2])))
        return sorted(found)

    def commit(self, epoch: int, step: int, params: Params, velocity: np.ndarray) -> None:
        """Write the block of the log, then the state after ``step`` steps of ``epoch``; earlier states go."""
        self.log.commit()
        if not self.folder:
            return
        k, d = params.w.shape
        state = [(k, d, params.flat().tolist(), velocity.tolist())]
        self.spark.createDataFrame(state, "k int, d int, params array<double>, velocity array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(self._state(epoch, step))
        for old in self._states():
            if old < (epoch, step):
                drop_path(self.spark, self._state(*old))


def train_softmax(df: DataFrame, shards: int = 1, batch_size: int = BATCH_SIZE,
                  lr: float = LEARNING_RATE, momentum: float = MOMENTUM,
                  weight_decay: float = WEIGHT_DECAY, epochs: int = 1, classes: int = 10,
                  feature_col: str = "embedding", label_col: str = "label",
                  id_col: str = "vec_id", order: Callable[[int], list[Column]] | None = None,
                  augment: Callable[[DataFrame, int], DataFrame] | None = None,
                  block_rows: int = 1_000_000, params: Params | None = None,
                  save_dir: str | None = None, resume: bool = False, log_path: str | None = None,
                  log_every: int = LOG_EVERY) -> TrainResult:
    """One or more epochs of synchronous SGD over ``shards`` x ``batch_size`` rows per step.

    Every ``log_every`` steps and at an epoch's end the step log grows by a block
    (``log_path``: also as CSV there) and, with ``save_dir``, the state is saved.
    ``resume`` goes on from the last save; it needs the data, settings and order of
    the run that is resumed, but may ask for more epochs.
    """
    spark = df.sparkSession
    order = order or seeded_order(id_col)
    base = df.select(id_col, label_col, feature_col)
    d = base.select(F.size(feature_col)).first()[0]
    label_range(base, label_col, classes)
    record = {}
    if save_dir:
        rows = base.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*base.columns).cast("decimal(38,0)"))).first()
        record = {"data": f"{rows[0]}:{rows[1]}", "shards": shards, "batch_size": batch_size, "lr": lr, "momentum": momentum,
                  "weight_decay": weight_decay, "classes": classes, "order": [str(c) for c in order(0)],
                  "start": None if params is None else params.flat().tolist(),
                  "augment": None if augment is None else augment.__qualname__}
    run = TrainRun(spark, save_dir, record, resume, log_path)
    params = run.params or params or Params.zeros(classes, d)
    velocity = run.velocity
    batches_per_block = max(1, block_rows // (batch_size * shards))
    writers = max(1, -(-max(block_rows, batch_size * shards) // WRITER_ROWS))
    for epoch in range(run.epoch, epochs):
        with Scratch(spark, f"epoch{epoch}") as scratch:
            data = augment(base, epoch) if augment else base
            data = data.withColumn("x", F.col(feature_col))  # its own type: floats stay floats on disk
            with Scratch(spark, "positions") as positions:
                laid = layout_epoch(data.select(id_col, label_col, "x"), shards, batch_size, order(epoch), positions)
                staged = stage_epoch(laid.select("batch_id", "shard", label_col, "x"), scratch.path("staged"), batches_per_block, writers)
            n_batches = staged.agg(F.max("batch_id")).first()[0] + 1
            clock = time.time()
            step = run.step if epoch == run.epoch else 0
            while step < n_batches:
                block = range(step, min(n_batches, (step // log_every + 1) * log_every))
                if len(block) >= RUN_STEPS and shards * batch_size <= RUN_STEP_ROWS:
                    params, velocity, done = collect_run(run_rows(staged, block, batches_per_block), block, params, velocity,
                                                         shards, sgd_rule(lr, momentum, weight_decay), "x", label_col, "shard")
                    for at, (loss, seconds) in zip(block, done):
                        run.log.add(epoch, at + 1, seconds, loss)
                    clock = time.time()
                else:
                    for at in block:
                        grad, loss = collect_step(step_rows(staged, at, batches_per_block), params, shards, "x", label_col, "shard")
                        params, velocity = sgd_update(params, grad, velocity, lr, momentum, weight_decay)
                        now = time.time()
                        run.log.add(epoch, at + 1, now - clock, loss)
                        clock = now
                step = block.stop
                run.commit(epoch, step, params, velocity)
    log = run.log.read()
    steps = log.select("epoch", "iteration", "elapsed")
    losses = log.select("epoch", (F.col("iteration") - 1).alias("step"), "loss")
    return TrainResult(params, steps, losses)


def evaluate(df: DataFrame, params: Params, batch_size: int = BATCH_SIZE,
             feature_col: str = "embedding", label_col: str = "label",
             id_col: str = "vec_id") -> DataFrame:
    """``(test_loss, correct, total, accuracy)`` in one row.

    ``test_loss`` is the mean of batch-mean losses over consecutive batches
    in id order (a short last batch weighs as much as a full one);
    ``accuracy`` is over rows, in percent. All batches but the last are
    full, so only the last ``L = N - (nb - 1) * B`` rows need to be found:
    a top-L by id (bounded by the batch size), no global numbering.
    """
    scored = df.select(id_col, label_col,
                       scores_expr(F.col(feature_col), params).alias("z")) \
        .select(id_col, cross_entropy_expr(F.col("z"), F.col(label_col)).alias("loss"),
                (argmax_expr(F.col("z")) == F.col(label_col)).cast("long").alias("hit"))
    scored = scored.persist()
    try:
        tot = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("loss").alias("s"),
                         F.sum("hit").alias("c")).first()
        n, s, c = tot.n, tot.s or 0.0, tot.c or 0
        nb = math.ceil(n / batch_size) if n else 0
        last = n - (nb - 1) * batch_size if nb else 0
        if nb and last < batch_size:
            s_last = scored.orderBy(F.col(id_col).desc()).limit(last) \
                .agg(F.sum("loss")).first()[0]
            mean_loss = ((s - s_last) / batch_size + s_last / last) / nb
        else:
            mean_loss = s / n if n else None
    finally:
        scored.unpersist()
    spark = df.sparkSession
    acc = 100.0 * c / n if n else None
    return spark.createDataFrame([(mean_loss, int(c), int(n), acc)],
                                 "test_loss double, correct long, total long, accuracy double")


def train_and_evaluate(df: DataFrame, shards: int = 1, batch_size: int = BATCH_SIZE,
                       epochs: int = 1, transforms: bool = False,
                       **kw) -> tuple[TrainResult, DataFrame]:
    """Split, train for ``epochs``, evaluate on the held-out part.

    ``transforms``: the reference's pipelines, crop + flip + normalise per
    epoch for training and normalise for testing.
    """
    train, test = split(df)
    if transforms:
        kw["augment"] = lambda d, epoch: train_transform(d, epoch)
        test = test_transform(test)
    res = train_softmax(train, shards=shards, batch_size=batch_size, epochs=epochs, **kw)
    return res, evaluate(test, res.params, batch_size=batch_size)
