"""Training properties (d), (e), (h), evaluation and the step log."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from rankgrad.functions import features, model
from rankgrad.operators import gradients, sample, steps
from rankgrad.plans import train
from rankgrad.sources import steplog, vectors


def vec(spark):
    return vectors.read_vectors(spark, f"{SF01}/embeddings.parquet")


def numpy_data(spark):
    rows = sample.with_positions(vec(spark), [sample.hash_order_key("vec_id"), F.col("vec_id")]) \
        .orderBy("pos").collect()
    x = np.array([r.embedding for r in rows], dtype=np.float64)
    y = np.array([r.label for r in rows])
    return x, y


def test_first_step_from_zero(spark):
    x, y = numpy_data(spark)
    laid = vec(spark).withColumn("shard", F.lit(0))
    full = laid.withColumn("x", features.as_double("embedding"))
    grad, loss = gradients.collect_step(full, model.Params.zeros(10, 64), 1, feat="x")
    assert abs(loss - math.log(10)) < 1e-12
    g = grad.reshape(10, 65)
    # full-batch check value of the fixture
    assert abs(np.abs(g[:, :64]).sum() - 0.895883) < 1e-6
    # closed form at zero weights: (0.1 - onehot) x, averaged; first batch of 256
    first = sample.with_positions(laid, [sample.hash_order_key("vec_id"), F.col("vec_id")]) \
        .filter(F.col("pos") < 256).withColumn("x", features.as_double("embedding"))
    g256, _ = gradients.collect_step(first, model.Params.zeros(10, 64), 1, feat="x")
    want = ((0.1 - np.eye(10)[y[:256]]).T @ x[:256]) / 256
    assert np.allclose(g256.reshape(10, 65)[:, :64], want, atol=1e-12)


def numpy_sgd(x, y, batch, lr=0.1, mu=0.9, wd=1e-4):
    w = np.zeros((10, 65))
    v = None
    xa = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    losses = []
    for s in range(0, len(x), batch):
        xb, yb = xa[s:s + batch], y[s:s + batch]
        z = xb @ w.T
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        losses.append(float(np.mean(-np.log(p[np.arange(len(yb)), yb]))))
        p[np.arange(len(yb)), yb] -= 1
        g = p.T @ xb / len(yb) + wd * w
        v = g if v is None else mu * v + g
        w = w - lr * v
    return w, losses


def test_sgd_matches_numpy_and_one_shard_equals_four(spark):
    x, y = numpy_data(spark)
    want_w, want_loss = numpy_sgd(x, y, 256)
    one = train.train_softmax(vec(spark), shards=1, batch_size=256, order=train.fixture_order())
    four = train.train_softmax(vec(spark), shards=4, batch_size=64, order=train.fixture_order())
    w1 = np.concatenate([one.params.w, one.params.b[:, None]], axis=1)
    w4 = np.concatenate([four.params.w, four.params.b[:, None]], axis=1)
    assert np.allclose(w1, want_w, atol=1e-12)
    assert np.allclose(w4, w1, atol=1e-12)
    l1 = [r.loss for r in one.losses.orderBy("step").collect()]
    l4 = [r.loss for r in four.losses.orderBy("step").collect()]
    assert abs(l1[0] - math.log(10)) < 1e-12
    assert np.allclose(l1, want_loss, atol=1e-12) and np.allclose(l4, l1, atol=1e-12)
    assert [r.iteration for r in one.steps.orderBy("iteration").collect()] == [1, 2]


def test_eight_steps_match_numpy(spark):
    big = vectors.read_vectors(spark, f"{SF01.replace('0.01', '0.1')}/embeddings.parquet")
    rows = sample.with_positions(big, [sample.hash_order_key("vec_id"), F.col("vec_id")]).orderBy("pos").collect()
    want_w, want_loss = numpy_sgd(np.array([r.embedding for r in rows], dtype=np.float64), np.array([r.label for r in rows]), 256)
    got = train.train_softmax(big, shards=1, batch_size=256, order=train.fixture_order(), block_rows=500)
    assert len(want_loss) == 8
    assert np.allclose(np.concatenate([got.params.w, got.params.b[:, None]], axis=1), want_w, atol=1e-12)
    assert np.allclose([r.loss for r in got.losses.orderBy("step").collect()], want_loss, atol=1e-12)


def test_step_collects_rows_of_the_model_only(spark):
    p = model.Params.zeros(10, 64)
    for tasks in (2, 16):
        df = vec(spark).withColumn("shard", (F.col("vec_id") % 4).cast("int")).repartition(tasks)
        assert gradients.shard_stats(df, p).count() == 4 * (10 * 65 + 2)


def test_labels_are_range_checked(spark):
    for bad in (-1, 10, None):
        df = vec(spark).withColumn("label", F.when(F.col("vec_id") == 3, F.lit(bad)).otherwise(F.col("label")).cast("int"))
        with pytest.raises(ValueError, match="labels must lie"):
            train.train_softmax(df)
        with pytest.raises(ValueError, match="labels must lie"):
            model.fit_centroids(df)
    assert model.fit_centroids(vec(spark).withColumn("label", F.col("label") + 5), classes=15).w.shape == (15, 64)


def test_planes_keep_every_value(spark):
    side, channels = 32, 3
    x = np.arange(1.0, side * side * channels + 1)
    df = spark.createDataFrame([(i, x.tolist()) for i in range(1, 12)], "vec_id long, embedding array<double>")
    grid = x.reshape(side, side, channels)
    padded = np.pad(grid, ((4, 4), (4, 4), (0, 0)))
    for r in features.random_crop(df, channels=channels).collect():
        dx, dy = (r.vec_id * 7) % 9 - 4, (r.vec_id * 5) % 9 - 4
        assert np.array_equal(np.array(r.embedding).reshape(grid.shape), padded[4 + dy:36 + dy, 4 + dx:36 + dx])
    for r in features.random_flip(df, channels=channels).collect():
        assert np.array_equal(np.array(r.embedding).reshape(grid.shape), grid[:, ::-1] if r.vec_id % 2 else grid)
    assert {len(r.embedding) for r in features.train_transform(df, 0, channels=channels).collect()} == {3072}
    with pytest.raises(Exception, match="no square grid"):
        features.random_flip(df).collect()  # 3072 is no square
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert features.random_crop(none).first().embedding is None


def test_gather_equals_allreduce(spark):
    df = vec(spark)
    laid = sample.assign_shards(sample.with_positions(
        df, [sample.hash_order_key("vec_id"), F.col("vec_id")]), 4)
    sg = gradients.shard_gradients(laid.withColumn("x", features.as_double("embedding")),
                                   model.fit_centroids(df), feat="x")
    a = {(r.k, r.j): r.g for r in gradients.mean_gradients(sg, "gather").collect()}
    b = {(r.k, r.j): r.g for r in gradients.mean_gradients(sg, "allreduce", 4).collect()}
    assert a.keys() == b.keys() and len(a) == 650
    assert max(abs(a[k] - b[k]) for k in a) < 1e-15


def test_evaluate_batches_and_accuracy(spark):
    tr, te = train.split(vec(spark))
    p = model.fit_centroids(tr)
    ev = train.evaluate(te, p, batch_size=32).first()
    rows = model.with_prediction(model.with_loss(model.scores(te, p))).orderBy("vec_id").collect()
    losses = [r.loss for r in rows]
    batches = [losses[i:i + 32] for i in range(0, len(losses), 32)]
    assert abs(ev.test_loss - np.mean([np.mean(b) for b in batches])) < 1e-12
    assert ev.total == len(rows) == 100
    assert ev.correct == sum(r.pred == r.label for r in rows)
    assert abs(ev.accuracy - 100.0 * ev.correct / ev.total) < 1e-12


def test_train_and_evaluate_runs_epochs(spark):
    res, ev = train.train_and_evaluate(vec(spark), epochs=2, order=train.seeded_order())
    assert res.steps.count() == 2 * math.ceil(400 / 256)
    e = ev.first()
    assert e.total == 100 and 0 <= e.correct <= 100 and math.isfinite(e.test_loss)


def test_step_log_roundtrip_with_reference_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "steps.csv")
    with open(path, "w") as fh:
        fh.write(steplog.REFERENCE_HEADER + "\n0,1,1.5\n0,2,1.25\n0,3,1.0\n0,4,0.5\n")
    log = steplog.read_step_log(spark, path)
    s = steps.summarise_steps(log).first()
    assert (s.n, s.total, s.first, s.last) == (4, 4.25, 1.5, 0.5)
    assert abs(s.mean_mid - 1.125) < 1e-12 and abs(s.median - 1.125) < 1e-12
    out = os.path.join(tmp_dir, "out")
    steplog.write_step_log(log, out)
    for name in os.listdir(out):
        if name.startswith("part-"):
            with open(os.path.join(out, name)) as fh:
                assert fh.readline().rstrip("\n") == steplog.REFERENCE_HEADER
    assert sorted(map(tuple, steplog.read_step_log(spark, out).collect())) == \
        sorted(map(tuple, log.collect()))


def test_every_nth(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "step")
    assert [r.step for r in sample.every_nth(df, "step", 20).orderBy("step").collect()] == \
        [0, 20, 40, 60, 80]


def test_step_reads_are_pruned(spark, tmp_dir):
    laid = train.layout_epoch(vec(spark).withColumn("x", features.as_double("embedding"))
                              .select("vec_id", "label", "x"), 1, 64,
                              train.fixture_order()(0))
    staged = train.stage_epoch(laid.select("batch_id", "shard", "label", "x"),
                               os.path.join(tmp_dir, "epoch"), 2)
    rows = train.step_rows(staged, 5, 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan and "= 2)]" in plan
    assert "EqualTo(batch_id,5)" in plan
    assert rows.count() == 64
    assert staged.count() == 500


@pytest.mark.parametrize("n_shards", [1, 64])
def test_the_driver_gets_one_model(spark, n_shards):
    df = vec(spark).withColumn("shard", (F.col("vec_id") % n_shards).cast("int"))
    p = model.Params(np.full((10, 64), 0.01), np.zeros(10))
    assert gradients.step_sums(df, p).count() == 10 * 65 + 1
    grad, loss = gradients.collect_step(df, p, n_shards)
    rows = df.collect()
    means, losses = np.zeros(650), []
    for s in range(n_shards):
        own = [r for r in rows if r.shard == s]
        x, y = np.array([r.embedding for r in own], float), np.array([r.label for r in own])
        z = np.exp(x @ p.w.T + p.b)
        z /= z.sum(axis=1, keepdims=True)
        losses.append(-np.log(z[np.arange(len(y)), y]).mean())
        z[np.arange(len(y)), y] -= 1
        means += (z.T @ np.c_[x, np.ones(len(x))] / len(y)).ravel() / n_shards
    assert np.allclose(grad, means, atol=1e-12) and abs(loss - np.mean(losses)) < 1e-12
    _, none = gradients.collect_step(df.limit(0), p, n_shards)
    assert math.isnan(none)


def scratch_folders(spark):
    from rankgrad.session import ensure_checkpoint_dir
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)}


def test_training_and_splits_leave_only_live_tables(spark):
    from rankgrad.session import release
    before = scratch_folders(spark)
    res = train.train_softmax(vec(spark), batch_size=256)
    assert {n.rsplit("-", 1)[0] for n in scratch_folders(spark) - before} == {"live-steps"}
    assert res.steps.count() == 2 and release(res.losses) == 1
    split = sample.balanced_split(vec(spark).select("vec_id"), 3, [F.col("vec_id")])
    assert {n.rsplit("-", 1)[0] for n in scratch_folders(spark) - before} == {"live-positions"}
    assert split.count() == 500 and release(split) == 1
    assert scratch_folders(spark) == before


class Stop(Exception):
    pass


def broken_at(monkeypatch, step):
    """Training that dies in its ``step``-th gradient."""
    real, seen = train.collect_step, []

    def failing(*args, **kw):
        seen.append(1)
        if len(seen) == step:
            raise Stop
        return real(*args, **kw)

    monkeypatch.setattr(train, "collect_step", failing)
    return real


def test_a_failed_run_keeps_its_log_and_goes_on(spark, tmp_dir, monkeypatch):
    how = dict(batch_size=50, epochs=2, order=train.seeded_order("vec_id", 5), log_every=4)  # 10 steps an epoch
    want = train.train_softmax(vec(spark), **how)
    real = broken_at(monkeypatch, 17)  # in the second block of the second epoch
    with pytest.raises(Stop):
        train.train_softmax(vec(spark), save_dir=f"{tmp_dir}/run", log_path=f"{tmp_dir}/log", **how)
    kept = steplog.read_step_log(spark, f"{tmp_dir}/log")
    assert sorted((r.epoch, r.iteration) for r in kept.collect()) == [(0, k) for k in range(1, 11)] + [(1, k) for k in range(1, 5)]
    monkeypatch.setattr(train, "collect_step", calls := lambda *a, **kw: (done.append(1), real(*a, **kw))[1])
    done = []
    got = train.train_softmax(vec(spark), save_dir=f"{tmp_dir}/run", log_path=f"{tmp_dir}/log", resume=True, **how)
    assert calls and len(done) == 6  # steps 5 to 10 of the second epoch
    assert np.allclose(got.params.flat(), want.params.flat(), atol=1e-12)
    key = ["epoch", "step"]
    a, b = ([(r.epoch, r.step, round(r.loss, 12)) for r in x.losses.orderBy(*key).collect()] for x in (got, want))
    assert a == b and len(a) == 20
    assert steplog.read_step_log(spark, f"{tmp_dir}/log").count() == 20
    # a finished run gives its answer again, and goes on for more epochs
    done.clear()
    again = train.train_softmax(vec(spark), save_dir=f"{tmp_dir}/run", resume=True, **how)
    assert not done and np.array_equal(again.params.flat(), got.params.flat())
    more = train.train_softmax(vec(spark), save_dir=f"{tmp_dir}/run", resume=True, **(how | {"epochs": 3}))
    assert len(done) == 10 and more.steps.count() == 30


def test_resume_compares_the_run(spark, tmp_dir):
    run = f"{tmp_dir}/run"
    train.train_softmax(vec(spark), save_dir=run)
    with pytest.raises(ValueError, match="another run"):
        train.train_softmax(vec(spark), save_dir=run)
    for other in ({"lr": 0.2}, {"shards": 2}, {"order": train.seeded_order("vec_id", 9)}):
        with pytest.raises(ValueError, match="cannot resume"):
            train.train_softmax(vec(spark), save_dir=run, resume=True, **other)
    with pytest.raises(ValueError, match="data"):
        train.train_softmax(vec(spark).limit(300), save_dir=run, resume=True)
    with pytest.raises(ValueError, match="needs save_dir"):
        train.train_softmax(vec(spark), resume=True)
    with pytest.raises(ValueError, match="no run record"):
        train.train_softmax(vec(spark), save_dir=f"{tmp_dir}/none", resume=True)


def test_small_steps_run_a_block_a_job(spark, monkeypatch):
    """A long epoch of small steps costs a job a block of the log, not one a step, and gives the same."""
    big = vectors.read_vectors(spark, f"{SF01.replace('0.01', '0.1')}/embeddings.parquet")
    for shards, batch in ((1, 60), (3, 20)):
        how = dict(shards=shards, batch_size=batch, order=train.fixture_order(), block_rows=500)
        jobs, real = [], train.collect_step
        monkeypatch.setattr(train, "collect_step", lambda *a, **kw: (jobs.append(1), real(*a, **kw))[1])
        got = train.train_softmax(big, **how)
        few = len(jobs)
        monkeypatch.setattr(train, "RUN_STEP_ROWS", 0)
        want = train.train_softmax(big, **how)
        assert few < 20 and len(jobs) - few == want.steps.count() > 30
        assert np.allclose(got.params.flat(), want.params.flat(), atol=1e-12)
        a, b = ([(r.epoch, r.step, round(r.loss, 10)) for r in x.losses.orderBy("step").collect()] for x in (got, want))
        assert a == b and got.steps.where("elapsed > 0").count() == len(a)
        monkeypatch.undo()
