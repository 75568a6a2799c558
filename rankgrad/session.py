"""Session helpers: building a local session for tests and benches, and
resolving the shared checkpoint folder the cluster names.

Library code never invents a storage location of its own: lineage is cut
and state is saved under ``spark.checkpoint.dir`` (or the folder already
set on the SparkContext). A session that names none gets a fresh folder only
if its master runs in one process (``local`` or ``local[...]``); on any
cluster the job stops with an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None,
                  app_name: str = "rankgrad") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        ensure_checkpoint_dir(spark, fallback=checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback=None) -> str:
    """Return the shared checkpoint folder, registering it on the context.

    Order: folder already set on the SparkContext, then the session setting
    ``spark.checkpoint.dir``, then ``fallback`` (a path, or a callable giving
    one; tests only), then a fresh folder of a one-process session. Raises on
    a cluster that names none, rather than writing to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    folder = configured or (fallback() if callable(fallback) else fallback)
    if not folder and one_process(sc.master):
        folder = tempfile.mkdtemp(prefix="rankgrad-ck-")
    if not folder:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a shared path")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def one_process(master: str) -> bool:
    """True for ``local``, ``local[4]``, ``local[*,2]``; not ``local-cluster``."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store through Spark's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)


def scratch_path(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written state."""
    base = ensure_checkpoint_dir(spark, fallback).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Written tables of the shared folder that have an owner, who frees them.

    As a context, all of them go when it ends; otherwise ``close`` or, for the one
    that a returned frame reads, ``release``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, scratch_path(spark, name), 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def path(self, name: str) -> str:
        """A fresh sub-folder."""
        self.count += 1
        return f"{self.root}/{self.count}-{name}"

    def save(self, df, name: str):
        """``df`` as a committed table (cuts the lineage)."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        drop_path(self.spark, self.root)


#: Name that marks tables which live as long as the frame that reads them.
LIVE = "live"


def live_table(df, name: str):
    """``df`` as a committed table of its own, which the frame's user frees with ``release``."""
    return Scratch(df.sparkSession, f"{LIVE}-{name}").save(df, "table")


def release(df) -> int:
    """Delete the live tables that ``df`` reads; how many. ``df`` can't be read afterwards."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/").split(":", 1)[-1].lstrip("/")
    roots = {m[1] for f in df.inputFiles() if (m := re.match(rf"(.*?{re.escape(base)}/{LIVE}-[^/]+)/", f))}
    for root in roots:
        drop_path(spark, root)
    return len(roots)
