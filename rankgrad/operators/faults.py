"""Failures on purpose, to see that a job survives the loss of work.

Needs a session that tries a task again (``local[4,3]``, or any cluster).
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame


def fail_first(df: DataFrame, partitions: tuple[int, ...] = (0,), attempts: int = 1) -> DataFrame:
    """``df``, but tasks of ``partitions`` fail in their first ``attempts`` attempts, after a batch of rows."""
    def run(batches):
        context = TaskContext.get()
        broken = context.partitionId() in partitions and context.attemptNumber() < attempts
        for batch in batches:
            yield batch
            if broken:
                raise RuntimeError(f"failure on purpose: partition {context.partitionId()}, attempt {context.attemptNumber()}")
        if broken:
            raise RuntimeError(f"failure on purpose: partition {context.partitionId()}, attempt {context.attemptNumber()}")

    return df.mapInArrow(run, df.schema)


def lose_cached_blocks(spark, every: int = 2) -> int:
    """Drop every ``every``-th block of each cached frame, as if its executor were gone; how many.

    Works on the driver's own block store, so in sessions of one process.
    """
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    store = jvm.org.apache.spark.SparkEnv.get().blockManager()
    lost = 0
    for number, rdd in context.getPersistentRDDs().items():
        for split in range(0, rdd.getNumPartitions(), every):
            block = jvm.org.apache.spark.storage.RDDBlockId(int(number), split)
            if store.getStatus(block).isDefined():
                store.removeBlock(block, True)
                lost += 1
    return lost
