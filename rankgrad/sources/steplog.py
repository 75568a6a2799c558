"""Step-log sink and source: CSV ``epoch, iteration, elapsed``.

The reference writes a header line (``Epoch, Iteration, Elpased_time``,
spaces and spelling as is) and one line per step. Files are read with an
explicit schema and the header skipped, so either spelling of the header
reads the same. A log that grows is a folder of blocks, each committed by its
own write (``StepLog``), so a run that fails leaves all blocks before.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

STEP_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType()),
    T.StructField("iteration", T.IntegerType()),
    T.StructField("elapsed", T.DoubleType()),
])

# fixed value: the header line the reference writes
REFERENCE_HEADER = "Epoch, Iteration, Elpased_time"


def write_step_log(df: DataFrame, path: str, mode: str = "errorifexists",
                   header: str = REFERENCE_HEADER) -> None:
    """Write the step log as CSV with a header row (one file per task).

    The header line defaults to the reference's, spaces and spelling kept;
    the rows are ``epoch,iteration,elapsed``.
    """
    names = header.split(",")
    df.select("epoch", "iteration", "elapsed").toDF(*names).write.mode(mode) \
        .option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)


def read_step_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a log written at once or block by block."""
    return spark.read.schema(STEP_SCHEMA).option("header", True) \
        .option("ignoreLeadingWhiteSpace", True).csv(path).select(*STEP_SCHEMA.names)


class StepLog:
    """A step log that grows: rows are held for one block, then written and committed.

    A block's folder is named by its epoch and first step, so a step that is run
    again after a failure replaces its block instead of doubling it. ``path`` gets
    Parquet with the losses; ``csv_path``, if given, the reference's CSV lines.
    """

    SCHEMA = T.StructType([*STEP_SCHEMA.fields, T.StructField("loss", T.DoubleType())])

    def __init__(self, spark: SparkSession, path: str, csv_path: str | None = None):
        self.spark, self.path, self.csv_path, self.rows = spark, path.rstrip("/"), csv_path, []

    def add(self, epoch: int, iteration: int, elapsed: float, loss: float) -> None:
        """One step; ``iteration`` counts from 1 within its epoch."""
        self.rows.append((epoch, iteration, elapsed, loss))

    def commit(self) -> None:
        """Write the held rows, all of one epoch, as a block."""
        if not self.rows:
            return
        block = f"block={self.rows[0][0]:06d}-{self.rows[0][1]:012d}"
        # Arrow columns: rows of Python values would take a Python worker to read back
        kinds = to_arrow_schema(self.SCHEMA)
        columns = [pa.array(c, type=f.type) for c, f in zip(zip(*self.rows), kinds)]
        rows = self.spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds), self.SCHEMA).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/{block}")
        if self.csv_path:
            write_step_log(rows, f"{self.csv_path.rstrip('/')}/{block}", mode="overwrite")
        self.rows = []

    def read(self) -> DataFrame:
        """``(epoch, iteration, elapsed, loss)`` of all committed blocks."""
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).select(*self.SCHEMA.names)
