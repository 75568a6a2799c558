"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..session import drop_path, live_table

#: Characters that separate words in texts as written (ASCII, neither letters nor digits).
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: bytes.translate table: lower-cases A-Z, maps every other ASCII separator to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
             for c in range(256))
#: bytes.translate table: lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows whose texts a task holds as Python values at a time.
SLICE = 1000
#: The session's setting for the rows that a Python worker is sent at a time.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The session's setting for the rows that the Parquet reader holds at a time.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
#: Bits of the table of wanted rows.
MARKS = 1 << 23


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """What runs within has these session settings."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs within sends Python workers ``SLICE`` rows at a time at most, and reads as many at a time.

    A batch lies in memory four times over, outside the JVM's heap and in the worker, as it
    was sent and as it comes back; of whole texts, Spark's 10,000 rows are far more than the
    work itself takes. So are the 4,096 that its Parquet reader holds, in arrays that the
    heap has to grow for.
    """
    with settings(spark, {k: str(SLICE) for k in (BATCH_ROWS, READ_ROWS) if not 0 < int(spark.conf.get(k)) <= SLICE}):
        yield


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder (cuts the lineage), freed by ``session.release``."""
    with small_batches(df.sparkSession):
        return live_table(df, name)


class Scratch(session.Scratch):
    """Tables of one operator's run in the shared folder, deleted when the run ends.

    What is to outlive the run is written with ``saved``.
    """

    def save(self, df: DataFrame, name: str) -> DataFrame:
        with small_batches(self.spark):
            return super().save(df, name)

    def replace(self, old: DataFrame, df: DataFrame, name: str) -> DataFrame:
        """Like ``save``, then deletes the table ``old`` that ``df`` was made from."""
        new, files = self.save(df, name), old.inputFiles()
        if files:
            drop_path(self.spark, files[0].rsplit("/", 1)[0])
        return new


def shuffle_parts(spark: SparkSession) -> int:
    """The session's partitions for a shuffle by key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_case(c) -> F.Column:
    """A-Z to a-z and nothing else (``lower`` would also change other letters)."""
    ascii_only = F.length(c) == F.octet_length(c)
    upper, low = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, upper, low))


def raw_words(text) -> F.Column:
    """Words of a text, case as written; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), RAW_SEPARATORS), "")


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def marked(rows: DataFrame, wanted: DataFrame, key: str | list[str] = "doc", others: bool = False) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is in ``wanted``, and a few more, told without a shuffle of ``rows``.

    With ``others``, all that are left out. By a table of ``MARKS`` bits that goes to every task, for a join that drops the few
    more: when the table fills up with what is wanted, that join is sent more rows.
    """
    slot = F.pmod(F.xxhash64(*([key] if isinstance(key, str) else key)), F.lit(MARKS))
    word, bit = F.shiftright(slot, 6).alias("mark_word"), slot.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = wanted.select(word, one.alias("one")).groupBy("mark_word").agg(F.bit_or("one").alias("mark_bits"))
    found = rows.select("*", word).join(F.broadcast(bits), "mark_word", "left" if others else "inner")
    return found.where(F.coalesce(F.getbit("mark_bits", bit), F.lit(0)) == (0 if others else 1)).select(*rows.columns)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is null or not in ``gone``; only those that ``marked`` takes for gone are shuffled."""
    # not an anti-join, which would be made before the marks are looked at
    known = gone.select(key, F.lit(True).alias("is_gone"))
    suspects = marked(rows, gone, key).join(known, key, "left").where("is_gone is null").select(*rows.columns)
    return marked(rows, gone, key, others=True).unionByName(suspects)


def add_columns(df: DataFrame, inputs: list[str], fields: list[tuple[str, T.DataType]],
                make: Callable[..., list[pa.Array]]) -> DataFrame:
    """``df`` with columns that ``make`` computes from ``inputs``, batch by batch.

    ``make`` is a factory called once per task; it returns a function from the
    input arrays to one list of values per field. Columns of ``df`` that have a
    name of ``fields`` are replaced.
    """
    names = [n for n in df.columns if n not in {n for n, _ in fields}]
    hidden = [n for n in df.columns if n in inputs and n not in names]
    src = df.select(*[df[n].alias(f"c{i}") for i, n in enumerate([*names, *hidden])])
    place = {n: i for i, n in enumerate([*names, *hidden])}
    at = [place[n] for n in inputs]
    extra = T.StructType([T.StructField(f"x{i}", t) for i, (_, t) in enumerate(fields)])
    keep = len(names)
    schema = T.StructType(src.schema.fields[:keep] + extra.fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(extra)]
        compute = make()
        for batch in (b.slice(lo, SLICE) for b in batches for lo in range(0, b.num_rows, SLICE)):
            made = compute(*[batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(keep)]
                + [pa.array(v, type=t) for v, t in zip(made, types, strict=True)],
                names=[f.name for f in schema.fields])

    out = src.mapInArrow(run, schema)
    return out.toDF(*names, *[n for n, _ in fields])


def per_group(df: DataFrame, keys: tuple[str, str], schema: T.StructType,
              make: Callable[[], Callable[..., list[tuple]]]) -> DataFrame:
    """Rows that a function gives for each group of ``df`` by two long ``keys``.

    For many small groups: they are sorted within partitions and streamed, so a
    group costs no call of its own between the JVM and Python. ``make`` is a
    factory called once per task; its function takes the group's columns as Arrow
    arrays and returns rows. A group must fit in memory.
    """
    first, second = (df.columns.index(k) for k in keys)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, compute, rows, held = to_arrow_schema(schema), make(), [], None

        def closed(group: list[pa.RecordBatch]):
            columns = [pa.concat_arrays([b.column(i) for b in group]) if len(group) > 1 else group[0].column(i)
                       for i in range(group[0].num_columns)]
            rows.extend(compute(*columns))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), kinds)], names=kinds.names)

        for b in batches:
            if not b.num_rows:
                continue
            a, c = b.column(first).to_numpy(), b.column(second).to_numpy()
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
            for lo, hi in zip(starts, [*starts[1:], b.num_rows]):
                key = (a[lo], c[lo])
                if held and held[0] != key:
                    closed(held[1])
                    held = None
                if held:
                    held[1].append(b.slice(lo, hi - lo))
                else:
                    held = (key, [b.slice(lo, hi - lo)])
                if len(rows) >= 10_000:
                    yield batch()
                    rows.clear()
        if held:
            closed(held[1])
        if rows:
            yield batch()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
