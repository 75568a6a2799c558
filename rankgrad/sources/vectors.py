"""Labelled-vector source (the re-aimed image set)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VECTOR_SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
])


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(vec_id, embedding, label)`` from Parquet, with a fixed schema."""
    return spark.read.schema(VECTOR_SCHEMA).parquet(path)
