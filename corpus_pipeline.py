"""The corpus pipeline: quality rules, language ID, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; ``run``
writes every stage as a table in the shared folder and gives the next one that
table. No stage drops rows for its own convenience: only rejected documents,
and all but one of a near-duplicate group, go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankgrad.llm import language_id, minmax_dedup, packing, positional_index, quality_rules
from rankgrad.llm.common import Scratch, saved
from rankgrad.session import release

STAGES = [
    ("quality_rules", quality_rules.quality_stage),
    ("language_id", language_id.language_stage),
    ("near_dedup", minmax_dedup.dedup_stage),
    ("decontamination", positional_index.decontamination_stage),
    ("packing", packing.packing_stage),
]
#: Learned verdicts have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows.

    A stage's table, and what its operator kept for it, go once the next one is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for k, (name, stage) in enumerate(STAGES):
            made = stage(spark, docs, sf_dir)
            if k == len(STAGES) - 1:
                out = saved(made, f"pipeline-{name}")
                release(made)
                return out
            docs = scratch.replace(docs, made, name) if k else scratch.save(made, name)
            release(made)
