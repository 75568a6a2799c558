"""Incremental cleaning of link files arriving in a folder.

The reference reads bounded files only; its line cleaning is stateless, so
the same column expressions run unchanged on a Structured Streaming file
source. New ``link*`` files are picked up per trigger, cleaned, and appended
to a Parquet table; progress lives in the query's checkpoint location (a
shared folder), so a restarted query resumes where it stopped. Ranking
stays a batch job over the accumulated edge table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.clean import clean_links
from ..sources.text import LINK_FILE_GLOB


def link_line_stream(spark: SparkSession, folder: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` lines of the ``link*`` files of ``folder``."""
    reader = spark.readStream.format("text").option("pathGlobFilter", LINK_FILE_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def clean_link_stream(spark: SparkSession, folder: str,
                      category_mode: str = "faithful") -> DataFrame:
    """Streaming cleaned edges ``(src, dst)``."""
    return clean_links(link_line_stream(spark, folder), category_mode)


def append_edges(edges: DataFrame, out_path: str, checkpoint_location: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append cleaned edges to Parquet; ``available_now`` processes what is there and stops."""
    writer = edges.writeStream.format("parquet").outputMode("append") \
        .option("path", out_path).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()
