"""Text sources and the rank sink.

Folders are listed by Spark's file index on the input path itself (no
driver-side directory walk); files whose names start with ``.`` or ``_``
are hidden and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import drop_comments, parse_edges

LINK_FILE_GLOB = "link*"  # fixed value: link files are named link...


def read_lines(spark: SparkSession, path: str | list[str],
               name_glob: str | None = None) -> DataFrame:
    """Lines of one or more text files or folders as ``value`` STRING."""
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.text(paths)


def read_link_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All ``link*`` entries of the folder(s), as one union of lines.

    The name pattern applies to the folder's entries, so both plain files
    ``link-001`` and Spark-written folders ``link_a/part-*`` are read; names
    starting with ``.`` never match, and ``other`` does not.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text([f"{p.rstrip('/')}/{LINK_FILE_GLOB}" for p in paths])


def edges_from_text(spark: SparkSession, path: str | list[str],
                    comment_mode: str = "prefix", parse_mode: str = "first_two",
                    name_glob: str | None = None) -> DataFrame:
    """Edge-list text -> ``(src, dst)``: comments dropped, fields split."""
    return edges_from_lines(read_lines(spark, path, name_glob), comment_mode, parse_mode)


def edges_from_lines(lines: DataFrame, comment_mode: str = "prefix",
                     parse_mode: str = "first_two") -> DataFrame:
    return parse_edges(drop_comments(lines, comment_mode), parse_mode)


def _python_string(c: Column) -> Column:
    """A string as Python prints it in a tuple: quotes chosen, escapes written."""
    q, d, back = "'", '"', "\\"
    text = F.replace(c, F.lit(back), F.lit(back * 2))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    single = c.contains(q)
    return F.when(single & ~c.contains(d), F.concat(F.lit(d), text, F.lit(d))) \
        .otherwise(F.concat(F.lit(q), F.replace(text, F.lit(q), F.lit(back + q)), F.lit(q)))


def _python_float(c: Column) -> Column:
    """A double as Python prints it: plain digits for exponents from -4 to 15."""
    shown = c.cast("string")
    digits, power = F.split(shown, "E").getItem(0), F.split(shown, "E")
    exponent = F.get(power, F.lit(1)).cast("int")
    plain = F.regexp_replace(F.regexp_replace(c.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    tail = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    long_tail = F.when(F.abs(exponent) > 99, F.concat(F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent).cast("string"))).otherwise(tail)
    return F.when(F.isnan(c), "nan").when(F.abs(c) == float("inf"), F.when(c > 0, "inf").otherwise("-inf")) \
        .when(exponent.isNull(), shown) \
        .when((exponent >= -4) & (exponent < 16), plain) \
        .otherwise(F.concat(F.regexp_replace(digits, r"\.0$", ""), F.lit("e"), long_tail))


def rank_lines(ranks: DataFrame) -> DataFrame:
    """Ranks as text lines, printed the way the reference's sink prints them:
    ``('node', rank)`` (node keys as strings, Python float digits)."""
    return ranks.select(F.concat(F.lit("("), _python_string(F.col("node").cast("string")), F.lit(", "),
                                 _python_float(F.col("rank")), F.lit(")")).alias("value"))


def write_ranks(ranks: DataFrame, path: str, single_file: bool = False,
                fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write ranks; fails if the target exists unless ``mode`` says otherwise.

    ``single_file`` coalesces to one part (only for small outputs: it funnels
    everything through one task); the default writes in parallel.
    """
    out = rank_lines(ranks) if fmt == "text" else ranks
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_rank_lines(spark: SparkSession, path: str) -> DataFrame:
    """Parse ``('node', rank)`` lines back into ``(node STRING, rank DOUBLE)``."""
    line, pattern, mark = F.col("value"), r"""(?s)^\((['"])(.*)\1, ([^,']+)\)$""", "\0"
    node = F.replace(F.regexp_extract(line, pattern, 2), F.lit("\\\\"), F.lit(mark))
    for raw, shown in (("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\\", mark)):
        node = F.replace(node, F.lit(shown), F.lit(raw))
    return spark.read.text(path).select(node.alias("node"), F.regexp_extract(line, pattern, 3).cast("double").alias("rank"))
