"""Line cleaning as column expressions (no Python per row).

Fixed values that must equal the reference's behaviour: the field
separator is TAB; a comment line contains (or starts with) ``#``; a target
with ``:`` is dropped unless it starts with ``Category:``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
SEPARATOR = "\t"
COMMENT = "#"
NAMESPACE_MARK = ":"
CATEGORY_PREFIX = "Category:"


def drop_comments(df: DataFrame, mode: str = "anywhere", col: str = "value") -> DataFrame:
    """``anywhere``: drop lines holding ``#`` anywhere, and empty lines.
    ``prefix``: drop only lines that start with ``#``."""
    v = F.col(col)
    if mode == "anywhere":
        return df.filter(~v.contains(COMMENT) & (v != F.lit("")))
    if mode == "prefix":
        return df.filter(~v.startswith(COMMENT))
    raise ValueError(f"unknown comment mode {mode!r}")


def _fields(col: str) -> Column:
    # limit -1 keeps trailing empty fields, as str.split does
    return F.split(F.col(col), SEPARATOR, -1)


def field_count_is(n: int, col: str = "value") -> Column:
    return F.size(_fields(col)) == F.lit(n)


def parse_edges(df: DataFrame, mode: str = "first_two", col: str = "value") -> DataFrame:
    """Lines to ``(src, dst)`` strings.

    ``strict``: exactly two fields, anything else fails the job.
    ``first_two``: first two fields, the rest ignored; fewer than two fails.
    ``lenient``: lines without exactly two fields are dropped.
    """
    f = _fields(col)
    bad = F.concat(F.lit(f"malformed edge line ({mode}): "), F.col(col))
    if mode == "strict":
        ok = F.size(f) == 2
    elif mode == "first_two":
        ok = F.size(f) >= 2
    elif mode == "lenient":
        return df.filter(F.size(f) == 2).select(
            f.getItem(0).alias("src"), f.getItem(1).alias("dst"))
    else:
        raise ValueError(f"unknown parse mode {mode!r}")
    return df.select(
        F.when(ok, f.getItem(0)).otherwise(F.raise_error(bad)).alias("src"),
        F.when(ok, f.getItem(1)).otherwise(F.raise_error(bad)).alias("dst"))


def namespace_filter(edges: DataFrame, category_mode: str = "faithful") -> DataFrame:
    """Keep targets without ``:``, or starting with the category prefix.

    ``faithful`` tests ``Category:`` after the line was lower-cased, so the
    second branch never matches; ``intended`` tests ``category:``.
    """
    prefix = {"faithful": CATEGORY_PREFIX, "intended": CATEGORY_PREFIX.lower()}[category_mode]
    d = F.col("dst")
    return edges.filter(~d.contains(NAMESPACE_MARK) | d.startswith(prefix))


def clean_links(lines: DataFrame, category_mode: str = "faithful",
                col: str = "value") -> DataFrame:
    """Link-dump cleaning: lower-case, keep two-field lines, pair, filter."""
    lowered = lines.select(F.lower(F.col(col)).alias(col))
    return namespace_filter(parse_edges(lowered, "lenient", col), category_mode)


def union_sources(*dfs: DataFrame) -> DataFrame:
    """n-ary bag union (duplicates kept), matched by column name."""
    if not dfs:
        raise ValueError("union_sources needs at least one frame")
    return reduce(DataFrame.unionByName, dfs)
