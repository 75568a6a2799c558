"""Best-fit packing of documents into fixed-size bins, under conflicts.

Two documents conflict if they have one source or one duplicate cluster; a bin
holds no two that conflict. Documents are placed longest first. Bins are ordered
by residual; each source and each cluster has a bitmap of the bins that hold it.
The search starts at the smallest residual that is large enough and goes on to
its successors until a residual has a bin that neither bitmap excludes: the
tightest compatible bin. If none is left, a new bin is opened.

A document longer than a bin gives full bins of its own, one after the other, and
a rest that is packed; so every word is placed. Documents are dealt by hash of
their id into packs of bounded size, and packed pack by pack, so no task sees
more than ``pack_rows`` of them (about).

Defined results: null and empty texts have no words and lie in no bin (``bin`` is
null, one piece of 0 words); a null source conflicts with none; null and repeated
ids are rows like others, and copies conflict by their cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FOLD, Scratch, add_columns, saved, utf8

CAPACITY = 2048


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every item, for items in placing order; a negative source or cluster conflicts with none."""
    at_residual: dict[int, int] = {}  # residual -> bitmap of its bins
    ordered = 0  # bitmap of the residuals that have bins
    of_source: dict[int, int] = {}
    of_cluster: dict[int, int] = {}
    bins, offsets, opened = [], [], 0
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        taken = (of_source.get(s, 0) if s >= 0 else 0) | (of_cluster.get(c, 0) if c >= 0 else 0)
        rest, chosen = ordered >> n, -1
        residual = n
        while rest:  # successors of n among the residuals in use
            step = (rest & -rest).bit_length() - 1
            residual += step
            free = at_residual[residual] & ~taken
            if free:
                chosen = (free & -free).bit_length() - 1
                break
            rest >>= step + 1
            residual += 1
        if chosen < 0:
            chosen, residual = opened, capacity
            opened += 1
        else:
            left = at_residual[residual] & ~(1 << chosen)
            at_residual[residual] = left
            if not left:
                ordered &= ~(1 << residual)
        bins.append(chosen)
        offsets.append(capacity - residual)
        now = residual - n
        if now > 0:
            at_residual[now] = at_residual.get(now, 0) | 1 << chosen
            ordered |= 1 << now
        if s >= 0:
            of_source[s] = of_source.get(s, 0) | 1 << chosen
        if c >= 0:
            of_cluster[c] = of_cluster.get(c, 0) | 1 << chosen
    return bins, offsets


def _measure():
    def words_and_cluster(column):
        import hashlib

        counts, keys = [], []
        for text in utf8(column):
            words = text.translate(FOLD).split() if text else []
            counts.append(len(text.split()) if text else 0)
            # documents of the same folded words are one cluster
            keys.append(int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True) if words else None)
        return [counts, keys]

    return words_and_cluster


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``cluster`` (hash of the folded words)."""
    return add_columns(docs, [text_col], [("n_words", T.LongType()), ("cluster", T.LongType())], _measure)


OUT = "doc_id long, source string, cluster long, n_words long, piece long, start long, length long, bin long, bin_offset long"


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Dense codes of a column's values, -1 for nulls."""
    return column.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()


def pack(items: DataFrame, capacity: int = CAPACITY, pack_rows: int = 4000) -> DataFrame:
    """Pieces with their bins, for ``items`` (doc_id, source, cluster, n_words), a stored table.

    ``piece`` numbers a document's pieces, ``start`` and ``length`` are in words;
    ``bin`` is unique over all packs: pack * 2^32 + number in the pack.
    """
    packs = max(1, -(-items.count() // pack_rows))
    # a hash of the whole row, and of its place, deals repeated ids evenly too
    dealt = items.withColumn("pack", F.pmod(F.xxhash64("doc_id", "cluster", "row_id"), F.lit(packs)))

    def place(table: pa.Table) -> pa.Table:
        # ids and clusters stay Arrow columns: as floats beside nulls they would be rounded
        table = table.sort_by([("doc_id", "ascending"), ("row_id", "ascending")]).combine_chunks()
        words = table["n_words"].to_numpy()
        full, rest = words // capacity, words % capacity
        base = table["pack"][0].as_py() << 32
        source, cluster = _codes(table["source"]), _codes(table["cluster"])
        order = np.lexsort((np.arange(len(words)), -rest))
        order = order[rest[order] > 0]
        bins, offsets = best_fit(rest[order].tolist(), source[order].tolist(), cluster[order].tolist(), capacity)
        many = np.repeat(np.arange(len(words)), full)
        number = np.arange(len(many)) - np.repeat(np.cumsum(full) - full, full)
        none = np.flatnonzero(words == 0)
        zero = np.zeros(len(none), np.int64)
        row = np.r_[order, many, none]
        piece = np.r_[full[order], number, zero]
        in_bin = np.r_[np.array(bins, np.int64), np.arange(len(many)) + (max(bins) + 1 if bins else 0), zero]
        offset = np.r_[np.array(offsets, np.int64), np.zeros(len(many), np.int64), zero]
        length = np.r_[rest[order], np.full(len(many), capacity), zero]
        kept = table.select(["doc_id", "source", "cluster", "n_words"]).take(pa.array(row))
        for name, values in (("piece", piece), ("start", piece * capacity), ("length", length)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        empty = length == 0
        return (kept.append_column("bin", pa.array(in_bin + base, pa.int64(), mask=empty))
                .append_column("bin_offset", pa.array(offset, pa.int64(), mask=empty)))

    return dealt.groupBy("pack").applyInArrow(place, OUT)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Bins for the whole texts of ``docs`` (doc_id, text, source)."""
    with Scratch(docs.sparkSession, "pack") as scratch:
        items = scratch.save(measured(docs.select("doc_id", "source", "text")).select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", "cluster", "n_words",
            F.monotonically_increasing_id().alias("row_id")), "items")
        return saved(pack(items, capacity), "packed")


def op9_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces and bins of 2048 words."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: bins for what is left of the corpus."""
    return pack_documents(docs)
