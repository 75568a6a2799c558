"""Benchmark decontamination by a positional inverted index, with DataFrame functions only.

``build_index`` stores the postings (document row, position) of every training token
that is a term of the test set. ``phrase_matches`` takes, for each test window, the
posting list of its rarest term, intersects it with the offset-adjusted lists of the
next rarest ones, and compares what is left with the whole item; ``proximity_matches``
finds the places where all terms of an item stand near its rarest one.

Postings are never grouped by term, so a frequent term's list lies in many tasks. The
test set's own tables are broadcast only up to ``MAX_BROADCAST_TERMS`` rows; beyond,
the same joins shuffle.

Defined results: null and empty texts have no words, no hits and the digest of an
empty list; documents with null or repeated ids are rows of their own; items with a
null id mark words as hit but aren't named; items without words match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fold_case, marked, raw_words, saved, without

WINDOW = 13
LISTS = 3
MAX_BROADCAST_TERMS = 1_000_000


@dataclass
class Index:
    """``documents`` (row_id, doc_id, n_words), ``postings`` (row_id, pos, term) and the test set's ``tokens``."""

    documents: DataFrame
    postings: DataFrame
    tokens: DataFrame  # item, item_id, n, off, term
    small: bool  # whether the test set's tables may be broadcast
    scratch: Scratch

    def hint(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df


def build_index(docs: DataFrame, items: DataFrame, scratch: Scratch) -> Index:
    """Postings of the terms of ``items`` (item_id, text) in ``docs`` (doc_id, text), stored in ``scratch``."""
    worded = scratch.save(items.select("item_id", F.transform(raw_words(F.col("text")), fold_case).alias("words"))
                   .withColumn("item", F.monotonically_increasing_id()), "items")
    spelt = worded.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("off", "word"))
    small = (worded.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]) <= MAX_BROADCAST_TERMS
    vocabulary = scratch.save(spelt.select("word").distinct().select("word", (F.monotonically_increasing_id() + 1).alias("term")), "terms")
    near = F.broadcast if small else (lambda df: df)
    tokens = scratch.save(spelt.join(near(vocabulary), "word").drop("word"), "tokens")
    # an empty word, term 0, leads every document; its posting carries the number of words
    lead = vocabulary.sparkSession.createDataFrame([("", 0)], "word string, term long")
    rows = (docs.select("doc_id", F.concat(F.array(F.lit("")), raw_words(F.col("text"))).alias("words"))
            .withColumn("row_id", F.monotonically_increasing_id())
            .select("row_id", "doc_id", F.size("words").alias("size"), F.posexplode("words").alias("at", "word")))
    folded = rows.withColumn("word", fold_case(F.col("word")))
    stored = scratch.save(folded.join(near(vocabulary.union(lead)), "word").select(
        "row_id", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id"), "term",
        F.when(F.col("term") == 0, F.col("size") - 1).otherwise(F.col("at") - 1).alias("pos")), "postings")
    return Index(stored.where("term = 0").select("row_id", "doc_id", F.col("pos").alias("n_words")),
                 stored.where("term > 0").select("row_id", "pos", "term"), tokens, small, scratch)


def rarest(index: Index, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """Per window: item, start, and its ``lists`` rarest tokens as an array of (rows, off, term)."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("rows"))
    known = index.tokens.join(counts, "term", "left").fillna(0, ["rows"])
    length = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(F.greatest(F.col("off") - length + 1, F.lit(0)), F.least(F.col("off"), F.col("n") - length))
    return (known.withColumn("start", F.explode(starts)).groupBy("item", "start")
            .agg(F.sort_array(F.collect_list(F.struct("rows", "off", "term"))).alias("by_rarity"))  # at most a window's tokens
            .where(F.get("by_rarity", F.lit(0))["rows"] > 0)  # a term that no document has: no match
            .select("item", "start", F.slice("by_rarity", 1, lists).alias("rare")))


def phrase_matches(index: Index, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """Runs of item words that stand in a document: row_id, item, item_id, first, last (document positions).

    A run has at least ``window`` words, or is the whole of a shorter item.
    """
    windows = index.scratch.save(rarest(index, window, lists), "windows")
    rare = windows.select("item", "start", F.posexplode("rare").alias("nth", "r")).select("item", "start", "nth", "r.off", "r.term")
    listed = index.postings.join(index.hint(rare.select("term").distinct()), "term", "left_semi")

    def windows_of(n):
        return index.hint(rare.where(F.col("nth") == n).drop("nth"))

    found = (listed.join(windows_of(0), "term")
             .select("row_id", "item", "start", (F.col("pos") - F.col("off")).alias("shift")).where("shift + start >= 0"))
    for n in range(1, lists):
        # offset-adjusted: the next rarest term must stand at its place; short windows have fewer lists
        asked = found.join(index.hint(rare.where(F.col("nth") == n).select("item", "start", "off", "term")), ["item", "start"], "left")
        theirs = listed.select(F.col("row_id").alias("r"), F.col("pos").alias("p"), F.col("term").alias("t"))
        ask = asked.where("term is not null").join(
            theirs, (F.col("row_id") == F.col("r")) & (F.col("shift") + F.col("off") == F.col("p")) & (F.col("term") == F.col("t")), "left_semi")
        short = asked.where("term is null")
        found = ask.unionByName(short).select("row_id", "item", "start", "shift")
    aligned = index.scratch.save(found.select("row_id", "item", "shift").distinct(), "aligned")
    every = index.tokens.select("item", "item_id", "n", "off", "term")
    asked = aligned.join(index.hint(every), "item").withColumn("pos", F.col("shift") + F.col("off"))
    # few documents have an aligned item: the postings of the others stay where they are
    same = asked.join(marked(index.postings, aligned, "row_id"), ["row_id", "pos", "term"], "left_semi")
    one = Window.partitionBy("row_id", "item", "shift").orderBy("off")  # at most an item's words
    runs = (same.withColumn("run", F.col("off") - F.row_number().over(one))
            .groupBy("row_id", "item", "item_id", "n", "shift", "run")
            .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
            .where(F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("n"))))
    return runs.select("row_id", "item", "item_id", "first", "last")


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """Places of an item's rarest term with all its other terms within ``slop`` words: row_id, item, item_id, pos."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("rows"))
    terms = index.scratch.save(index.tokens.groupBy("item", "term").agg(F.first("item_id").alias("item_id")).join(counts, "term", "left").fillna(0, ["rows"]), "near")
    lead = terms.groupBy("item", "item_id").agg(F.min(F.struct("rows", "term")).alias("least"), F.count("*").alias("terms")).where("least.rows > 0")
    anchors = index.postings.join(index.hint(lead.select("item", "item_id", "terms", F.col("least.term").alias("term"))), "term")
    reach = slop + 1
    wanted = (anchors.select("row_id", "item", "item_id", "terms", "pos").join(index.hint(terms.select("item", "term")), "item")
              .withColumn("cell", F.explode(F.sequence(((F.col("pos") - slop) / reach).cast("int") - 1, ((F.col("pos") + slop) / reach).cast("int")))))
    placed = index.postings.select("row_id", "term", F.col("pos").alias("at"), F.floor(F.col("pos") / reach).cast("int").alias("cell"))
    near = wanted.join(placed, ["row_id", "term", "cell"]).where(F.abs(F.col("at") - F.col("pos")) <= slop)
    return (near.groupBy("row_id", "item", "item_id", "pos", "terms").agg(F.countDistinct("term").alias("found"))
            .where("found = terms").select("row_id", "item", "item_id", "pos"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    with Scratch(docs.sparkSession, "index") as scratch:
        return saved(_verdicts(build_index(docs, items, scratch)), "index-verdicts")


def _verdicts(index: Index) -> DataFrame:
    runs = index.scratch.save(phrase_matches(index), "runs")
    before = Window.partitionBy("row_id").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("first"), F.coalesce(F.max("last").over(before) + 1, F.col("first")))
    hit = (runs.select("row_id", "first", "last").distinct()
           .withColumn("words", F.greatest(F.col("last") - new + 1, F.lit(0)))
           .groupBy("row_id").agg(F.sum("words").alias("n_hit")))
    named = (runs.where("item_id is not null").select("row_id", F.col("item_id").cast("string").alias("name")).distinct()
             .groupBy("row_id").agg(F.sort_array(F.collect_list("name")).alias("names")))  # at most the test set's items
    out = index.documents.join(hit, "row_id", "left").join(named, "row_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark's windows."""
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops contaminated rows; columns unchanged.

    A verdict depends on the text alone, so rows go by their text's digest,
    whatever their ids.
    """
    digest = F.unhex(F.sha2("text", 256))
    verdicts = decontaminate(docs.select(digest.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    bad = verdicts.where("contaminated").select(F.col("doc_id").alias("digest")).distinct()
    row = docs.select(F.struct(*docs.columns).alias("row"), digest.alias("digest"))
    return without(row, bad, "digest").select("row.*")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
v AS (SELECT item_id, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s, w FROM i WHERE len(w) > 0),
g AS (SELECT item_id, n, w[s:s + n - 1] AS words, w[s] AS head FROM v),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
h AS (SELECT p.doc_id, g.item_id, p.pos, g.n FROM p JOIN g ON p.word = g.head JOIN d ON d.doc_id = p.doc_id
      WHERE d.w[p.pos:p.pos + g.n - 1] = g.words),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS x FROM h) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
