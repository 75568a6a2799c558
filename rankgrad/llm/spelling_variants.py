"""Spelling variants by a trie-node pair dictionary.

Every prefix of the vocabulary is a node of a forward trie and every suffix one of a
reversed trie; nodes are numbered. A word without its i-th letter is then the integer
pair (prefix node i, suffix node i + 1), and a word cut before its i-th letter the pair
(prefix node i, suffix node i). Words that share a pair with a skipped letter differ in
that letter alone (replaced); a skipped pair that equals another word's cut pair is that
word with one letter more (inserted, deleted). Pairs are exact, so no strings are
compared. Of a run of equal letters only the first counts as skipped for insertions, so
every near pair of words meets in exactly one pair.

Numbering needs no task that sees all words: they are sorted by range, each task numbers
the nodes of its own range, and only the paths between neighbouring ranges, one word
each, are compared to give a node that two ranges share the first one's number.

A pair's rows differ in one letter of an alphabet of 90, so a group has at most 91 rows,
whatever the data; a word's frequency is one number, added up before the shuffle.

Defined results: null and empty texts have no words; a null doc_id is written as an empty
string in the damage key; extra columns are ignored; no words give no rows. Letters are
those of ``LETTERS`` (its range holds the signs of multiplication and division too).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold_case, saved
from .conversation_repair import crc32_sql

LETTERS = "A-Za-z\\u00C0-\\u00FF"
#: Bits of a number that count within a partition.
LOCAL = 40


def damaged_words(docs: DataFrame, every: int = 31) -> DataFrame:
    """(word) per run of letters of ``docs`` (doc_id, text); one in ``every`` (doc, run) loses a letter."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(fold_case(F.col("text")), f"[^{LETTERS}]+")).alias("run")).where("run <> ''")
    size = F.length("run")
    at = (F.col("h") % size).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return (runs.where(size >= 7).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
            .select(F.when(F.col("h") % every == 0, without).otherwise(F.col("run")).alias("word")))


def vocabulary(words: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """(word, n) of words long and frequent enough."""
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def _numbered(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` sorted by ``key``, with the trie nodes of its prefixes (``out``, root first) and its part and place.

    A node is numbered (part, count); so is the row itself, in the order of ``key``.
    """
    names = [n for n in rows.columns if n != key]

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        base, rank, count, last, path = part << LOCAL, 0, 0, "", [0]
        for b in batches:
            paths, words = [], b.column(len(names)).to_pylist()
            for word in words:
                shared, most = 0, min(len(word), len(last))
                while shared < most and word[shared] == last[shared]:
                    shared += 1
                del path[shared + 1:]
                fresh = len(word) - shared
                path.extend(range(base + count + 1, base + count + fresh + 1))
                count += fresh
                paths.append(np.array(path, np.int64))
                last = word
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], b.column(len(names)), pa.array(paths, pa.list_(pa.int64())),
                 pa.array(np.full(len(words), part, np.int32)), pa.array(np.arange(rank, rank + len(words)) + base)],
                names=[*names, key, out, "part", "place"])
            rank += len(words)

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in [*names, key])
    return (rows.select(*names, key).repartitionByRange(key).sortWithinPartitions(key)
            .mapInArrow(run, f"{schema}, {out} array<long>, part int, place long"))


def shared_nodes(numbered: DataFrame, key: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of nodes that an earlier part has too (sorted), and the numbers they have there.

    One row for each part, its first and its last word, comes to the driver.
    """
    ends = numbered.groupBy("part").agg(F.min(F.struct("place", F.col(key).alias("word"))).alias("first"),
                                        F.max(F.struct("place", F.col(key).alias("word"), F.col(path).alias("path"))).alias("last"))
    same: dict[int, int] = {}
    before = None
    for r in ends.orderBy("part").collect():
        if before:
            shared, most = 0, min(len(r.first.word), len(before.word))
            while shared < most and r.first.word[shared] == before.word[shared]:
                shared += 1
            # the first word of a part has the numbers 1, 2, ... of it along its path
            for depth in range(1, shared + 1):
                known = before.path[depth]
                same[(r.part << LOCAL) + depth] = same.get(known, known)
        before = r.last
    names = np.array(sorted(same), np.int64)
    return names, np.array([same[n] for n in names.tolist()], np.int64)


def _renamed(nodes: np.ndarray, same: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    names, numbers = same
    if not len(names):
        return nodes
    at = np.minimum(np.searchsorted(names, nodes), len(names) - 1)
    return np.where(names[at] == nodes, numbers[at], nodes)


#: Kinds of a pair's rows: the word with a letter skipped, not or also the first of its run, and the word itself, cut.
SKIP, FIRST, CUT = 0, 1, 2


def _pairs(forward: tuple, backward: tuple):
    """Pairs of node numbers of each word: (p, s, kind, id, n)."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                b = batch.slice(lo, 2000)
                word, n = b.column(0).to_numpy(), b.column(1).to_numpy()
                starts = b.column(2).flatten(), b.column(3).flatten()
                size = pa.compute.list_value_length(b.column(2)).to_numpy()  # letters + 1 of each word
                fore, back = _renamed(starts[0].to_numpy(), forward), _renamed(starts[1].to_numpy(), backward)
                ends = np.cumsum(size)
                owner = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(owner)) - np.repeat(ends - size, size)  # letters before the cut
                # the reversed path counts from the word's end: the node of the suffix from ``place`` on
                suffix = back[np.repeat(ends, size) - 1 - place]
                skips = place < size[owner] - 1
                letters = np.fromiter(map(ord, "".join(x + "\0" for x in b.column(4).to_pylist())), np.int32, len(owner))
                first = np.r_[True, letters[1:] != letters[:-1]]  # the mark behind each word differs from every letter
                at = np.flatnonzero(skips)
                # behind a skipped letter stands the suffix node of the next place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[fore[at], fore]), pa.array(np.r_[suffix[at + 1], suffix]),
                     pa.array(np.r_[np.where(first[at], FIRST, SKIP), np.full(len(owner), CUT)].astype(np.int8)),
                     pa.array(word[np.r_[owner[at], owner]]), pa.array(n[np.r_[owner[at], owner]])],
                    names=["p", "s", "kind", "id", "n"])
    return run


def _neighbours(batches):
    """Per word of each pair: its near words by this pair, and the most frequent of them.

    Rows come sorted by pair; a group at a batch's end waits for the next one.
    """
    def found(p, s, kind, word, n):
        new = np.r_[True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        group, kind, word, n = group[many], kind[many], word[many], n[many]
        if not len(group):
            return None
        order = np.lexsort((word, -n, group))  # of equal counts the word that comes first
        group, kind, word, n = group[order], kind[order], word[order], n[order]
        total = int(group[-1]) + 1

        def best(rows):
            """Row of each group's best and, of those with two, second best among ``rows`` (-1: none)."""
            top, second = np.full(total, -1), np.full(total, -1)
            g = group[rows]
            lead = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
            top[g[lead]] = rows[lead]
            nth = np.flatnonzero(lead) + 1
            nth = nth[(nth < len(g))]
            nth = nth[~lead[nth]]
            second[g[nth]] = rows[nth]
            return top, second, np.bincount(g, minlength=total)

        skip, second, skips = best(np.flatnonzero(kind != CUT))
        fresh, _, inserts = best(np.flatnonzero(kind == FIRST))
        whole, _, wholes = best(np.flatnonzero(kind == CUT))
        rows = np.arange(len(group))
        cut, canon = kind == CUT, kind == FIRST
        near = np.where(cut, inserts[group], skips[group] - 1 + np.where(canon, wholes[group], 0))
        other = np.where(cut, fresh[group], np.where(skip[group] == rows, second[group], skip[group]))
        inner = np.where(canon, whole[group], -1)
        # rows of a group are in the order of preference, so the smaller row is the better one
        other = np.where((other < 0) | ((inner >= 0) & (inner < other)), np.where(inner >= 0, inner, other), other)
        keep = near > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(word[keep]), pa.array(near[keep]), pa.array(n[other[keep]]), pa.array(-word[other[keep]])],
            names=["id", "near", "n", "other"])

    rest = None
    for b in batches:
        columns = [c.to_numpy() for c in b.columns]
        if rest:
            columns = [np.concatenate(x) for x in zip(rest, columns)]
        p, s = columns[:2]
        if not len(p):
            continue
        changes = np.flatnonzero((p[1:] != p[:-1]) | (s[1:] != s[:-1]))
        end = int(changes[-1]) + 1 if len(changes) else 0
        rest = [c[end:] for c in columns]
        if end and (made := found(*[c[:end] for c in columns])):
            yield made
    if rest and (made := found(*rest)):
        yield made


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, word, n, n_near, best_n, best) of ``words`` (word, n); ids follow the order of the words."""
    forward = scratch.save(_numbered(words, "word", "fore"), "forward")
    same = shared_nodes(forward, "word", "fore")
    backward = scratch.save(_numbered(forward.select(F.col("place").alias("id"), "word", "n", "fore", F.reverse("word").alias("drow")),
                                      "drow", "back"), "backward")
    other = shared_nodes(backward, "drow", "back")
    pairs = backward.select("id", "n", "fore", "back", "word").mapInArrow(_pairs(same, other), "p long, s long, kind byte, id long, n long")
    met = (pairs.repartition("p", "s").sortWithinPartitions("p", "s").mapInArrow(_neighbours, "id long, near long, n long, other long")
           .groupBy("id").agg(F.sum("near").alias("n_near"), F.max(F.struct("n", "other")).alias("best")))
    return forward.select(F.col("place").alias("id"), "word", "n").join(met, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.n").alias("best_n"), (-F.col("best.other")).alias("best"))


def roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root): the end of each chain of ``links`` (id, form), by pointer doubling.

    Counts rise tenfold along a chain, so it is short and ends.
    """
    state = scratch.save(links.select("id", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while state.where("open").limit(1).count():
        ahead = state.select(F.col("id").alias("root"), F.col("root").alias("next"))
        state = scratch.replace(state, state.join(ahead, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "roots")
    return state.select("id", "root")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n).

    ``form``: the most frequent near word, if it is ``times`` as frequent or more.
    """
    with Scratch(words.sparkSession, "variants") as scratch:
        near = scratch.save(near_words(words, scratch), "near")
        formed = near.where(F.col("best_n") >= times * F.col("n")).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
        ends = roots(formed.select("id", "form"), scratch)
        name = near.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
        last = near.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
        told = formed.join(ends, "id").join(name, "form").join(last, "root").select("id", "form_word", "root_word", "form_n")
        return saved(near.join(told, "id", "left").select(
            "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"), "variants")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents, one in 31 of which loses a letter."""
    words = vocabulary(damaged_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return variants(words)


SQL = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
coded AS (SELECT *, {crc32_sql("(id || ':' || run)")}::BIGINT AS h FROM counted),
spelt AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM coded),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
skips AS (
    SELECT word, n, i, left(word, i) AS p, substr(word, i + 2) AS s
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM skips a JOIN skips b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM skips a JOIN words b ON a.p || a.s = b.word
    UNION
    SELECT b.word, a.word, a.n FROM skips a JOIN words b ON a.p || a.s = b.word),
best AS (
    SELECT word, count(*) AS n_near, min({{'m': -n, 'other': other}}) AS top FROM near GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.m >= 10 * w.n THEN top.other END AS form,
           CASE WHEN -top.m >= 10 * w.n THEN -top.m END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL
    SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, form, c.at AS root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
