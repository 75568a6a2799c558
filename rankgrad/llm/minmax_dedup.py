"""Near-duplicates by min-max hashing: bands of minima and maxima, confirmed on full sets.

A document's set is its distinct five-word shingles. Every permutation of the
shingle hashes gives two signature values, its minimum and its maximum, so half the
evaluations of plain minhash; bands of minima and bands of maxima propose pairs.

1. Rows of equal sets become one node, the row id of the row with the smallest id.
2. Nodes that share a band key form a bucket; each is compared with the bucket's
   smallest node, its pivot (a star, not all pairs), on full sets.
3. What the links connect gets one label. Nodes of buckets that still hold several
   labels are open. Two sets that are similar enough share one of the rarest shingles
   of each (of n shingles, the first n - ceil(t n) + 1 in any one order), so open nodes
   meet by these alone: boilerplate that very many documents have in common, which
   fills a bucket, is in nobody's rarest part. What rare shingles connect is a cluster,
   and only nodes of one cluster can be linked, so a bucket is divided by clusters. In
   each part, nodes outside the most frequent label are compared with all others by
   signature, in blocks, and each pair of likely enough signatures, once, on full sets.
   So every pair that shares a band is connected or compared.

The order of shingles is by a sketch of their frequency among the open nodes (a table of
fixed size that goes to every task), then by hash. Any order gives the same links; this
one keeps the groups small. A hot bucket, shingle, pivot or group of copies is split over
blocks, bounded in nodes and in shingles; nothing is capped.

Defined results: null and empty texts, and texts of blanks, have no shingles and link
with nothing; a null id links with nothing, has a null component and is kept; rows of
one repeated id are linked with each other. The pipeline's stage judges rows, not ids:
rows of a null id link like others, rows of one id only by their texts. A pair of similarity
0.85 shares no band with probability 5e-9, one of 0.8 with 5e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, Scratch, add_columns, marked, per_group, saved, small_batches, utf8, without

WORDS = 5
BANDS, ROWS = 40, 6
VALUES = BANDS * ROWS  # half of them minima, half maxima
BLOCK = 256  # nodes of a bucket that one task compares at a time
BLOCK_SHINGLES = 1 << 21  # and their shingles, about
WORDS_KNOWN = 1 << 16  # words whose hashes a task remembers (about 200 bytes each)
SLOTS = 1 << 18  # counters of the frequency sketch
_RNG = np.random.default_rng(20240229)
_ODD = lambda n: _RNG.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE, TIMES, PLUS, BAND = _ODD(WORDS), _ODD(VALUES // 2), _ODD(VALUES // 2), _ODD(ROWS)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the 64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct shingle hashes of whole texts; remembers hashes of words."""

    def __init__(self):
        import xxhash

        self.hash, self.known = xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.translate(LOWER).split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > WORDS_KNOWN:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = self.hash(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        total = np.zeros(n, np.uint64)
        for k in range(min(WORDS, len(h))):
            total += h[k:k + n] * PLACE[k]
        if len(h) < WORDS:
            total += np.uint64(len(h))
        return np.unique(_mix(total))


def signatures(sets: list[np.ndarray], block: int = 1 << 16) -> np.ndarray:
    """Minima, then maxima, of every permutation (rows: sets, none of them empty)."""
    out = np.empty((len(sets), VALUES), np.uint64)
    half, lo = VALUES // 2, 0
    while lo < len(sets):
        hi, held = lo, 0
        while hi < len(sets) and (hi == lo or held + len(sets[hi]) <= block):
            held += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *map(len, sets[lo:hi - 1])])
        for p in range(half):
            y = x * TIMES[p]
            y += PLUS[p]
            out[lo:hi, p] = np.minimum.reduceat(y, starts)
            out[lo:hi, half + p] = np.maximum.reduceat(y, starts)
        lo = hi
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (rows: sets)."""
    by_band = sig.reshape(len(sig), BANDS, ROWS) * BAND
    return _mix(by_band.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


LINK = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b")])
ASK = T.StructType([T.StructField(n, T.LongType()) for n in ("g1", "g2", "doc", "label")]
                   + [T.StructField("partners", T.ArrayType(T.LongType()))])
FIELDS = [("n_shingles", T.LongType()), ("same", T.BinaryType()), ("bands", T.ArrayType(T.LongType())), ("sketch", T.BinaryType())]


def _set_columns():
    shingles = Shingler()

    def run(column):
        counts, digests, bands, sketches = [], [], [], []
        texts = utf8(column)
        for lo in range(0, len(texts), 256):
            sets = [shingles(t) for t in texts[lo:lo + 256]]
            full = [s for s in sets if len(s)]
            sig = signatures(full)
            keys, low = iter(band_keys(sig).tolist()), iter((_mix(sig) >> np.uint64(56)).astype(np.uint8))
            for s in sets:
                counts.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(next(keys) if len(s) else None)
                sketches.append(next(low).tobytes() if len(s) else None)
        return [counts, digests, bands, sketches]

    return run


class Joined:
    """Union-find over the labels within one block."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        while (p := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(p, p)
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def confirmed(asks: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) among asked pairs, by the full sets.

    ``asks``: block columns g1, g2, then doc, label and partners (docs that have a row
    in the same block). Pairs whose labels are already joined in the block are skipped.
    """
    def make():
        shingles = Shingler()

        def check(g1, g2, docs, labels, partners, texts):
            sets, label_of, asked = {}, {}, {}
            for doc, label, others, text in zip(docs.to_pylist(), labels.to_pylist(), partners.to_pylist(), utf8(texts)):
                sets.setdefault(doc, []).append(shingles(text))
                label_of[doc] = label
                asked.setdefault(doc, set()).update(others or ())
            joined, out = Joined(), []
            for doc, others in asked.items():
                for other in others:
                    if joined.find(label_of[doc]) != joined.find(label_of[other]) and any(
                            similar(x, y, num, den) for x in sets[doc] for y in sets[other]):
                        joined.join(label_of[doc], label_of[other])
                        out.append((doc, other))
            return out

        return check

    rows = asks.join(texts, "doc").select("g1", "g2", "doc", "label", "partners", "text")
    return per_group(rows, ("g1", "g2"), LINK, make)


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """``den * intersection >= num * union`` of two sorted sets; empty ones are like nothing."""
    small, large = sorted((len(a), len(b)))
    if not small or den * small < num * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (small + large - both)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) is connected with.

    Takes the least label among the neighbours, then the label's own label, until
    nothing changes; all by partial aggregates, so a hub isn't gathered anywhere.
    """
    both = scratch.save(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        heard = (both.join(state.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
                 .agg(F.min("label").alias("least")))
        lower = state.select("node", "label").join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        # a label is a node too; what it had before is never above itself
        own = state.select(F.col("node").alias("label"), F.col("label").alias("next"))
        state = scratch.replace(state, lower.join(own, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        if not state.where("old <> label").limit(1).count():
            return state.select("node", "label")


def _star(pairs: DataFrame) -> DataFrame:
    """Asks of every node to its pivots (``pairs``: doc, n, pivot, distinct); a pivot's nodes are dealt into blocks."""
    blocks = pairs.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    asked = pairs.join(blocks, "pivot").select(
        F.col("pivot").alias("g1"), F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("g2"), "doc",
        F.col("doc").alias("label"), F.array("pivot").alias("partners"))
    own = blocks.select(F.col("pivot").alias("g1"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("g2"),
                        F.col("pivot").alias("doc"), F.col("pivot").alias("label"), F.array().cast("array<long>").alias("partners"))
    return asked.unionByName(own)


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def frequent(texts: DataFrame) -> np.ndarray:
    """Sketch of the shingles' frequency in ``texts`` (text): counts by slot, 0 where a task saw no more than usual."""
    def run(batches):
        shingles, counts, held, n = Shingler(), np.zeros(SLOTS, np.int64), [], 0
        for b in batches:
            for text in utf8(b.column(0)):
                held.append(_slots(shingles(text)))
                n += len(held[-1])
                if n >= SLOTS:
                    counts += np.bincount(np.concatenate(held), minlength=SLOTS)
                    held, n = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=SLOTS)
        heavy = np.flatnonzero(counts > 2 * counts.mean() + 4)
        yield pa.RecordBatch.from_arrays([pa.array(heavy), pa.array(counts[heavy])], names=["slot", "n"])

    with small_batches(texts.sparkSession):
        found = texts.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(SLOTS, np.int64)
    table[found["slot"].to_numpy()] = found["n"].to_numpy()
    return table


def rare_part(shingles: np.ndarray, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """The rarest shingles of a sorted set, of which similar sets share one."""
    n = len(shingles)
    take = n - -(-num * n // den) + 1
    return shingles[np.lexsort((shingles, counts[_slots(shingles)]))[:take]]


def clusters(open_: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(doc, cluster) of ``open_`` (doc, label, text): what rare shingles of several labels connect.

    Nodes that are similar enough and of different labels are in one cluster; a node
    that is in none has no such partner.
    """
    counts = frequent(open_)

    def spell(batches):
        shingles = Shingler()
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                some = b.slice(lo, 200)
                parts = [rare_part(shingles(t), counts, num, den) for t in utf8(some.column(2))]
                owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), some.column(0).take(pa.array(owner)),
                                                  some.column(1).take(pa.array(owner))], names=["key", "doc", "label"])

    rare = open_.select("doc", "label", "text").mapInArrow(spell, "key long, doc long, label long")
    rare = scratch.save(rare, "rare")
    stars = rare.groupBy("key").agg(F.min("doc").alias("pivot"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    edges = rare.join(stars.select("key", "pivot"), "key").where("doc <> pivot").select(F.col("doc").alias("a"), F.col("pivot").alias("b")).distinct()
    return components(edges, scratch).select(F.col("node").alias("doc"), F.col("label").alias("cluster"))


def _rest(buckets: DataFrame, labels: DataFrame, rows: DataFrame, texts: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame | None:
    """Asks for pairs of one bucket and cluster and several labels that the signatures don't rule out."""
    named = buckets.select("key", "band", "doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", "band", "doc", F.coalesce("label", "doc").alias("label"))
    several = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    named = scratch.save(named.join(several, "key"), "named")
    opened = named.groupBy("doc").agg(F.min("label").alias("label"))
    opened = scratch.save(opened.join(texts, "doc"), "open")
    if not opened.limit(1).count():
        return None
    t = num / den
    least = t - 5 * (t * (1 - t) / VALUES) ** 0.5
    named = named.join(clusters(opened, num, den, scratch), "doc").select(F.xxhash64("key", "cluster").alias("key"), "band", "doc", "label")
    by_label = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    open_ = scratch.save(by_label.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("labels"))
                  .where("labels > 1").select(
        "key", F.col("top.label").alias("most"),
        F.ceil(F.col("top.n") / F.lit(BLOCK)).alias("big"), F.ceil((F.col("all") - F.col("top.n")) / F.lit(BLOCK)).alias("small")), "open")
    if not open_.limit(1).count():
        return None
    placed = named.join(open_, "key")
    other = F.col("label") != F.col("most")
    mine = F.when(other, F.pmod(F.xxhash64("doc"), F.col("small"))).otherwise(F.pmod(F.xxhash64("doc"), F.col("big")))
    zero = F.lit(0).cast("long")
    # nodes outside the most frequent label meet each other (kind 0) and all of that label (kind 1)
    meet = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    places = F.when(other, F.concat(
        F.transform(F.sequence(zero, F.col("small") - 1), lambda k: meet(0, F.least(k, F.col("mine")), F.greatest(k, F.col("mine")))),
        F.transform(F.sequence(zero, F.col("big") - 1), lambda k: meet(1, F.col("mine"), k)))).otherwise(
        F.transform(F.sequence(zero, F.col("small") - 1), lambda k: meet(1, k, F.col("mine"))))
    g2 = (F.shiftleft(F.col("at.i"), 31).bitwiseOR(F.col("at.j"))) * 2 + F.col("at.kind")
    dealt = (placed.withColumn("mine", mine).select("key", "band", "doc", "label", other.alias("other"), "mine", F.explode(places).alias("at"))
             .join(marked(rows.select("doc", "bands", "sketch"), opened), "doc")
             .select(F.col("key").alias("g1"), g2.alias("g2"), "band", "doc", "label", "other", "mine", "bands", "sketch"))
    return scratch.save(per_group(dealt, ("g1", "g2"), ASK, lambda: lambda *columns: likely(least, *columns)), "asks")


def likely(least: float, g1, g2, band, docs, labels, other, mine, bands, sketch) -> list[tuple]:
    """Rows of one block that have a pair to confirm, each with its partners."""
    key, code = g1[0].as_py(), g2[0].as_py()
    kind, i, j, t = code & 1, code >> 32, (code >> 1) & 0x7FFFFFFF, band[0].as_py()
    doc, label, block = docs.to_numpy(), labels.to_numpy(), mine.to_numpy()
    outside = other.to_numpy(zero_copy_only=False)
    marks = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(doc), VALUES)
    keys = bands.flatten().to_numpy().reshape(len(doc), BANDS)
    left = np.flatnonzero(outside & (block == i)) if kind == 0 else np.flatnonzero(outside)
    right = np.flatnonzero(outside & (block == j)) if kind == 0 else np.flatnonzero(~outside)
    wanted: dict[int, list[int]] = {}
    for a in left:
        with_ = right[label[right] != label[a]]
        if kind == 0 and i == j:
            with_ = with_[with_ > a]
        if len(with_):
            with_ = with_[(marks[with_] == marks[a]).mean(axis=1) >= least]
        if len(with_):  # a pair belongs to the first band that it shares
            with_ = with_[(keys[with_] == keys[a]).argmax(axis=1) == t]
        if len(with_):
            wanted.setdefault(int(a), []).extend(doc[with_].tolist())
            for b in with_.tolist():
                wanted.setdefault(b, [])
    return [(key, code, int(doc[a]), int(label[a]), partners) for a, partners in wanted.items()]


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Linked are documents whose sets have ``den * intersection >= num * union``. No copy
    of the texts is stored: ``docs`` is read again for those that share a band, and has
    to give the same rows, in whatever order.
    """
    with Scratch(docs.sparkSession, "dedup") as scratch:
        return saved(_near_duplicates(docs, num, den, scratch), "dedup-components")


def _near_duplicates(docs: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = _sets(texts.withColumn("row_id", F.monotonically_increasing_id()), scratch)
    linkable = rows.where("doc is not null and n_shingles > 0")
    reps = _reps(linkable, scratch)
    members = scratch.save(linkable.select("doc", "n_shingles", "same").join(
        reps.select("same", "node", F.col("named.doc").alias("rep")), "same").drop("same"), "members")
    # rows of one id with different sets are one document: an edge between their nodes
    split = members.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a < top").select("doc", "a")
    same_id = members.join(split, "doc").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    labels = _labels(linkable, reps, lambda asked: _read_again(texts, linkable, asked, scratch), same_id, num, den, scratch)
    named = labels.join(reps.select("node", "named.doc"), "node")
    least = labels.join(named.groupBy("label").agg(F.min("doc").alias("least")), "label").select("node", "least")
    found = members.join(least, "node", "left").select("doc", "n_shingles", F.coalesce("least", "rep").alias("component_id"))
    alone = rows.where("doc is null or n_shingles = 0").select("doc", "n_shingles", F.col("doc").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("doc").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))


def _read_again(texts: DataFrame, linkable: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, text) of the nodes ``asked`` (doc: a row id), a stored table.

    Found in ``texts`` (doc, text, digest) by id and text's digest, as row ids may differ
    when rows are read again; of rows that have both in common, one is sent on.
    """
    both = ["doc", "digest"]
    keys = scratch.save(linkable.select(*both, F.col("row_id").alias("node")).join(asked.withColumnRenamed("doc", "node"), "node"), "keys")
    found = marked(texts, keys, both).dropDuplicates(both)
    # an inner join: a semi-join would be made before the marks are looked at
    found = scratch.save(found.join(keys, both).select(F.col("node").alias("doc"), "text"), "texts")
    if found.count() != keys.count():
        raise RuntimeError("the documents changed while they were compared")
    return found


def _sets(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The columns of ``texts`` (doc, text, row_id and more) without the text, and those of ``FIELDS``, a stored table."""
    return scratch.save(add_columns(texts, ["text"], FIELDS, _set_columns).drop("text"), "sets")


def _reps(linkable: DataFrame, scratch: Scratch) -> DataFrame:
    """Per set: its first row with an id (``named``: doc, row_id) and without (``unnamed``), and its node, the first of them."""
    first = linkable.groupBy("same").agg(
        F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "row_id"))).alias("named"),
        F.min(F.when(F.col("doc").isNull(), F.col("row_id"))).alias("unnamed"))
    return scratch.save(first.withColumn("node", F.coalesce("named.row_id", "unnamed")), "reps")


def _labels(linkable: DataFrame, reps: DataFrame, texts_of: Callable[[DataFrame], DataFrame], links: DataFrame | None,
            num: int, den: int, scratch: Scratch) -> DataFrame:
    """(node, label) of the nodes of ``reps`` (rows of ``linkable``, one per set) that have links, with further ``links`` (a, b).

    ``texts_of`` gives the stored texts (doc, text) of nodes (doc).
    """
    rows = linkable.select(F.col("row_id").alias("doc"), "n_shingles", "bands", "sketch")
    ids = reps.select(F.col("node").alias("doc"))
    copies = scratch.save(rows.select("doc").join(ids, "doc", "left_anti"), "copies")
    nodes = marked(rows, copies, others=True).unionByName(marked(rows, copies).join(ids, "doc"))
    spread = nodes.select("doc", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    shared = spread.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("other")).where("pivot < other").drop("other")
    buckets = scratch.save(spread.join(shared, "key"), "buckets")
    wanted = texts_of(buckets.select("doc").distinct())  # most texts share no band
    found = confirmed(_star(buckets.where("doc <> pivot").select("doc", "n", "pivot").distinct()), wanted, num, den)
    links = scratch.save(found if links is None else found.unionByName(links), "links")
    labels = components(links, scratch)
    rest = _rest(buckets, labels, rows, wanted, num, den, scratch)
    if rest is None:
        return labels
    more = scratch.save(confirmed(rest, wanted, num, den), "links")
    return components(links.unionByName(more), scratch)


def op10_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, at 85 per cent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group of rows at 80 per cent; columns unchanged.

    The row of the smallest id stays; of a group's rows without an id one stays
    beside it, as they may be documents of their own.
    """
    tagged = saved(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("row_id")), "dedup-rows")
    texts = tagged.select(F.col("row.doc_id").cast("long").alias("doc"), "row.text", "row_id")
    with Scratch(spark, "dedup") as scratch:
        gone = saved(_repeats(texts, 80, 100, scratch), "dedup-gone")
    return without(tagged, gone, "row_id").select("row.*")


def _repeats(texts: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Row ids of all rows of ``texts`` but the first with an id and the first without of each group."""
    linkable = _sets(texts, scratch).where("n_shingles > 0")
    reps = _reps(linkable, scratch)

    def texts_of(asked):
        # they stay where they are (a semi-join would be made before the marks are looked at)
        return scratch.save(marked(texts.select(F.col("row_id").alias("doc"), "text"), asked).join(asked, "doc"), "texts")

    labels = _labels(linkable, reps, texts_of, None, num, den, scratch)
    first = scratch.save(reps.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label"))
                         .agg(F.min("named").alias("named"), F.min("unnamed").alias("unnamed")), "first")
    stay = first.select(F.explode(F.array("named.row_id", "unnamed")).alias("row_id")).where("row_id is not null")
    return linkable.select("row_id").join(stay, "row_id", "left_anti")


SQL = r"""
WITH RECURSIVE spelt AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
    FROM spelt WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * k >= 85 * (p.n + q.n - k)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (
    SELECT x, x AS y FROM edges
    UNION
    SELECT r.x, e.y FROM reached r JOIN edges e ON e.x = r.y),
components AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN components c ON c.x = d.doc_id
"""
