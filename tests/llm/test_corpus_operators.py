"""WARC, quotation linking, positional index, sharding, packing, near-dedup, pipeline."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankgrad.llm import common, minmax_dedup, packing, positional_index, quotes, sharding, warc
from rankgrad.llm.common import Scratch
from rankgrad.session import release, scratch_path

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


# ---- WARC

PAGES = "page_id long, url string, html string, digest string"


@pytest.fixture(scope="module")
def pages(spark):
    big, mid = "é" * 40_000, "ab" * 700
    return spark.createDataFrame([
        (1, "u", mid, "x"), (2, None, mid, "x"), (2, "v\r\nX: y", mid, "x"), (None, "u", mid, "x"), (3, "u", None, "x"), (4, "u", "", "x"),
        (5, "u", big, "x"), (5, "u", big, "x"), (6, "u", big + "x", None), (7, None, "WARC/1.1\r\n\r\n0\r\n\r\n" * 20, "x")], PAGES)


def test_archive_round_trip(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(pages.drop("digest"), path, segment_bytes=1000, chunk_bytes=77)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == 10 and all(r.complete for r in got)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert [k for k in kinds if k[1] == "revisit"] == [("1", "revisit", 2), ("None", "revisit", 2)]
    want = sorted((r.page_id, (r.html or "").encode()) for r in pages.where("page_id > 1").collect())
    assert sorted((r.page_id, bytes(r.payload)) for r in got if r.record_type == "response") == want


def test_missing_segment_is_reported(spark):
    pages = spark.createDataFrame([(6, "u", "ab" * 50_000, "x")], PAGES)
    path, torn = scratch_path(spark, "test-warc"), scratch_path(spark, "test-torn")
    warc.write_archive(pages.drop("digest"), path, segment_bytes=30_000)
    lines = spark.read.option("lineSep", "\r\n\r\n").text(path)
    records = [r.value for r in lines.collect()]
    text = "\r\n\r\n".join(records).split("WARC/1.1\r\n")
    rows = [("WARC/1.1\r\n" + t.removesuffix("\r\n\r\n"),) for t in text if t and "WARC-Segment-Number: 2" not in t]
    spark.createDataFrame(rows, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(torn)
    got = warc.read_archive(spark, torn).collect()
    assert [(r.page_id, r.complete, r.payload) for r in got] == [(6, False, None)]


def test_archive_of_nothing(spark, pages):
    path = scratch_path(spark, "test-warc")
    warc.write_archive(pages.limit(0), path)
    assert warc.read_archive(spark, path).count() == 0
    assert warc.payload_of(b"H\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc") is None
    assert warc.payload_of(b"H\r\n\r\nabc") == b"abc"


# ---- quotation linking

def test_quotes_are_linked(spark):
    rows = [(1, 0, "u", "Hello  there\nsecond line"), (1, 1, "a", "> hello there\n> second line\n\nMy answer"),
            (1, 2, "u", ">> Hello there second line\n> My answer\nthanks"), (1, 3, "a", "> second line\nto the line"),
            (2, 0, "u", "> My answer\nfrom elsewhere"), (2, 1, "u", "> nobody wrote this\nx"), (2, 2, "u", None), (2, 3, "u", ""),
            (None, 1, "u", "> My answer\nno id"), (3, None, "u", "> \n>\nblank quote"), (1, 2, "u", "> My answer\nagain")]
    got = {(r.conv_id, r.turn, r.text): (r.n_quotes, r.n_linked, r.parent_turn, r.source_conv, r.thread_turn, r.depth)
           for r in quotes.link(spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")).collect()}
    assert got == {
        (1, 0, "Hello  there\nsecond line"): (0, 0, None, None, 0, 0), (1, 1, "My answer"): (1, 1, 0, 1, 0, 1),
        (1, 2, "thanks"): (2, 2, 1, 1, 0, 2), (1, 2, "again"): (1, 1, 1, 1, 0, 2), (1, 3, "to the line"): (1, 1, 0, 1, 0, 1),
        (2, 0, "from elsewhere"): (1, 1, None, 1, 0, 0), (2, 1, "x"): (1, 0, None, None, 1, 0), (2, 2, ""): (0, 0, None, None, 2, 0),
        (2, 3, ""): (0, 0, None, None, 3, 0), (None, 1, "no id"): (1, 1, None, 1, 1, 0), (3, None, "blank quote"): (1, 0, None, None, None, 0)}


def test_quotes_with_edited_lines_and_own_copies(spark):
    rows = [(1, 0, "> common words\nfirst reply"), (1, 1, "common words"), (5, 0, "common words"), (7, 3, "common words"), (7, 0, "> common words\nseventh"),
            (8, 0, "one\ntwo\nthree four"), (8, 1, "> edited one\n>   \n> TWO \n> three\nafter"), (8, 2, "> not a line\n> nor this\nnone")]
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.parent_turn, r.source_conv, r.depth)
           for r in quotes.link(spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")).collect()}
    # conversation 1 holds the words itself, but later: another one is the original; the same from the other end
    assert got[1, 0] == (1, 1, None, 7, 0) and got[7, 0] == (1, 1, None, 1, 0)
    assert got[8, 1] == (1, 1, 0, 8, 1) and got[8, 2] == (1, 0, None, None, 0)


def test_quotes_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link(quotes.with_reply_quotes(empty)).count() == 0


# ---- positional index

def brute_contamination(docs, items, window=13):
    windows = []
    for item, text in items:
        w = FOLDED.findall(low(text))
        n = min(len(w), window)
        windows += [(item, w[s:s + n]) for s in range(len(w) - n + 1)] if n else []
    out = []
    for doc, text in docs:
        w, hit, names = FOLDED.findall(low(text)), set(), set()
        for item, run in windows:
            for p in range(len(w) - len(run) + 1):
                if w[p:p + len(run)] == run:
                    hit |= set(range(p, p + len(run)))
                    names |= {str(item)} - {"None"}
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "c", "É", "Dd", "e7", "été"])
    items = [(k % 5 if k else None, " ".join(word() for _ in range(n))) for k, n in enumerate((2, 3, 14, 20, 16, 1, 13))] + [(9, None), (8, " . ")]
    docs = [(k % 20, "-".join(word() for _ in range(rng.randint(0, 40)))) for k in range(22)]
    docs += [(100 + k, "x " * k + low(t).upper() + " y" * 3 * k) for k, (_, t) in enumerate(items) if t] + [(None, items[2][1]), (7, None), (8, "")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = positional_index.decontaminate(d.select("doc_id", "text"), i.select("item_id", "text")).collect()
    assert sorted(map(tuple, got), key=str) == brute_contamination(docs, items)
    none = positional_index.decontaminate(d.select("doc_id", "text"), i.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert positional_index.decontaminate(d.limit(0), i).count() == 0


def test_large_test_set_shuffles_with_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "MAX_BROADCAST_TERMS", 3)
    docs = [(1, "one two three four five"), (2, "two three"), (3, "five four")]
    items = [(1, "two three"), (2, "five")]
    got = positional_index.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute_contamination(docs, items)


def test_proximity_matches_brute_force(spark):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(30))) for k in range(12)]
    items = [(1, "a b"), (2, "c d e"), (3, "h h"), (4, "a zz")]
    index = positional_index.build_index(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "test-index"))
    ids = {r.row_id: r.doc_id for r in index.documents.collect()}
    total = defaultdict(int)
    for _, t in docs:
        for w in t.split():
            total[w] += 1
    numbers = {(r.item_id, r.off): r.term for r in index.tokens.collect()}
    want = set()
    for item, t in items:
        terms = {w: numbers[item, o] for o, w in enumerate(t.split())}
        rare = min(terms, key=lambda w: (total[w], terms[w]))
        for doc, text in docs:
            w = text.split()
            want |= {(doc, item, p) for p, x in enumerate(w) if x == rare and all(y in w[max(0, p - 4):p + 5] for y in terms)}
    got = {(ids[r.row_id], r.item_id, r.pos) for r in positional_index.proximity_matches(index, 4).collect()}
    assert got == want and want


# ---- sharding

def test_difference_beats_greedy():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 400):
        sizes = rng.integers(1, 5000, n)
        to = sharding.difference(sharding._leaves(sizes, 4))[:, 0]
        loads = np.bincount(to, sizes, 4)
        greedy = np.zeros(4)
        for s in sorted(sizes, reverse=True):
            greedy[greedy.argmin()] += s
        assert loads.max() - loads.min() <= max(greedy.max() - greedy.min(), sizes.max() if n < 40 else 0)


def test_shards_keep_groups_and_slots(spark):
    rng = random.Random(8)
    rows = [(k, "é" * rng.randint(1, 900) + str(k)) for k in range(900)] + [(1000 + k, "copy " * 100) for k in range(450)]
    rows += [(None, None), (None, ""), (5000, None), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, shard int")
    got = sharding.shard_documents(df).collect()
    assert len(got) == len(rows)
    import zlib
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by, of = defaultdict(list), defaultdict(set)
    for r in got:
        by[r.shard].append(r)
        of[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in of.values()) and all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    loads = sorted(sum(r.size for r in by[s]) for s in range(16))
    assert loads[14] - loads[0] < 200 and loads[15] == 450 * 501  # the copies fill one shard, the rest is even
    assert sharding.shard_documents(df.limit(0)).count() == 0


# ---- packing

def brute_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [(r, i) for i, (r, ss, cc) in enumerate(bins) if r >= n and (s < 0 or s not in ss) and (c < 0 or c not in cc)]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        out.append((i, capacity - bins[i][0]))
        bins[i][0] -= n
        bins[i][1].add(s)
        bins[i][2].add(c)
    return out


def test_best_fit_matches_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([10, 50])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 60))), reverse=True)
        sources, clusters = [rng.randint(-1, 4) for _ in lengths], [rng.randint(-1, 20) for _ in lengths]
        assert list(zip(*packing.best_fit(lengths, sources, clusters, capacity))) == brute_fit(lengths, sources, clusters, capacity)


def test_packs_hold_every_word_once(spark):
    rows = [(k, f"s{k % 7}", " ".join(f"w{k}" for _ in range(k * 13 % 300 + 1))) for k in range(200)]
    rows += [(500, "s1", "long " * 5000), (500, "s1", "long " * 5000), (None, None, "a b"), (7, "s2", None), (8, "s2", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, cluster string")
    got = packing.pack_documents(df, capacity=256).collect()
    words = defaultdict(int)
    for r in got:
        words[r.doc_id] += r.length
    want = defaultdict(int)
    for i, _, t in rows:
        want[i] += len((t or "").split())
    assert words == want
    bins = defaultdict(list)
    for r in got:
        if r.bin is not None:
            bins[r.bin].append(r)
    for held in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.length) for r in held)
        assert spans[-1][1] <= 256 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        for a, b in combinations(held, 2):
            assert a.cluster != b.cluster and (a.source is None or a.source != b.source)
    assert sum(r.length == 0 and r.bin is None for r in got) == 2
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_ids_and_clusters_come_back_exactly(spark):
    big = [2 ** 60 + 1, 2 ** 60 + 3, -(2 ** 62) - 5]
    rows = [(i, f"s{k}", t) for k, (i, t) in enumerate([(big[0], "same words here"), (big[1], "same words here"), (big[2], ""), (None, "no id"), (None, None), (7, "same words here")])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    with Scratch(spark, "test-pack") as scratch:
        items = scratch.save(packing.measured(df).select("doc_id", "source", "cluster", "n_words", F.monotonically_increasing_id().alias("row_id")), "items")
        want = sorted((r.doc_id, r.cluster, r.source) for r in items.collect() if r.doc_id is not None)
        for pack_rows in (1, 4000):  # alone and with the others in one pack
            got = packing.pack(items, pack_rows=pack_rows).collect()
            assert sorted((r.doc_id, r.cluster, r.source) for r in got if r.doc_id is not None) == want
            assert len({r.cluster for r in got if r.n_words == 3}) == 1 and sum(r.doc_id is None for r in got) == 2
            assert all((r.bin is None) == (r.bin_offset is None) == (r.n_words == 0) for r in got)


# ---- near-duplicates

def shingles(text):
    w = SPACED.findall(low(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows, num, den):
    sets, up = defaultdict(list), {}
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
            up[i] = i

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b] if x and y):
            lo, hi = sorted((find(a), find(b)))
            up[hi] = lo
    return sorted(((i, len(shingles(t)), find(i) if i is not None else None, i is None or find(i) == i) for i, t in rows), key=str)


def edited(rng, words, share):
    return " ".join(f"n{rng.random()}" if rng.random() < share else w for w in words)


@pytest.mark.parametrize("num", [85, 80])
def test_components_match_brute_force(spark, num, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "BLOCK", 4)  # so that buckets are split
    rng = random.Random(num)
    rows, at = [], 0
    for _ in range(6):
        base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, 25)):
            rows.append((at := at + 1, edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03]))))
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (3, "another text under the same id as before"), (903, "Three short words"),
             (904, "three  SHORT words"), (905, "another text under the same id as before"), (906, "long " * 30_000 + "end"), (907, "long " * 20_000 + "end")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, label int, doc string")
    got = minmax_dedup.near_duplicates(df, num, 100).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, num, 100)


@pytest.mark.parametrize("num", [85, 80])
def test_rare_parts_of_similar_sets_meet(num):
    rng = np.random.default_rng(num)
    counts = rng.integers(0, 9, minmax_dedup.SLOTS)
    for _ in range(300):
        base = rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64) * np.uint64(2)
        a = np.unique(base[rng.random(len(base)) > 0.1])
        b = np.unique(np.r_[base[rng.random(len(base)) > 0.1], rng.integers(0, 1 << 63, 5).astype(np.uint64)])
        if minmax_dedup.similar(a, b, num, 100):
            assert len(np.intersect1d(minmax_dedup.rare_part(a, counts, num, 100), minmax_dedup.rare_part(b, counts, num, 100)))


def test_boilerplate_makes_no_pairs(spark, monkeypatch):
    # every document has the same 165 words and 35 of its own: similar to all others, below the threshold
    monkeypatch.setattr(minmax_dedup, "BLOCK", 64)
    common = " ".join(f"c{i}" for i in range(165))
    texts = [f"{common} {' '.join(f'o{k}x{i}' for i in range(35))}" for k in range(600)]
    texts += [texts[5] + " more", texts[7] + " more words", texts[5] + " other"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared = spark.sparkContext.accumulator(0)
    real = minmax_dedup.likely

    def counted(least, g1, g2, docs, *rest):
        compared.add(len(docs) ** 2)
        return real(least, g1, g2, docs, *rest)

    monkeypatch.setattr(minmax_dedup, "likely", counted)
    got = {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(df).collect()}
    assert {k: c for k, c in got.items() if k != c} == {600: 5, 601: 7, 602: 5}
    assert compared.value < 50 * len(texts)


def test_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert minmax_dedup.near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c d"), (None, "a b"), (2, "a b")], "doc_id long, text string")
    left = minmax_dedup.dedup_stage(spark, twice, "").collect()
    assert sorted(map(tuple, left), key=str) == [(1, "a b"), (1, "c d"), (None, "a b")]


def test_dedup_stage_judges_rows_not_ids(spark):
    words = lambda k, n=60: [f"w{k}x{i}" for i in range(n)]
    near = lambda k: " ".join([*words(k)[:-1], "changed"])
    text = lambda k: " ".join(words(k))
    rows = [(1, text(1)), (2, near(1)), (2, text(2)),  # the second text of 2 is unique
            (None, text(3)), (None, text(3)), (None, near(3)), (None, text(4)),  # copies without ids
            (None, near(5)), (5, text(5)), (6, text(5)), (None, None), (None, ""), (None, None)]
    schema = "doc_id long, text string, row_id long, row string"
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], schema).repartition(5)
    left = minmax_dedup.dedup_stage(spark, docs, "")
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    third = [r for r in got if r[1] in (text(3), near(3))]
    assert len(third) == 1 and third[0][0] is None
    rest = [(1, text(1)), (2, text(2)), (None, text(4)), (None, near(5)), (5, text(5)), (None, None), (None, ""), (None, None)]
    assert sorted((r for r in got if r not in third), key=str) == sorted(rest, key=str)


def test_decontamination_stage_judges_rows_not_ids(spark, tmp_path):
    passage = "this very passage of the test set has thirteen words or even more of them"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"x {passage}"), (None, "clean"), (None, None), (4, passage), (4, "clean too"), (5, "clean"), (4, passage)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, digest string, row string")
    left = positional_index.decontamination_stage(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(None, "clean"), (None, None), (4, "clean too"), (5, "clean")], key=str)


def test_partners_of_all_rows_of_a_node_are_confirmed(spark):
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "u v w x y z"), (1, "u v w x y z")], "doc long, text string")
    asks = spark.createDataFrame([(0, 0, 1, 1, [2]), (0, 0, 1, 1, [3]), (0, 0, 2, 2, []), (0, 0, 3, 3, [])], minmax_dedup.ASK)
    got = {tuple(r) for r in minmax_dedup.confirmed(asks, texts, 80, 100).collect()}
    assert got == {(1, 2), (1, 3)}


def test_minmax_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    for same in (0.5, 0.9):
        shared = int(2 * 4000 * same / (1 + same))
        b = np.concatenate([a[:shared], rng.integers(0, 2 ** 63, 4000 - shared, dtype=np.uint64)])
        sig = minmax_dedup.signatures([np.unique(a), np.unique(b)])
        assert abs((sig[0] == sig[1]).mean() - same) < 0.12


# ---- pipeline

def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "decontamination", "packing"]
    columns, kept = docs.columns, [docs.count()]
    from rankgrad.llm.common import saved
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, sf), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            assert docs.join(before, columns, "left_anti").count() == 0
            kept.append(docs.count())
        if name == "quality_rules":
            assert all(len(SPACED.findall(r.text)) >= 50 for r in docs.collect())
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(r[3] for r in brute_components(rows, 80, 100))
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
            assert not any(r[5] for r in brute_contamination([(r.doc_id, r.text) for r in docs.collect()], items))
    assert kept == sorted(kept, reverse=True)
    assert docs.select("doc_id").distinct().count() == kept[-1]


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, extra columns with clashing names, empty tables."""
    sf = str(tmp_path)
    prose = lambda k: " ".join(f"word{k}x{i} und" for i in range(60))
    rows = [(1, prose(1), "en", None, 1, "a"), (1, prose(1), "en", None, 1, "a"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "a"),
            (None, prose(4), "de", "s", None, "a"), (5, prose(5) + " long" * 30_000, None, "s", 5, "b"), (6, "42 " * 80, "en", "s", 6, "b"),
            (7, prose(7), "de", "s", 7, "b"), (8, prose(7), "de", "s", 8, "b"), (9, "taken from the test set", "en", "s", 9, "b"),
            (10, prose(10)[:300] + " this very passage of the test set has thirteen words or even more of them", "en", "s", 10, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string") \
        .withColumnRenamed("kept", "n_words")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0), (77, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "this very passage of the test set has thirteen words or even more of them"), (None, None), (2, "")],
                          "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for some in (docs, docs.limit(0)):
        left = some
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, sf)
            assert left.columns == docs.columns, name
        assert sorted(str(r.doc_id) for r in left.collect()) == (["1", "7", "None"] if some is docs else [])
        assert corpus_pipeline.STAGES[-1][1](spark, left, sf).count() == (3 if some is docs else 0)


def test_pipeline_leaves_its_result_alone(spark):
    from rankgrad.session import ensure_checkpoint_dir, release
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = lambda: {s.getPath().getName() for s in fs.listStatus(root)}
    before = folders()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert {n.rsplit("-", 1)[0] for n in folders() - before} == {"live-pipeline-packing"}
    assert release(out) == 1 and folders() == before


def test_texts_without_shared_band_are_not_shuffled(spark, monkeypatch):
    """Only texts that share a band, and few others, reach the exchange before the texts of the links are kept."""
    wanted = spark.range(0, 3000, 100).select(F.col("id").alias("doc"))
    rows = spark.range(3000).select(F.col("id").alias("doc"), F.lit("x").alias("text"))
    told = {r.doc for r in minmax_dedup.marked(rows, wanted).collect()}
    assert told >= set(range(0, 3000, 100)) and len(told) < 60
    assert sorted(told | {r.doc for r in minmax_dedup.marked(rows, wanted, others=True).collect()}) == list(range(3000))
    assert minmax_dedup.marked(rows, wanted, others=True).count() == 3000 - len(told)
    words = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(random.Random(i // 2 if i < 20 else i).sample(words, 60))) for i in range(200)]
    texts = [(i, t + " more" if i < 20 and i % 2 else t) for i, t in texts]
    plans, save = [], minmax_dedup.Scratch.save

    def noted(self, df, name):
        if name == "texts":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return save(self, df, name)

    monkeypatch.setattr(minmax_dedup.Scratch, "save", noted)
    got = {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 if i < 20 else i for i in range(200)}
    # the marks are looked at below the exact join, so before its shuffle
    assert len(plans) == 1 and plans[0].index("(doc#") < plans[0].index("mark_bits") and "LeftSemi" not in plans[0]


def test_workers_are_sent_few_texts_at_a_time(spark):
    """What an operator writes goes through Python workers in small batches; the session's setting stays."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    before = spark.conf.get(common.BATCH_ROWS, None)
    rows = spark.range(0, 4500, 1, 1).mapInArrow(sizes, "n long")
    with common.Scratch(spark, "sizes") as scratch:
        stored = scratch.save(rows, "sizes")
        kept = common.saved(rows, "sizes")
        for made in (stored, kept):
            assert sorted(r.n for r in made.collect()) == [500, 1000, 1000, 1000, 1000]
        release(kept)
    assert spark.conf.get(common.BATCH_ROWS, None) == before
    spark.conf.set(common.BATCH_ROWS, "300")  # a smaller setting stays
    try:
        with common.Scratch(spark, "sizes") as scratch:
            assert max(r.n for r in scratch.save(rows, "sizes").collect()) == 300
        assert spark.conf.get(common.BATCH_ROWS) == "300"
    finally:
        spark.conf.unset(common.BATCH_ROWS) if before is None else spark.conf.set(common.BATCH_ROWS, before)


def test_words_that_a_task_remembers_are_bounded():
    shingles = minmax_dedup.Shingler()
    texts = [" ".join(f"w{i * 700 + k}" for k in range(700)).encode() for i in range(200)]
    most = 0
    for text in texts:
        shingles(text)
        most = max(most, len(shingles.known))
    assert most <= minmax_dedup.WORDS_KNOWN + 700 < 70_000
    assert (shingles(texts[0]) == minmax_dedup.Shingler()(texts[0])).all()  # forgotten words hash as before


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_stay_are_not_shuffled(spark, tmp_path):
    """Stages drop rows without sending all others through an exchange, and an aligned item asks only for its documents' postings."""
    rows = spark.createDataFrame([(None, "n"), *((k % 500, str(k)) for k in range(600))], "id int, row string")
    gone = spark.createDataFrame([(3,), (3,), (700,), (None,), (40,)], "id int")
    left = common.without(rows, gone, "id")
    assert sorted(r.row for r in left.collect()) == sorted(["n", *(str(k) for k in range(600) if k % 500 not in (3, 40))])
    passage = "this very passage of the test set has thirteen words or even more of them"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, passage), (2, "clean of"), (3, "clean of"), (4, None)], "doc_id long, text string")
    for stage, ids in ((positional_index.decontamination_stage, [2, 3, 4]), (minmax_dedup.dedup_stage, [1, 2, 4])):
        left = stage(spark, docs, str(tmp_path))
        assert sorted(r.doc_id for r in left.collect()) == ids
        plan = _optimized(left)  # an anti-join would be made before the marks are looked at
        assert "LeftAnti" not in plan and "getbit" in plan
    with Scratch(spark, "test-index") as scratch:
        runs = positional_index.phrase_matches(positional_index.build_index(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet"), scratch))
        assert "getbit" in _optimized(runs) and [(r["first"], r["last"]) for r in runs.collect()] == [(0, 14)]


def test_dedup_stores_no_copy_of_all_texts(spark, monkeypatch):
    """Texts are stored of nodes that share a band only, one each, whatever the rows' ids."""
    words = [f"w{i}" for i in range(400)]
    text = lambda k: " ".join(random.Random(k).sample(words, 60))
    rows = [(k, text(k)) for k in range(100)]
    rows += [(200, text(0) + " more"), (200, text(0) + " more"), (None, text(1) + " more"), (201, text(2)), (202, text(2) + " more"), (203, None)]
    stored, save = [], Scratch.save

    def noted(self, df, name):
        out = save(self, df, name)
        if "text" in out.columns:
            stored.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "save", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(((r.doc_id, r.component_id) for r in minmax_dedup.near_duplicates(docs).collect()), key=str)
    links = {200: 0, 201: 2, 202: 2}
    assert got == sorted(((k, links.get(k, k)) for k, _ in rows), key=str)
    assert stored and max(stored) <= 8  # two nodes and one or two rows of each of three links
