"""Quality rules, licence scan, language ID, text blocks: brute force and corner cases."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankgrad.llm import common, html_blocks, language_id, licenses, quality_rules
from rankgrad.llm.common import add_columns

SCHEMA = "doc_id long, text string, lang string, source string, n_words string"
LONG = "word and more " * 40_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a clashing column."""
    return spark.createDataFrame([
        (1, None, "en", "a", "x"), (2, "", None, None, "x"), (3, " \t\n", "en", "a", None), (None, "two words", "en", "a", "x"),
        (4, LONG, "en", "a", "x"), (5, "same text here", "de", "b", "x"), (5, "same text here", "de", "b", "x"),
        (6, "12 34 !?", "en", "a", "x")], SCHEMA)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    marked = {j for i, g in enumerate(grams) if g in often for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked))


def test_counts_match_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("ab é\t\n#|\x0b ") for _ in range(rng.randint(0, 60)))
        assert quality_rules.text_counts(text.encode())[:5] == brute_counts(text), text
    assert quality_rules.text_counts(None) == (0,) * len(quality_rules.COUNTS)


def test_covering_finds_planted_rules():
    rng = np.random.default_rng(2)
    table = {"a": rng.random(2000), "b": rng.random(2000)}
    bad = (table["a"] > 0.8) | ((table["b"] < 0.3) & (table["a"] < 0.4))
    rules = quality_rules.learn_rules(table, bad)
    hit = np.zeros(2000, bool)
    for rule in rules:
        hit |= quality_rules.covered(rule, table, 2000)
    assert (hit == bad).mean() > 0.97 and 2 <= len(rules) <= 8
    assert quality_rules.learn_rules({"a": np.zeros(0)}, np.zeros(0, bool)) == []
    assert quality_rules.learn_rules({"a": np.zeros(9)}, np.arange(9) % 2 == 0) == []  # ties: nothing to cut


def test_quality_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0), (None, 0), (5, None), (99, 1)], "doc_id long, quality int")
    rules = quality_rules.fit(odd, labels)
    assert rules == []
    got = quality_rules.judge(odd, rules)
    assert got.columns == ["doc_id", "text", "lang", "source", *quality_rules.COUNTS, "base_failed", "kept"]
    rows = {(r.doc_id, r.n_words, r.kept) for r in got.collect()}
    assert rows == {(1, 0, False), (2, 0, False), (3, 0, False), (None, 2, False), (4, 120_000, False), (5, 3, False), (6, 3, False)}
    assert got.count() == 8 and quality_rules.judge(odd.limit(0), rules).count() == 0


def test_rules_follow_labels(spark):
    rows = [(i, ("fine words of prose %d " % i + " ".join(f"w{i}x{k}" for k in range(70))) if i % 2 else
             " ".join(f"w{i}x{k}###" for k in range(70))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    kept = {r.doc_id for r in quality_rules.judge(docs, rules).where("kept").collect()}
    assert kept == {i for i in range(60) if i % 2}


def test_automaton_matches_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        seqs = [[rng.choice("abc") for _ in range(rng.randint(1, 9))] for _ in range(3)]
        machine = licenses.Automaton(seqs)
        text = [rng.choice("abcd") for _ in range(30)]

        def ends(run, seqs=seqs):
            return {(n, i + len(run)) for n, s in enumerate(seqs) for i in range(len(s) - len(run) + 1) if s[i:i + len(run)] == run}

        longest = []
        for i in range(len(text)):
            n = 0
            while n <= i and ends(text[i - n:i + 1]):
                n += 1
            longest.append(n)
        want = [(i + 1, n) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(text) or longest[i + 1] != n + 1)]
        got = machine.matches(text, 2)
        assert [(e, n) for e, n, _ in got] == want
        assert all(machine.ends[s] == ends(text[e - n:e]) for e, n, s in got)


def test_phrases_overlap_and_chain():
    words = licenses.words_of(b"CC-BY cc by. All rights reserved; all rights reserved")
    assert licenses.phrase_places(words) == {"cc-by": [0, 2], "reserved": [4, 7]}
    scanner = licenses.Scanner()
    label, text = licenses.TEMPLATES[1]
    tokens = licenses.words_of(text.encode())
    torn = tokens[:30] + [b"inserted"] + tokens[30:]
    spans, score = scanner.scan([b"before"] * 5 + torn + [b"after"])
    assert [(s[0], s[1]) for s in spans] == [(label, 5)] and score == 1.0
    assert scanner.scan(tokens[:10])[0] == [] and 0 < scanner.scan(tokens[:10])[1] < 0.3


def test_runs_of_every_template_match_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        seqs = [[rng.choice("abc") for _ in range(rng.randint(1, 9))] for _ in range(4)]
        text, want = [rng.choice("abcd") for _ in range(25)], set()
        for end in range(1, len(text) + 1):
            for k, s in enumerate(seqs):
                for at in range(1, len(s) + 1):
                    n = 0
                    while n < min(end, at) and text[end - 1 - n] == s[at - 1 - n]:
                        n += 1
                    if n >= 2 and (at == len(s) or end == len(text) or s[at] != text[end]):
                        want.add((end, n, k, at))
        got = licenses.Automaton(seqs).runs(text, 2)
        assert set(got) == want and len(got) == len(want)


def test_license_is_found_where_another_template_goes_on():
    scanner = licenses.Scanner()
    spans, score = scanner.scan(licenses.words_of(b"Licensed under the Apache License, Version 2.0. The authors"))
    assert spans == [("apache-2.0", 0, 8, 1.0)] and score == 1.0
    all_words = sorted({w for _, words in scanner.templates for w in words})
    for label, words in scanner.templates:
        for after in all_words:
            spans, score = scanner.scan([*words, after])
            assert (label, 0, len(words), 1.0) in spans and score == 1.0, (label, after)
    # a torn template whose first part another one goes on, and one that ends in another's middle
    scanner = licenses.Scanner([("a", "p q r s t u v w"), ("b", "p q r s x y z y"), ("c", "k l m n o t u v w")])
    assert ("a", 0, 9, 1.0) in scanner.scan(licenses.words_of(b"p q r s x t u v w"))[0]
    assert ("b", 0, 12, 1.0) in scanner.scan(licenses.words_of(b"p q r s t u v w x y z y"))[0]


def test_chain_looks_back_from_a_long_run_after_a_short_one():
    # the short run, which starts late, must not hide what stands before the long one
    assert licenses.chain([(4, 4, 4), (60, 4, 50), (101, 90, 94)], 200, 12) == [(56, 60, 4), (0, 101, 94)]


def test_license_on_odd_rows(spark, odd):
    got = licenses.scan_documents(odd)
    assert got.columns.count("n_words") == 1
    rows = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in got.collect()}
    assert (1, 0, 0, None, "", 0.0) in rows and (4, 120_000, 0, None, "", 0.0) in rows and len(rows) == 7
    assert got.where("doc_id = 4").first().spans == [] and licenses.scan_documents(odd.limit(0)).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = language_id.Network(["a", "b", "c"], 4, rng)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    x = rng.integers(60, 130, (5, 9)).astype(np.uint8)
    lengths, y = np.array([9, 4, 9, 1, 7]), np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(x, lengths, y)
    for k, w in net.weights.items():
        at = tuple(rng.integers(0, s) for s in w.shape)
        if k.startswith("in"):
            at = (at[0], int(x[0, 3]))
        was = w[at]
        w[at] = was + 1e-3
        up = net.gradients(x, lengths, y)[0]
        w[at] = was - 1e-3
        down = net.gradients(x, lengths, y)[0]
        w[at] = was
        assert grads[k][at] == pytest.approx((up - down) / 2e-3, rel=1e-2, abs=3e-5)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language_id.fit(docs, max_documents=600)
    got = language_id.identify(docs.where(language_id.held_out()), net).select("lang", "lang_pred", "score").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


FOREIGN = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä ",
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa ",
           "Все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства ",
           "qx zvk jjwq xkcd zzyx wvq kqj xzw vvk qqz jxk zqw kvx wzj qkv xjz wqk vzx jqw kzx ")


def test_stage_drops_languages_it_has_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.length("text") > 300)
    planted = spark.createDataFrame([(10 ** 9 + k, t * 5, None, "planted", 0) for k, t in enumerate(FOREIGN)], "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.unionByName(planted.select([F.col(f.name).cast(f.dataType) for f in docs.schema]))
    halves = {r.lang: r.text for r in docs.groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).where("lang is not null").collect()}
    mixed = [(2 * 10 ** 9 + k, f"{halves[x][:1500]}\n{halves[y][:1500]}", None, "mixed", 0) for k, (x, y) in enumerate(itertools.combinations(sorted(halves), 2))]
    both = both.unionByName(spark.createDataFrame(mixed, planted.schema).select([F.col(f.name).cast(f.dataType) for f in docs.schema]))
    kept = {r.doc_id for r in language_id.language_stage(spark, both, "").select("doc_id").collect()}
    assert not kept & {10 ** 9 + k for k in range(len(FOREIGN))}
    assert len(mixed) >= 3 and kept >= {m[0] for m in mixed}  # in two learned languages
    labelled = [r.doc_id for r in docs.where("lang is not null").select("doc_id").collect()]
    assert sum(d in kept for d in labelled) >= 0.998 * len(labelled)


def test_a_hot_id_and_a_rare_language(spark):
    rows = [(8, f"the hot row number {k}", "en") for k in range(4000)] + [(100 + k, "und der die das ist", "de") for k in range(4000)]
    rows += [(9000 + k, "el que los las por", "es") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    sample = language_id.spread_sample(language_id._known(docs), {"t": F.col("text")}, 300).collect()
    by = {name: [r for r in sample if r.lang == name] for name in ("en", "de", "es")}
    assert len(by["en"]) == 1 and len(by["de"]) == 100 and len(by["es"]) == 3
    assert len({(r.lang, r.doc_id) for r in sample}) == len(sample)
    assert language_id.fit(docs, max_documents=90).languages == ["de", "en", "es"]


def test_rules_are_fitted_on_one_row_per_id(spark, monkeypatch):
    rows = [(7, f"{'word ' * 60}{k}") for k in range(2000)] + [(k, "other words " * 40 + " ".join(map(str, range(60)))) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in sorted({r[0] for r in rows})], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_rules, "base_failed", lambda: F.lit(False))
    monkeypatch.setattr(quality_rules, "learn_rules", lambda x, bad, **kw: seen.append(len(bad)) or [])
    quality_rules.fit(docs, labels)
    quality_rules.fit(docs, labels, max_labelled=10)
    assert seen == [61, 10]


def test_language_on_odd_rows(spark, odd):
    net = language_id.train([("en", b"the words of this"), ("de", b"und der die das")], steps=5)
    rows = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in language_id.identify(odd, net).collect()}
    assert rows == {(1, True, True), (2, True, True), (3, True, True), (None, False, False), (4, False, False), (5, False, False), (6, True, True)}
    assert language_id.fit(odd.limit(0)) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}


def brute_article(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", inside)
    import html
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


def test_articles_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = html_blocks.extract(pages).select("html", "text").collect()
    assert len(got) == 250 and all(r.text == brute_article(r.html) for r in got)


def test_blocks_of_other_pages():
    tree = html_blocks.train_tree()
    page = ("<body class=post><header><h1>Site</h1></header><div class='nav'>a <a href=x>b</a></div><main><h2>Title &amp; x</h2>"
            "<p>One two<br>three &lt;b&gt; <i>it</i>alic.<p>Next<aside>side</aside><ul><li>i1<li>i2</ul>"
            "<div class='comments'><p>Nice post, I liked it a lot</p></div><script>if (a < b) '</p>'</script></main>"
            "<form>Sign up<input></form><footer>c</footer>")
    assert html_blocks.main_text(page, tree) == "Title & x\nOne two three <b> italic.\nNext\ni1\ni2"
    assert html_blocks.main_text(None, tree) == html_blocks.main_text("", tree) == ""


BODY = " ".join(f"w{i}" for i in range(60))


@pytest.mark.parametrize("page, want", [
    (f"<article class='post share'><p>{BODY}</p></article>", [BODY]),
    (f"<div class='content has-sidebar'><p>{BODY}</p></div><div class='sidebar'><p>{BODY} x</p></div>", [BODY]),
    (f"<article><p>{BODY}</p><div class='related-work'><p>Some related work</p></div><div class='related-posts'><p>Read this too</p></div>"
     f"<figure><img src=x><figcaption>A caption</figcaption></figure><p>{BODY}</p></article>", [BODY, "Some related work", "A caption", BODY]),
    (f"<div><a href=/>Home</a> <a href=/b>About us</a></div><div>Two words</div><div>{BODY}</div><div>Short one</div><div>{BODY}</div>"
     "<div>Share this page with friends today</div><div>Copyright 2024 Some Company</div>", ["Two words", BODY, "Short one", BODY]),
    (f"<article><p title=it's>{BODY}</p><p data-x=\"a>b\" hidden>no</p><p>yes</p></article>", [BODY, "yes"]),
    (f"<main><p>{BODY}</p><p><a href=x>One link</a></p><p>{BODY}</p></main>", [BODY, "One link", BODY]),
    (f"<article><p>{BODY}</p><p>a < b and <3 <- c</p></article>", [BODY, "a < b and <3 <- c"])])
def test_neighbours_and_marks_decide(page, want):
    assert html_blocks.main_text(page, html_blocks.train_tree()).split("\n") == want


def test_the_tree_looks_at_neighbours():
    used, nodes = set(), [html_blocks.train_tree()]
    while nodes:
        node = nodes.pop()
        if node.left is not None:
            used.add(html_blocks.FEATURES[node.feature])
            nodes += [node.left, node.right]
    assert {"words", "density", "words_after", "density_before", "prose_before", "prose_after"} <= used


@pytest.mark.parametrize("piece", ["<a ", "<a b=\"", "<a b='", "<div>x", "<b><i>x", "<i>x</b>", "<div></p>", "<!--", "<script>", "<p title=it's>", "</", "<![CDATA[", "&amp", "<b><div></b>"])
def test_reading_takes_linear_time(piece):
    import time
    took = []
    for n in (20_000, 160_000):
        page = piece * n + ">"
        began = time.process_time()
        html_blocks.blocks_of(page)
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.5  # eight times the page


def test_pages_on_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", "", 5), (2, "u", "<article><p>x &copy;" + " y" * 50_000, 5),
                                   (2, "u", "<article><p>x</p></article>", 5), (2, "u", "<article><p>x</p></article>", 5)],
                                  "page_id long, url string, html string, n_chars int")
    got = html_blocks.extract(pages)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 1, 1, 100_003]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_columns_pass_through(spark, odd):
    from pyspark.sql import types as T
    got = add_columns(odd, ["text"], [("text", T.LongType())], lambda: lambda c: [[len(x or "") for x in c.to_pylist()]])
    assert got.columns == ["doc_id", "lang", "source", "n_words", "text"] and got.agg({"text": "max"}).first()[0] == len(LONG)


# ---- licence templates

def test_every_built_in_licence_is_found_in_a_file():
    scanner = licenses.Scanner()
    for label, text in licenses.TEMPLATES:
        around = f"/* copyright 2020 somebody\n * {text}\n */ int main ( ) {{ return 0 ; }}"
        spans, score = scanner.scan(licenses.words_of(around.encode()))
        assert label in {s[0] for s in spans} and score == 1.0, label


def test_two_and_three_clauses():
    scanner, text = licenses.Scanner(), dict(licenses.TEMPLATES)
    two, third = text["bsd-2-clause"], text["bsd-3-clause"]
    at = two.index("THIS SOFTWARE")
    labels = lambda t: {s[0] for s in scanner.scan(licenses.words_of(t.encode()))[0]}
    assert labels(two) == {"bsd", "bsd-2-clause"}
    assert labels(f"{two[:at]} 3. {third}. {two[at:]}") == {"bsd", "bsd-3-clause"}


def test_templates_of_a_table_and_of_files(spark, tmp_dir):
    import pathlib

    own = " ".join(f"clause{k} of the house licence number {k}" for k in range(300))
    changed = own.replace("clause7 of", "section7 of").replace("clause90 of the", "")
    for name, body in (("House-1.0", own), ("empty", "")):
        (pathlib.Path(tmp_dir) / name).write_text(body)
    rows = [("house-1.0", own), ("house-1.0", own), (None, "no label"), ("none", None), ("blank", " . ")]
    table = licenses.templates_of(spark.createDataFrame(rows, "label string, text string"))
    assert table == licenses.templates_in(spark, tmp_dir) == (("house-1.0", own),)
    with pytest.raises(ValueError, match="characters of templates"):
        licenses.templates_of(spark.createDataFrame(rows, "label string, text string"), max_chars=100)
    assert licenses.templates_of(spark.createDataFrame([], "label string, text string")) == ()
    docs = spark.createDataFrame([(1, changed), (2, "clause1 of the house"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_documents(docs, templates=table).collect()}
    assert got[1][0] == "house-1.0" and 0.98 < got[1][1] < 1
    assert got[2][0] == got[3][0] == "" and got[3][1] == 0
    assert {r.labels for r in licenses.scan_documents(docs).collect()} == {""}


def test_stage_learns_from_every_whole_text(spark, monkeypatch):
    """The network and the threshold of the stage come from all documents, no sample of them."""
    rows = [(k, f"{'the words of this text and that ' if k % 2 else 'und der die das ist nicht '}{k} " * (1 + k % 9), "en" if k % 2 else "de") for k in range(7000)]
    docs = spark.createDataFrame(rows + [(None, "no id", "en"), (7001, None, "en"), (7002, "", "en"), (7003, "no language", None)], "doc_id long, text string, lang string").repartition(3)
    learned, judged, trained, least = [], [], language_id.trained, language_id.least_certainty
    monkeypatch.setattr(language_id, "spread_sample", lambda *a, **kw: pytest.fail("a sample"))
    monkeypatch.setattr(language_id, "trained", lambda windows, **kw: (learned.append(windows.collect()), trained(windows, **kw))[1])
    monkeypatch.setattr(language_id, "least_certainty", lambda told, **kw: (judged.append(told.count()), least(told, **kw))[1])
    kept = language_id.language_stage(spark, docs, "").count()
    held = {r.doc_id for r in docs.where(language_id.held_out()).collect()}
    pieces = itertools.groupby(sorted(learned[0], key=lambda r: r.doc_id), lambda r: r.doc_id)
    assert {i: sum(len(r.w) for r in some) for i, some in pieces} == {i: len(t) for i, t, _ in rows if i not in held}
    assert judged == [7004] and kept >= 0.99 * 7000


def test_threshold_counts_every_held_out_document(spark):
    told = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("en").alias("lang_pred"),
                                      F.when(F.col("id") % 50 == 7, 0.8).otherwise(0.99).alias("certainty"))
    assert language_id.least_certainty(told) == pytest.approx(0.6, abs=1e-3)
    assert language_id.least_certainty(told, keep=0.9) == pytest.approx(0.98, abs=1e-3)
    assert language_id.least_certainty(told.limit(50)) == 0 and language_id.least_certainty(told.limit(0)) == 0


def test_training_in_shards(spark, monkeypatch):
    """Shards in tasks of their own and a rare language: the averaged network tells them, however rows are dealt."""
    monkeypatch.setattr(language_id, "SHARD", 512)
    words = {"en": "the words of this and that are here ", "de": "und der die das ist nicht ein ", "es": "el que los las por una con "}
    rows = [(k, (words[name] * 4)[k % 20:][:90], name) for k in range(6000) for name in [("es" if k % 200 == 0 else "en" if k % 3 else "de")]]
    nets = [language_id.trained(spark.createDataFrame(rows, "doc_id long, w string, lang string").repartition(n)) for n in (2, 7)]
    assert all(np.allclose(nets[0].weights[k], nets[1].weights[k], atol=1e-4) for k in nets[0].weights)
    told = nets[0].probabilities([(words[n] * 3)[5:].encode() for n in nets[0].languages])
    assert nets[0].languages == ["de", "en", "es"] and told.argmax(axis=1).tolist() == [0, 1, 2]


def test_windows_are_dealt_to_rounds_without_a_sort(spark, monkeypatch):
    """A task writes to all rounds' files at once, of texts read a slice at a time; every window is dealt, settings come back."""
    writers, rows = "spark.sql.maxConcurrentOutputFileWriters", [(k, f"the words {k} of this", "en" if k % 3 else "de") for k in range(900)]
    before, seen, kind = {k: spark.conf.get(k) for k in (writers, common.READ_ROWS, common.BATCH_ROWS)}, [], type(spark.range(1).write)

    def written(self, path, *a, f=kind.parquet, **kw):
        f(self, path, *a, **kw)
        if path.endswith("-dealt"):
            seen.append((int(spark.conf.get(writers)), int(spark.conf.get(common.READ_ROWS)), spark.read.parquet(path).select("w").distinct().count()))

    monkeypatch.setattr(kind, "parquet", written)
    net = language_id.trained(spark.createDataFrame(rows, "doc_id long, w string, lang string").repartition(2))
    (at_once, read, dealt), = seen
    assert net.languages == ["de", "en"] and at_once >= language_id.ROUNDS and read <= common.SLICE and dealt == 900
    assert before == {k: spark.conf.get(k) for k in before}


def test_every_time_of_a_window_is_computed_in_place(monkeypatch):
    """The network's states are those of the plain formula, without fresh arrays for every byte."""
    rng = np.random.default_rng(5)
    net, n, batch, u = language_id.Network(["a", "b", "c"], 4, rng), 30, 9, 4
    x, lengths = rng.integers(32, 127, (n, batch)).astype(np.uint8), rng.integers(1, n + 1, batch)
    valid = (np.arange(n)[:, None] < lengths).astype(np.float32)[:, None, :]
    want = {}
    for d in "fb":
        h, want[d] = np.zeros((u, batch)), np.zeros((n, u, batch))
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            read, heard = net.weights[f"in_{d}"][:, x[t]], net.weights[f"rec_{d}"] @ h
            z, r = (1 / (1 + np.exp(-(read[i:i + u] + heard[i:i + u]))) for i in (0, u))
            new = np.tanh(read[2 * u:] + r * heard[2 * u:])
            want[d][t] = h = (new + z * (h - new)) * valid[t]
    tanh, fresh = np.tanh, []
    monkeypatch.setattr(np, "tanh", lambda v, out=None: (fresh.append(out is None), tanh(v, out=out))[1])
    for d in "fb":
        for keep in (False, True):
            assert np.allclose(net._run(x, valid, d, keep)[0], want[d], atol=1e-5)
    assert len(fresh) == 4 * 2 * n and not any(fresh)
