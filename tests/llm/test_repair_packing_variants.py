"""Conversation repair, vector packing and spelling variants against plain versions."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankgrad.llm import conversation_repair as repair
from rankgrad.llm import spelling_variants as variants
from rankgrad.llm import vector_packing as packing
from rankgrad.llm.common import Scratch

# ---- conversation repair


def cheapest(letters):
    """(cost, audit) of a word in reading order, by search over (row, state) with least audits."""
    allowed, queue, seen = re.compile(r"(s?(ua)+)?"), [(0, "", 0, "")], set()
    while queue:
        cost, audit, at, roles = heapq.heappop(queue)
        state = (at, {"": 0, "s": 1, "u": 2, "a": 3}[roles[-1:]])
        if (state, cost, audit) in seen:
            continue
        seen.add((state, cost, audit))
        if at == len(letters) and allowed.fullmatch(roles):
            return cost, audit
        if cost > 5 * len(letters) + 10:
            continue
        ways = [(5, "I", r, at) for r in "ua"]
        if at < len(letters):
            c = letters[at]
            ways.append((2, "D", "", at + 1))
            if c != "x":
                late = 5 if c.isupper() else 0
                ways += [(late, "K", c.lower(), at + 1)] + [(1 + late, "R", r, at + 1) for r in "ua"]
        for pay, edit, role, then in ways:
            now = roles + role
            # heads of allowed role strings
            if re.fullmatch(r"s?(ua)*u?", now):
                heapq.heappush(queue, (cost + pay, audit + edit, then, now[-1:] if len(now) < 2 else now))


def test_audits_are_cheapest_and_least():
    rng = random.Random(5)
    words = ["", "s", "x", "u", "A"] + ["".join(rng.choices("suaoSUAOx", k=rng.randint(1, 5))) for _ in range(150)]
    for order in (words, sorted(words)):
        automaton = repair.Automaton()
        for word in order:
            assert automaton.read(word) == cheapest(word[::-1]), word


def test_nodes_are_the_distinct_suffixes():
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("uaxU", k=rng.randint(0, 9))) for _ in range(500)})
    automaton = repair.Automaton()
    for word in words:
        automaton.read(word)
    assert automaton.nodes == len({w[:k] for w in words for k in range(len(w) + 1)})


def test_a_long_conversation_costs_little_memory():
    automaton = repair.Automaton()
    cost, audit = automaton.read("au" * 100_000)
    assert cost == 0 and audit == "K" * 200_000
    assert len(automaton.edits) * 4 == 4 * len(automaton.costs) and len(automaton.known) < 20


CONV = "conv_id long, turn long, role string, text string, copies string, first int"
ROWS = ([(c, t, ("system", "user", "assistant")[(t + c) % 3], f"Text {t % 4}{'.!?x '[(t * c) % 5]}", "k", 1) for c in range(1, 30) for t in range(c % 9)]
        + [(None, 1, "user", "Hi.", "k", 1), (None, None, "assistant", "Ho.", "k", 1), (40, None, None, None, "k", 1), (40, None, "user", "A.", "k", 1),
           (40, 3, "user", "A.", "k", 1), (40, 3, "user", "A.", "k", 1), (40, 3, "", " \t", "k", 1), (40, 9, "uncle", "B? \n", "k", 1), (41, 2, "user", "", "k", 1),
           (42, 2 ** 60, "assistant", "é" * 9000, "k", 1), (42, -5, "user", "C.", "k", 1)]
        + [(50, t, "user" if t % 2 else "assistant", f"{t}.", "k", 1) for t in range(1500)])


def plain(rows):
    byconv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        made = byconv[conv]
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        made += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for conv, made in byconv.items():
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        counts, letters, seen = Counter(), [], set()
        for turn, role, text in made:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters.append("x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(made, made[1:])]
        turns = {r[0] for r in made if r[0] is not None}
        yield conv, made, letters, (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"],
                                    counts["truncated"], sum(p not in ("su", "ua", "au") for p in pairs))


def test_repair_of_odd_rows(spark):
    df = spark.createDataFrame(random.Random(1).sample(ROWS, len(ROWS)), CONV)
    got = {r.conv_id: r for r in repair.repair(repair.damaged(df)).collect()}
    want = list(plain(ROWS))
    assert len(got) == len(want)
    for conv, made, letters, counts in want:
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == counts, conv
        if len(letters) < 12:
            assert (r.cost, r.audit) == cheapest(letters), conv
        lines, at, last = [], 0, ""
        for edit in r.audit:  # the audit alone fixes the roles
            given = "assistant" if last == "u" else "user"
            if edit == "I":
                lines.append((given, ""))
            else:
                _, role, text = made[at]
                at += 1
                if edit != "D":
                    lines.append((role, text) if edit == "K" else (given, text))
            last = lines[-1][0][0] if lines else ""
        assert at == len(made) and re.fullmatch("(s?(ua)+)?", "".join(x[0][0] for x in lines))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()


def test_repair_of_nothing(spark):
    assert repair.repair(repair.damaged(spark.createDataFrame([], CONV))).count() == 0
    dropped = next(t for t in range(99) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = repair.repair(repair.damaged(spark.createDataFrame([(7, dropped, "user", "x", "", 0)], CONV))).collect()
    assert [tuple(r) for r in row] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_cost_parameters():
    costs = repair.Costs(delete=9, insert=1, rerole=3)
    assert repair.Automaton(costs).read("uu") == (2, "KIKI")


# ---- vector packing


def check_pieces(tokens, prompt, limits, pieces):
    """Every token in one piece, no limit broken, offsets without gaps, no padding."""
    cover, inside = defaultdict(list), defaultdict(list)
    for p in pieces:
        cover[p.example].append((p.start, p.length))
        inside[p.sequence].append(p)
        assert p.loss == p.length - min(p.length, max(0, prompt[p.example] - p.start))
    for i, n in enumerate(tokens):
        at = 0
        for start, length in sorted(cover[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    for got in inside.values():
        at = 0
        for p in sorted(got, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(got) <= limits.segments and sum(p.loss for p in got) <= limits.loss
        assert at == limits.tokens or at & (at - 1) == 0
    return inside


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(1024, 4, 900), packing.Limits(64, 3, 40), packing.Limits(16, 1, 1), packing.Limits(100, 5, 100)])
def test_limits_hold_and_nothing_is_padded(limits):
    rng = random.Random(sum(limits))
    for _ in range(12):
        tokens = [rng.choice([1, 2, 3, limits.tokens, rng.randint(1, 3 * limits.tokens)]) for _ in range(rng.randint(0, 60))]
        prompt = [rng.randint(0, n) if rng.random() < 0.6 else 0 for n in tokens]
        check_pieces(tokens, prompt, limits, packing.Packer(tokens, prompt, limits).run())


def test_the_scarce_part_decides():
    # of two examples of one length the dot product takes the one that uses more of what is left
    pieces = packing.Packer([40, 40, 40], [0, 40, 0], packing.Limits(100, 8, 80)).run()
    first = [p.example for p in sorted(pieces, key=lambda p: (p.sequence, p.offset)) if p.sequence == 0]
    assert first[:2] == [0, 2]


def test_whole_examples_are_not_cut_without_need():
    rng = random.Random(3)
    tokens = [rng.randint(100, 700) for _ in range(400)]
    pieces = packing.Packer(tokens, [0] * 400).run()
    assert len({p.sequence for p in pieces if p.length}) <= -(-sum(tokens) // 1024) + 11
    assert sum(v > 1 for v in Counter(p.example for p in pieces).values()) <= len({p.sequence for p in pieces})


ODD_TEXTS = ["", " ", "\n", "a", "First line\nsecond line", "tab\tand  two   blanks \n\n end ", "é" * 50, "日本語のテキスト", "🙂🙂 emoji‍🙂", "x" * 5000, " " * 3000,
             "<|endoftext|>", "a<|endoftext|>b", "don't we'll I'M 've", "12345 67.89", "\x00\x01 control", " nbsp wide", "\r\n\r\n", "﷽" * 500, "a\n" * 700]


def test_ids_are_the_librarys():
    from tokenizers import Tokenizer

    files = packing.tokenizer_files()
    encode, exact = packing.Encoder(*files), Tokenizer.from_file(files[0])
    rng = random.Random(4)
    alphabet = "ab éß日 \n\t'.,0189AZ🙂  -_"
    for text in ODD_TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 200))) for _ in range(400)]:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_of_odd_documents(spark):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.tokenizer_files()[0])
    ids = [2 ** 60 + 1, 2 ** 60 + 3, 7, 8, 9]
    rows = [(ids[i % 5] + 16 * i, t, 1, "x") for i, t in enumerate(ODD_TEXTS * 3)] + [(None, None, 1, "x"), (None, "no id", 2, "x"), (1, "twice", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, offset string").repartition(3)
    for pack_rows in (2048, 7):
        got = packing.packed(df, packing.Limits(256, 8, 200), pack_rows=pack_rows).collect()
        texts = {d: t or "" for d, t, *_ in rows}
        texts[None] = None
        by, inside = defaultdict(list), defaultdict(list)
        for r in got:
            by[r.doc_id].append(r)
            inside[r.sequence_id].append(r)
        assert set(by) == set(texts)
        for doc, pieces in by.items():
            if doc is None:
                assert sorted((p.doc_tokens, p.length) for p in pieces) == [(1, 1), (3, 3)]
                continue
            full = np.array([*exact.encode(texts[doc], add_special_tokens=False).ids, 0], "<u4")
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(full)
                assert p.ids_crc32 == zlib.crc32(full[at:at + p.length].tobytes())
                at += p.length
            assert at == len(full)
        for pieces in inside.values():
            total = sum(p.length for p in pieces)
            assert len(pieces) <= 8 and sum(p.loss_tokens for p in pieces) <= 200 and (total == 256 or total & (total - 1) == 0 and total < 256)
            assert sorted(p.offset for p in pieces) == np.cumsum([0, *[p.length for p in sorted(pieces, key=lambda p: p.offset)]])[:-1].tolist()
    assert packing.packed(df.limit(0)).count() == 0


# ---- spelling variants


def plain_variants(counts):
    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]

    found = {}
    for w, n in counts.items():
        others = [o for o in counts if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        found[w] = (form, n, len(others), counts[form] if form else None)
    out = {}
    for w, (form, *rest) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out[w] = (form, root, *rest)
    return out


def test_variants_of_a_dense_vocabulary(spark):
    rng = random.Random(8)
    words = {"".join(rng.choices("abé", k=rng.randint(3, 6))): rng.choice([1, 2, 3, 20, 300, 5000]) for _ in range(260)}
    words |= {"a" * k: 10 ** (k % 5) for k in range(1, 12)} | {"×÷ÿ": 4, "×÷": 50, "×ÿ÷": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    want = plain_variants(words)
    try:
        for parts in ("1", "23"):  # with many ranges most paths cross a boundary
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(df).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] and v[0] != v[1] for v in want.values())


def test_nodes_of_two_ranges_have_one_number(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(200)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with Scratch(spark, "test-trie") as scratch:
            table = scratch.save(variants._numbered(df, "word", "path"), "trie")
            same = variants.shared_nodes(table, "word", "path")
            number = {}
            for r in table.collect():
                for k, node in enumerate(variants._renamed(np.array(r.path), same).tolist()):
                    if k:
                        assert number.setdefault(r.word[:k], node) == node
            assert table.select("part").distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(set(number.values())) == len(number)


def test_variants_of_odd_documents(spark):
    long = "q" * 3000
    texts = ["Alphabet alphabet ALPHABET", "alphabets alphabe", None, "", "123 ... \n", f"{long} {long} {long}x", "alphabet\x00alphabet", "straße Straßen straßen"] * 6
    rows = [(None if i % 7 == 0 else i % 5, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    want = plain_variants({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.variants(variants.vocabulary(variants.damaged_words(df))).collect()}
    assert got == want and long in got
    assert variants.variants(variants.vocabulary(variants.damaged_words(df.limit(0)))).count() == 0
