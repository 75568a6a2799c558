"""Conversation structure repair over a suffix-shared automaton of signatures.

A conversation's signature is one letter per row: the row's role and fault. Read from
the end, equal signatures are equal paths, so all signatures form one automaton whose
nodes are their distinct suffixes. Words (signatures from their end) are sorted over the
cluster and streamed: each task keeps the path of the last word, and a word adds only
the nodes that it does not share with the one before. A node gets, once, for each state
of the role grammar, the cost-to-go and the first edit of the best audit suffix. With at
most one edit of each letter per node and state, equal costs are settled by the letter,
so the audit read off the path is the ASCII-least of the cheapest.

1. Rows are damaged, folded to one row per (conversation, turn, role, text digest) with
   its number of copies, and first occurrences are found by aggregates.
2. Each conversation's rows stream once, from the last, into its word and fault counts.
3. Words are sorted by range, hot words split by conversation; the automaton gives cost
   and audit.
4. Audits and texts meet per conversation, in order; the repaired text is hashed as it
   streams, never held. A task holds the audit and about 40 bytes for each row of one
   conversation, as the audit is one value of the result.

Defined results: nulls are one space (a null conv_id in the damage key only: its rows are
one conversation, returned as null); rows of one turn go by role, then SHA-256 of the
text; rows alike in all of these repeat each other; a role without a first letter of
s, u, a can only be rerolled or deleted; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved

BLANKS = " \t\n\x0b\x0c\r"
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. What a kept row needs, where it leads.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: State after a rerole or an insertion, and the role that it gives.
NEXT = (2, 2, 3, 2)
GIVES = ("user", "user", "assistant", "user")
ENDS = (0, 3)


class Costs(NamedTuple):
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Automaton:
    """The path of the last word: per node four costs-to-go and four first edits.

    Words are given from a conversation's end. Letters: x must go; s, u, a, o is the
    role (o: any other), upper case if the row is truncated.
    """

    def __init__(self, costs: Costs = Costs()):
        self.pay, self.word, self.known = costs, "", {}
        base = [(0, ".") if q in ENDS else None for q in range(4)]
        first = self._with_inserts(base)
        self.costs = array("q", [c for c, _ in first])
        self.edits = bytearray("".join(e for _, e in first), "ascii")
        self.nodes = 1

    def _with_inserts(self, base: list) -> list[tuple[int, str]]:
        """Adds insertions before a node's own edits; of equal costs the least letter."""
        least = lambda q, then: min([x for x in (base[q], (then + self.pay.insert, "I") if then is not None else None) if x])
        at = lambda x: x[0] if x else None
        user, assistant = least(2, at(base[3])), least(3, at(base[2]))
        return [least(0, user[0]), least(1, user[0]), user, assistant]

    def _step(self, letter: str, after: tuple[int, ...]) -> tuple[list[int], bytes]:
        """Costs and first edits of a node from its letter and the costs of the node after."""
        role, late = letter.lower(), self.pay.truncated if letter.isupper() else 0
        base = []
        for q in range(4):
            own = [(after[q] + self.pay.delete, "D")]
            if role != "x":
                own.append((after[NEXT[q]] + self.pay.rerole + late, "R"))
                if role in KEEP[q]:
                    own.append((after[KEEP[q][role]] + self.pay.keep + late, "K"))
            base.append(min(own))
        made = self._with_inserts(base)
        return [c for c, _ in made], "".join(e for _, e in made).encode()

    def read(self, word: str) -> tuple[int, str]:
        """Least cost and audit of a word; nodes shared with the last word are kept."""
        shared, most = 0, min(len(word), len(self.word))
        while shared < most and word[shared] == self.word[shared]:
            shared += 1
        del self.costs[4 * (shared + 1):], self.edits[4 * (shared + 1):]
        for letter in word[shared:]:
            after = self.costs[-4:]
            low = min(after)
            key = letter, *(c - low for c in after)  # few differ: costs of one node's states lie close
            if key not in self.known:
                self.known[key] = self._step(letter, key[1:])
            costs, edits = self.known[key]
            self.costs.extend(c + low for c in costs)
            self.edits += edits
            self.nodes += 1
        self.word = word
        state, depth, audit = 0, len(word), bytearray()
        while (edit := self.edits[4 * depth + state]) != 46:  # the end's '.'
            audit.append(edit)
            if edit == 75:  # K
                state = KEEP[state][word[depth - 1].lower()]
            elif edit != 68:  # I and R, not D
                state = NEXT[state]
            depth -= edit != 73  # I
        return self.costs[4 * len(word)], audit.decode()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of conversation rows; ``copies`` 0 are dropped rows."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    h, text = F.col("h"), F.coalesce("text", one)
    return rows.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("h")).select(
        "conv_id", "turn",
        F.when(h == 4, "user").otherwise(F.coalesce("role", one)).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).cast("long").alias("copies"))


def signed(rows: DataFrame) -> DataFrame:
    """One row per (conv_id, turn, role, digest of the text): copies, blank, late, and whether it holds the first of its role and text."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    folded = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), (last == "").alias("blank"),
                         (~last.isin(".", "!", "?")).alias("late"), "copies").groupBy(
        "conv_id", "turn", "role", "digest", "blank", "late").agg(F.sum("copies").alias("copies"))
    some = folded.where("copies > 0")
    first = some.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.when(F.count("*") == F.count("turn"), F.min("turn")).alias("t"))
    same = (folded.conv_id.eqNullSafe(first.c) & (folded.role == first.r) & (folded.digest == first.d) & folded.turn.eqNullSafe(first.t))
    return folded.join(first, same, "left").select(*folded.columns, F.col("d").isNotNull().alias("first"))


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
GOOD_PAIRS = {"su", "ua", "au"}


def _spell(batches):
    """Words and fault counts from rows in falling order within each conversation."""
    held, rows = None, []

    def batch():
        out = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], type=kind), *[pa.array(c, type=pa.int64()) for c in out[1:6]], pa.array(out[6], type=pa.string())],
            names=["conv_id", *COUNTS, "word"])

    def close():
        conv, turns, top, low, counts, word, _ = held
        counts[0] = top - low + 1 - turns if turns else 0
        rows.append((conv, *counts, "".join(word)))

    for b in batches:
        kind = b.column(0).type
        for conv, turn, role, blank, late, copies, first in zip(*[c.to_pylist() for c in b.columns]):
            if held is None or held[0] != conv:
                if held:
                    close()
                    if len(rows) >= 10_000:
                        yield batch()
                held = [conv, 0, None, None, [0] * 5, [], None]
            if not copies:
                continue
            counts, word = held[4], held[5]
            if turn is not None and turn != held[3]:
                held[1] += 1
                held[2] = turn if held[2] is None else held[2]
                held[3] = turn
            # the first of its role and text stands before its copies
            fresh = 1 if first and not blank else 0
            counts[1] += copies if blank else 0
            counts[2] += 0 if blank else copies - fresh
            counts[3] += 1 if fresh and late else 0
            letter = role if role in ("s", "u", "a") else "o"
            word.append("x" * (copies - fresh) + ((letter.upper() if late else letter) if fresh else ""))
            if held[6] is not None:
                counts[4] += role + held[6] not in GOOD_PAIRS
            counts[4] += copies - 1
            held[6] = role
    if held:
        close()
    if rows:
        yield batch()


def words(rows: DataFrame) -> DataFrame:
    """(conv_id, fault counts, word) per conversation of ``damaged`` rows."""
    order = [F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest")]
    conv = rows.schema["conv_id"].dataType.simpleString()
    return (signed(rows).repartition("conv_id").sortWithinPartitions("conv_id", *order)
            .select("conv_id", "turn", F.left("role", F.lit(1)).alias("role"), "blank", "late", "copies", "first")
            .mapInArrow(_spell, f"conv_id {conv}, {', '.join(f'{n} long' for n in COUNTS)}, word string"))


def priced(spelt: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``spelt`` (conv_id, word, ...) with cost and audit in place of the word.

    Sorted by word over ranges of (word, conversation): neighbours share most of their
    path, and a word of many conversations is split over tasks.
    """
    pay = tuple(costs)
    names = [n for n in spelt.columns if n != "word"]

    def run(batches):
        automaton = Automaton(Costs(*pay))
        last, found = None, None
        for b in batches:
            cost, audit = [], []
            for word in b.column(len(names)).to_pylist():
                if word != last:
                    last, found = word, automaton.read(word)
                cost.append(found[0])
                audit.append(found[1])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                             names=[*names, "cost", "audit"])

    schema = ", ".join(f"{n} {spelt.schema[n].dataType.simpleString()}" for n in names) + ", cost long, audit string"
    return (spelt.select(*names, "word").repartitionByRange("word", "conv_id").sortWithinPartitions("word", "conv_id")
            .mapInArrow(run, schema))


def _rewrite(batches):
    """Rows of each conversation, the one with its audit first, to the hash of the repaired text."""
    held, rows = None, []

    def batch():
        out = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], type=kind), *[pa.array(c, type=pa.int64()) for c in out[1:7]], pa.array(out[7], pa.string()), pa.array(out[8], pa.string())],
            names=["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"])

    class Rewriter:
        def __init__(self, conv, found):
            self.conv, self.found, self.audit = conv, found, found["audit"]
            self.hash, self.at, self.state, self.lines = hashlib.sha256(), 0, 0, 0

        def say(self, role, text):
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

        def inserts(self):
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.say(GIVES[self.state], "")
                self.state = NEXT[self.state]
                self.at += 1

        def row(self, role, text):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.say(role, text)
                self.state = KEEP[self.state][role[0]]
            elif edit == "R":
                self.say(GIVES[self.state], text)
                self.state = NEXT[self.state]

        def close(self):
            self.inserts()
            rows.append((self.conv, *[self.found[n] for n in (*COUNTS, "cost", "audit")], self.hash.hexdigest()))

    for b in batches:
        kind = b.column(0).type
        for conv, found, role, text, copies in zip(*[c.to_pylist() for c in b.columns]):
            if found is not None:
                if held:
                    held.close()
                    if len(rows) >= 10_000:
                        yield batch()
                held = Rewriter(conv, found)
                continue
            for _ in range(copies):
                held.row(role, text)
    if held:
        held.close()
    if rows:
        yield batch()


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The result per conversation from ``damaged`` rows and ``priced`` audits."""
    found = F.struct(*COUNTS, "cost", "audit")
    null = lambda kind: F.lit(None).cast(kind)
    turn, conv = (rows.schema[n].dataType.simpleString() for n in ("turn", "conv_id"))
    heads = audits.select("conv_id", found.alias("found"), null(turn).alias("turn"), null("string").alias("role"), null("binary").alias("digest"),
                          null("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    kind = audits.select(found.alias("f")).schema["f"].dataType.simpleString()
    body = rows.where("copies > 0").select("conv_id", null(kind).alias("found"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text", "copies")
    return (heads.unionByName(body).repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("found").isNull(), F.asc_nulls_first("turn"), "role", "digest")
            .select("conv_id", "found", "role", "text", "copies")
            .mapInArrow(_rewrite, f"conv_id {conv}, {', '.join(f'{n} long' for n in (*COUNTS, 'cost'))}, audit string, repaired_sha256 string"))


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text, copies)."""
    with Scratch(rows.sparkSession, "repair") as scratch:
        spelt = scratch.save(words(rows), "words")
        return saved(repaired(rows, priced(spelt, costs)), "repaired")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Damage to every conversation, and the cheapest repair of it."""
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


#: The CRC-32 table for four bits at a time.
CRC_NIBBLES = [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
               3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]


def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of a string expression's UTF-8 bytes."""
    table = f"({CRC_NIBBLES}::UBIGINT[])"
    half = lambda c: f"xor({c} >> 4, {table}[({c} & 15)::BIGINT + 1])"
    codes = f"list_transform(range(octet_length(encode({text}))::BIGINT), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::UBIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), lambda c, b: {half(half('xor(c, b)'))}), 4294967295)"


def _step_sql(state: int) -> str:
    """A state's cheapest edit of one row, before insertions."""
    role = " OR ".join(f"(initial = '{r}')" for r in KEEP[state])
    to = " ".join(f"WHEN '{r}' THEN s{q}" for r, q in KEEP[state].items())
    after = f"(CASE initial {to} END)"
    given = f"s{NEXT[state]}"
    return (f"list_min([{{'c': s{state}.c + 2, 'a': 'D' || s{state}.a, 'l': s{state}.l}}, "
            f"CASE WHEN NOT must AND ({role}) THEN {{'c': {after}.c + extra, 'a': 'K' || {after}.a, 'l': role || ':' || text || chr(10) || {after}.l}} END, "
            f"CASE WHEN NOT must THEN {{'c': {given}.c + 1 + extra, 'a': 'R' || {given}.a, 'l': '{GIVES[state]}:' || text || chr(10) || {given}.l}} END])")


def _insert_sql(state: int, at: str) -> str:
    return f"{{'c': {at}.c + 5, 'a': 'I' || {at}.a, 'l': '{GIVES[state]}:' || chr(10) || {at}.l}}"


SQL = f"""
WITH RECURSIVE coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h
    FROM conversations),
hurt AS (
    SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN h = 0 THEN 0 WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded),
placed AS (
    SELECT *, left(role, 1) AS initial, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS tail,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
    FROM hurt),
judged AS (
    SELECT conv_id, turn, role, text, initial, tail = '' OR nth > 1 AS must,
           tail = '' AS blank, tail <> '' AND nth > 1 AS duplicate,
           tail <> '' AND nth = 1 AND tail NOT IN ('.', '!', '?') AS late,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal,
           row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) AS back,
           CASE WHEN tail NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra
    FROM placed),
walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS back,
           {{'c': 0, 'a': '', 'l': ''}} AS s0, {{'c': 10, 'a': 'II', 'l': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS s1,
           {{'c': 5, 'a': 'I', 'l': 'assistant:' || chr(10)}} AS s2, {{'c': 0, 'a': '', 'l': ''}} AS s3
    FROM conversations
    UNION ALL
    SELECT conv_id, back, list_min([b0, {_insert_sql(0, "list_min([b2, " + _insert_sql(2, "b3") + "])")}]),
           list_min([b1, {_insert_sql(1, "list_min([b2, " + _insert_sql(2, "b3") + "])")}]),
           list_min([b2, {_insert_sql(2, "b3")}]), list_min([b3, {_insert_sql(3, "b2")}])
    FROM (
        SELECT w.conv_id, j.back, {_step_sql(0)} AS b0, {_step_sql(1)} AS b1, {_step_sql(2)} AS b2, {_step_sql(3)} AS b3
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.back = w.back + 1)),
done AS (SELECT conv_id, arg_max(s0, back) AS s FROM walk GROUP BY conv_id),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (late) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       s.c::BIGINT AS cost, s.a AS audit, sha256(left(s.l, greatest(length(s.l) - 1, 0))) AS repaired_sha256
FROM done d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
"""
