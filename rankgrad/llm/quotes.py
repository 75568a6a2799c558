"""Quotation linking, with DataFrame functions only.

Messages are split into passages of equal quote level (``>`` marks). A quoted
passage is normalised (blanks collapsed, lower case) and hashed, and joined to
the original: the earliest message that holds the same words as its own text or
as one of its lines, in the same conversation if there is one, else in another
(the least of that text, or the greatest where the least is the one that quotes).
A passage that has no original as a whole is tried line by line, and the first
line that has one links it. The first linked
passage of level 1 names the message that is replied to; conversations come out
in reply order (``thread_turn``, ``depth``, ``turn``) and without quotes.

Every join has unique keys on its right side, so a text or conversation that is
a third of all rows gives no more rows than it has, and AQE may split it.

Defined results: a null text is empty; a message with a null conversation or turn
is its own thread at depth 0 and is never an original; repeated rows of one
(conversation, turn) each give a row, and as nodes of the thread they are one,
with the earliest parent. Passages without words link to nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved

MARKS = r"^(?: {0,3}> ?)+"
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text) -> F.Column:
    """Blanks collapsed and trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, BLANKS, " ")))


def own_text(body) -> F.Column:
    """Without blanks at either end."""
    return F.regexp_replace(F.regexp_replace(body, "^" + BLANKS, ""), BLANKS + "$", "")


def _key(text) -> F.Column:
    return F.when(text != "", F.unhex(F.substring(F.sha2(text, 256), 1, 40)))


def _keys(text) -> F.Column:
    """Keys of a text by trial: the whole, then its lines in order; without words none."""
    return F.filter(F.transform(F.array_distinct(F.concat(F.array(normalised(text)), F.transform(F.split(text, "\n"), normalised))), _key),
                    lambda key: key.isNotNull())


def passages(messages: DataFrame) -> DataFrame:
    """``messages`` (text) with ``passages``: array of (level, body), in order."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_substr(line, F.lit(MARKS)), "[^>]", "")).alias("depth"), line.alias("line")))
    lines = F.transform(lines, lambda x: F.struct(
        F.coalesce(x["depth"], F.lit(0)).alias("level"), F.regexp_replace(x["line"], MARKS, "").alias("body")))
    with_lines = messages.withColumn("quote_lines", lines)
    last = F.size("quote_lines")
    at = lambda i: F.element_at("quote_lines", i)
    starts = F.filter(F.sequence(F.lit(1), last), lambda i: F.when(i == 1, True).otherwise(
        at(i)["level"] != at(F.greatest(i - 1, F.lit(1)))["level"]))
    with_starts = with_lines.withColumn("quote_starts", starts)
    body = F.transform("quote_starts", lambda s, k: F.struct(
        at(s)["level"].alias("level"),
        F.array_join(F.transform(
            F.slice("quote_lines", s, F.coalesce(F.get("quote_starts", k + 1), last + 1) - s),
            lambda x: x["body"]), "\n").alias("body")))
    return with_starts.withColumn("passages", body).drop("quote_lines", "quote_starts")


def link(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) in reply order without quotes.

    Adds ``n_quotes``, ``n_linked``, ``parent_turn`` (same conversation),
    ``source_conv`` (of the first linked passage), ``thread_turn`` and ``depth``.
    """
    with Scratch(messages.sparkSession, "quotes") as scratch:
        return saved(_linked(messages, scratch), "quote-threads")


def _linked(messages: DataFrame, scratch: Scratch) -> DataFrame:
    own = F.array_join(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["body"]), "\n")
    quoted = F.filter(F.transform("passages", lambda p, place: F.struct(place.alias("place"), p["level"].alias("level"), p["body"].alias("body"))),
                      lambda p: p["level"] > 0)
    rows = scratch.save(passages(messages.select("conv_id", "turn", "role", "text")).select(
        F.monotonically_increasing_id().alias("row_id"), "conv_id", "turn", "role", own_text(own).alias("text"),
        quoted.alias("quoted"), F.size(quoted).cast("long").alias("n_quotes")), "rows")
    here = (rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
            .select("conv_id", "turn", F.explode(_keys(F.col("text"))).alias("key"))
            .groupBy("key", "conv_id").agg(F.min("turn").alias("first_turn")))
    # two conversations of a text: one of them is another than the one that quotes it
    anywhere = here.groupBy("key").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))

    tries = (rows.select("row_id", "conv_id", "turn", F.explode("quoted").alias("p"))
             .select("row_id", "conv_id", "turn", "p.place", "p.level", F.posexplode(_keys(F.col("p.body"))).alias("try", "key")))
    mine = here.withColumnRenamed("conv_id", "c").withColumnRenamed("key", "k")
    near, conv = F.col("first_turn") < F.col("turn"), F.col("conv_id")
    found = (tries.join(mine, (F.col("key") == F.col("k")) & (conv == F.col("c")), "left").drop("k", "c")
             .join(anywhere.withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
             .withColumn("to_turn", F.when(near, F.col("first_turn")))
             .withColumn("to_conv", F.when(near, conv).when(~F.col("low").eqNullSafe(conv), F.col("low"))
                         .when(~F.col("high").eqNullSafe(conv), F.col("high")))
             .where("to_conv is not null").repartition("row_id"))
    by_passage = found.groupBy("row_id", "place", "level").agg(F.min(F.struct("try", "to_conv", "to_turn")).alias("hit"))
    by_row = by_passage.groupBy("row_id").agg(
        F.count("*").alias("n_linked"),
        F.min(F.when((F.col("level") == 1) & F.col("hit.to_turn").isNotNull(),
                     F.struct("place", "hit.to_turn"))).alias("reply"),
        F.min(F.struct("place", "hit.to_conv")).alias("source"))
    replies = scratch.save(rows.join(by_row, "row_id", "left").select(
        "conv_id", "turn", "role", "text", "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("reply.to_turn").alias("parent_turn"), F.col("source.to_conv").alias("source_conv")), "replies")
    heads = thread_heads(replies, scratch).select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "head", "steps")
    above = replies.join(heads, (F.col("conv_id") == F.col("c")) & (F.col("parent_turn") == F.col("t")), "left")
    return above.select(*replies.columns,
                        F.coalesce("head", "parent_turn", "turn").alias("thread_turn"),
                        F.when(F.col("parent_turn").isNull(), 0).otherwise(F.coalesce("steps", F.lit(0)) + 1).cast("long").alias("depth"))


def thread_heads(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, head, steps): the first message of each one's thread, by pointer doubling."""
    nodes = (replies.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("up")))
    state = scratch.save(nodes.select("conv_id", "turn", F.coalesce("up", "turn").alias("head"),
                               F.when(F.col("up").isNull(), 0).otherwise(1).alias("steps"),
                               F.col("up").isNotNull().alias("open")), "heads")
    while state.where("open").limit(1).count():
        up = state.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("head").alias("next"), F.col("steps").alias("more"))
        # a head is at its end once it points to itself; only the others go on
        moved = state.where("open").join(up, (F.col("conv_id") == F.col("c")) & (F.col("head") == F.col("t"))).select(
            "conv_id", "turn", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("more") > 0).alias("open"))
        state = scratch.replace(state, state.where("not open").unionByName(moved), "heads")
    return state.drop("open")


def with_reply_quotes(conversations: DataFrame) -> DataFrame:
    """Turns as a mail program sends them: the two turns before, quoted, above each text."""
    turns = conversations.select("conv_id", "turn", "role", "text")
    texts = (turns.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .groupBy("conv_id", "turn").agg(F.min("text").alias("text")))

    def before(k):
        return texts.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("text").alias(f"text_{k}"))

    quote = lambda c, mark: F.concat(F.regexp_replace(c, "(?m)^", mark), F.lit("\n"))
    parts = [F.coalesce(quote(F.col("text_2"), ">> "), F.lit("")), F.coalesce(quote(F.col("text_1"), "> "), F.lit("")),
             F.coalesce("text", F.lit(""))]
    joined = reduce(lambda d, k: d.join(before(k), ["conv_id", "turn"], "left"), (1, 2), turns)
    return joined.select("conv_id", "turn", "role", F.concat(*parts).alias("text"))


def op3_quotation_linking(spark, sf_dir: str) -> DataFrame:
    """Every conversation, sent as quoting replies, read back in reply order without quotes."""
    return link(with_reply_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


_NORM = r"lower(trim(regexp_replace({0}, '[\x20\x09-\x0D]+', ' ', 'g')))"
_TRIM = r"regexp_replace(regexp_replace({0}, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"
SQL = f"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, {_TRIM.format("coalesce(text, '')")} AS text, coalesce(text, '') AS sent FROM conversations),
k AS (SELECT DISTINCT conv_id, turn, {_NORM.format("x")} AS key FROM (
  SELECT conv_id, turn, text AS x FROM m UNION ALL SELECT conv_id, turn, unnest(string_split(text, chr(10))) FROM m)),
here AS (SELECT key, conv_id, min(turn) AS t FROM k WHERE key <> '' GROUP BY 1, 2),
anywhere AS (SELECT key, min(conv_id) AS low, max(conv_id) AS high FROM k WHERE key <> '' GROUP BY 1),
q AS (SELECT a.conv_id, a.turn, l.level, b.sent FROM m a CROSS JOIN (VALUES (1), (2)) l(level)
      JOIN m b ON b.conv_id = a.conv_id AND b.turn = a.turn - l.level),
y AS (SELECT conv_id, turn, level, 0 AS try, {_NORM.format("sent")} AS key FROM q UNION ALL
      SELECT conv_id, turn, level, i, {_NORM.format("string_split(sent, chr(10))[i]")}
      FROM (SELECT *, unnest(range(1, len(string_split(sent, chr(10))) + 1)) AS i FROM q)),
z AS (SELECT y.conv_id, y.turn, y.level, y.try, CASE WHEN w.t < y.turn THEN w.t END AS t,
        CASE WHEN w.t < y.turn THEN y.conv_id WHEN g.low <> y.conv_id THEN g.low WHEN g.high <> y.conv_id THEN g.high END AS c
      FROM y LEFT JOIN here w ON w.key = y.key AND w.conv_id = y.conv_id LEFT JOIN anywhere g ON g.key = y.key),
h AS (SELECT q.conv_id, q.turn, q.level, b.x.c AS c, b.x.t AS t FROM q LEFT JOIN (
        SELECT conv_id, turn, level, arg_min({{'c': c, 't': t}}, try) AS x FROM z WHERE c IS NOT NULL GROUP BY ALL) b USING (conv_id, turn, level)),
r AS (SELECT conv_id, turn, count(*) AS n_quotes, count(c) AS n_linked, min(CASE WHEN level = 1 THEN t END) AS parent_turn,
        arg_max(c, level) AS source_conv FROM h GROUP BY 1, 2),
d AS (SELECT m.conv_id, m.turn, m.turn AS thread_turn, 0 AS depth FROM m LEFT JOIN r USING (conv_id, turn) WHERE r.parent_turn IS NULL
  UNION ALL SELECT r.conv_id, r.turn, d.thread_turn, d.depth + 1 FROM d JOIN r ON r.conv_id = d.conv_id AND r.parent_turn = d.turn)
SELECT m.conv_id, m.turn, m.role, m.text, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
  parent_turn, source_conv, thread_turn, CAST(depth AS BIGINT) AS depth
FROM m LEFT JOIN r USING (conv_id, turn) JOIN d USING (conv_id, turn)
"""
