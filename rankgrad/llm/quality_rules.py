"""Quality rules: a decision list learned by sequential covering.

``with_statistics`` measures every whole text; ``learn_rules`` grows and prunes
conjunctions of thresholds over labelled statistics, one rule after the other;
``rules_column`` emits the ordered list as one Spark conditional expression.

Defined results: a null or empty text has no words, so every count is 0 and the
base rule fails it. Labels without a document, null labels and null ids teach
nothing; of repeated label rows the lowest quality counts. Without usable labels
the list is empty and only the base rule rejects. Rows are never merged: repeated
rows each get the same verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, utf8

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_distinct", "longest_run"]
FIELDS = [(n, T.LongType()) for n in COUNTS]
_UPPER, _LOWER, _DIGITS = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in SYMBOLS and chr(c) not in ".,'-\"")


def _kept(text: bytes, keep: bytes, everything=bytes(range(256))) -> int:
    return len(text.translate(None, everything.translate(None, keep)))


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one whole UTF-8 text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()  # on the six ASCII blanks, exactly
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - _kept(text, BLANKS)
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(BLANKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        once, again = set(), set()
        for w in windows:
            (again if w in once else once).add(w)
        last = -1  # end of the words that are marked so far
        for i, w in enumerate(windows):
            if w in again:
                repeated += i + 3 - max(i, last)
                last = i + 3
    run = longest = 1 if n else 0
    if n and len(set(words)) < n:
        for a, b in zip(words, words[1:]):
            run = run + 1 if a == b else 1
            if run > longest:
                longest = run
    return (n, chars, _kept(text, SYMBOLS), dup, repeated, lines, _kept(text, _UPPER), _kept(text, _LOWER),
            _kept(text, _DIGITS), _kept(text, _MARKS), len(set(words)), longest)


def _counter():
    return lambda texts: list(zip(*map(text_counts, utf8(texts)))) or [[] for _ in COUNTS]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS``; columns of these names are replaced."""
    return add_columns(docs, [text_col], FIELDS, _counter)


def features() -> dict[str, F.Column]:
    """What rules may test, as columns over the counts."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "chars_per_word": share("word_chars", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct", "n_words"),
        "upper_letters": F.when(F.col("n_upper") + F.col("n_lower") > 0, F.col("n_upper") / (F.col("n_upper") + F.col("n_lower"))).otherwise(0.0),
        "digits_per_char": share("n_digits", "word_chars"),
        "longest_run": F.col("longest_run").cast("double"),
    }


@dataclass(frozen=True)
class Test:
    """One threshold: ``feature <= value`` or ``feature >= value``."""

    feature: str
    below: bool
    value: float

    def column(self) -> F.Column:
        c = features()[self.feature]
        return c <= self.value if self.below else c >= self.value

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x <= self.value if self.below else x >= self.value


def covered(rule: tuple[Test, ...], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for t in rule:
        hit &= t.holds(table)
    return hit


def _grow(table, bad, alive, cuts, max_tests) -> tuple[Test, ...]:
    """Adds the test of highest information gain until no good row is left."""
    rule, hit = (), alive.copy()
    while len(rule) < max_tests:
        p0, n0 = int((hit & bad).sum()), int((hit & ~bad).sum())
        if not p0 or not n0:
            break
        base, best, found = np.log2(p0 / (p0 + n0)), 1e-9, None
        for name, values in cuts.items():
            x, y = table[name][hit], bad[hit]
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            up_to = np.concatenate([[0], np.cumsum(y)])
            for below, at in ((True, np.searchsorted(x, values, "right")), (False, np.searchsorted(x, values, "left"))):
                p = up_to[at] if below else p0 - up_to[at]
                total = at if below else len(x) - at
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(total, 1)) - base), 0)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, found = gain[k], Test(name, below, float(values[k]))
        if not found:
            break
        rule += (found,)
        hit &= found.holds(table)
    return rule


def _prune(rule, table, bad, alive):
    """Drops last tests while that doesn't lower (p - n) / (p + n) on held rows."""
    def worth(r):
        hit = covered(r, table, len(bad)) & alive
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_rules(table: dict[str, np.ndarray], bad: np.ndarray, *, min_precision: float = 0.97,
                min_cover: int = 5, max_tests: int = 4, cuts_per_feature: int = 64) -> list[tuple[Test, ...]]:
    """Ordered rules that reject, learned by sequential covering.

    Every third row is held for pruning. A rule is kept if it covers at least
    ``min_cover`` rejected rows with ``min_precision`` on all rows that no
    earlier rule covers; the first rule that isn't ends the list.
    """
    n = len(bad)
    held = np.arange(n) % 3 == 2
    cuts = {}
    for name, x in table.items():
        v = np.unique(x)
        # class boundaries lie between values; thin them evenly
        mid = (v[1:] + v[:-1]) / 2
        cuts[name] = mid[np.unique(np.linspace(0, len(mid) - 1, cuts_per_feature).astype(int))] if len(mid) else mid
    cuts = {k: v for k, v in cuts.items() if len(v)}
    rules, left = [], np.ones(n, bool)
    while cuts and (left & bad).any():
        rule = _grow(table, bad, left & ~held, cuts, max_tests)
        if not rule:
            break
        rule = _prune(rule, table, bad, left & held)
        hit = covered(rule, table, n) & left
        p, total = int((hit & bad).sum()), int(hit.sum())
        if p < min_cover or p < min_precision * total:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rules_column(rules: list[tuple[Test, ...]], default: bool = True) -> F.Column:
    """The list as ``when(rule 1, False).when(rule 2, False) ... otherwise(True)``."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for t in rule[1:]:
            test = test & t.column()
        out = F.when(test, not default) if out is None else out.when(test, not default)
    return F.lit(default) if out is None else out.otherwise(default)


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 8000, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", **options) -> list[tuple[Test, ...]]:
    """Rules from the statistics of a bounded sample of labelled documents.

    The sample is the ``max_labelled`` ids of lowest hash. Only its numbers come to
    the driver: one row of statistics per sampled id, the least one where an id has
    several rows.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label")))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    picked = texts.join(F.broadcast(sample), "id")  # bounded by max_labelled
    wanted = features()
    got = (with_statistics(picked).where(~base_failed())
           .groupBy("id").agg(F.min(F.struct(*[c.alias(k) for k, c in wanted.items()], "label")).alias("row"))
           .select("id", "row.*").toPandas().sort_values(["id", *wanted], kind="stable"))
    rng = np.random.default_rng(7)
    got = got.iloc[rng.permutation(len(got))]
    return learn_rules({k: got[k].to_numpy(float) for k in wanted}, (got["label"] == 0).to_numpy(), **options)


def judge(docs: DataFrame, rules: list[tuple[Test, ...]], text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    measured = with_statistics(docs, text_col)
    failed = base_failed()
    return measured.withColumns({"base_failed": failed, "kept": ~failed & rules_column(rules)})


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Verdict of the learned decision list for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = judge(docs, fit(docs, labels))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the list keeps, columns unchanged."""
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # own names for the columns that pass through, so that none clashes with a count
    passed = docs.toDF(*[f"passed_{i}" for i in range(len(docs.columns))])
    text = f"passed_{docs.columns.index('text')}"
    return judge(passed, rules, text).where("kept").select(*passed.columns).toDF(*docs.columns)
