"""Language ID by a bidirectional gated recurrent network over bytes.

``fit`` learns from windows of every learnable document, by backpropagation through
time: in rounds, each shard of the windows goes on from the network of the round
before in its own task (``trained``), and the shards' networks are averaged on the
cluster. ``Network.probabilities`` labels every byte of a whole text (in windows that
are read both ways) and pools the probabilities of its letters over the document.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
null ids and repeated rows give a row each (a null id isn't held out). Without
labelled documents to learn from, every document is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_columns, saved, settings, small_batches, utf8

WINDOW = 96
ROUNDS = 6
BATCH = 256  # windows of a step
SHARD = 24 * BATCH  # windows of a shard and round, about
ROW_GROUP = 4 << 20  # bytes of windows that a task holds for each round before it writes them
PLACES = 10_000  # steps in which certainties are counted
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


class Network:
    """Weights: per direction an input table (256 bytes), a recurrent matrix and an output matrix."""

    def __init__(self, languages: list[str], units: int, rng: np.random.Generator):
        k, h = len(languages), units
        self.languages, self.units = languages, h
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {"bias": np.zeros((k, 1), np.float32)}
        for d in "fb":
            self.weights |= {f"in_{d}": normal(3 * h, 256, scale=0.3), f"rec_{d}": normal(3 * h, h, scale=h ** -0.5),
                             f"out_{d}": normal(k, h, scale=h ** -0.5)}

    def _run(self, x: np.ndarray, valid: np.ndarray, d: str, keep: bool = False):
        """States of one direction (time x units x batch); with ``keep``, also what backpropagation needs.

        That is the gates (update, reset and candidate) and what the recurrent matrix gave for
        them, of every time. Without it, every time is computed in the same place.
        """
        n, batch = x.shape
        u = self.units
        # tanh(x / 2) / 2 + 1 / 2 is the gate's sigmoid; halved weights give the same x / 2
        half = np.repeat([0.5, 0.5, 1], u).astype(np.float32)[:, None]
        table, rec = self.weights[f"in_{d}"] * half, self.weights[f"rec_{d}"] * half
        gates, pre = (np.empty((n if keep else 1, 3 * u, batch), table.dtype) for _ in range(2))
        states, h, reset = np.empty((n, u, batch), table.dtype), np.zeros((u, batch), table.dtype), np.empty((u, batch), table.dtype)
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            now, from_h = gates[t if keep else 0], pre[t if keep else 0]
            zr, new, after = now[:2 * u], now[2 * u:], states[t]
            np.matmul(rec, h, out=from_h)
            table.take(x[t], axis=1, out=now, mode="clip")
            zr += from_h[:2 * u]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            new += np.multiply(zr[u:], from_h[2 * u:], out=reset)
            np.tanh(new, out=new)
            np.subtract(h, new, out=after)
            after *= zr[:u]
            after += new
            after *= valid[t]
            h = after
        return states, (gates, pre)

    def _softmax(self, states_f, states_b):
        w = self.weights
        scores = w["out_f"] @ states_f
        scores += w["out_b"] @ states_b
        scores += w["bias"]
        scores -= scores.max(axis=-2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=-2, keepdims=True)
        return scores

    def window_sums(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window (batch x bytes): sum over its letters of the position probabilities, and their number."""
        x = np.ascontiguousarray(windows.T)
        valid = (np.arange(x.shape[0])[:, None] < lengths[None, :]).astype(np.float32)[:, None, :]
        back, _ = self._run(x, valid, "b")
        front, _ = self._run(x, valid, "f")
        counted = LETTERS[x][:, None, :] * valid
        p = self._softmax(front, back)
        p *= counted
        return p.sum(axis=0).T, counted.sum(axis=0)[0]

    def probabilities(self, texts: list[bytes], batch: int = 1024) -> np.ndarray:
        """Pooled probabilities of each whole text (rows of zeros for texts without letter bytes)."""
        return self.read(texts, batch)[0]

    def read(self, texts: list[bytes], batch: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Pooled probabilities of each whole text, and how sure its windows are, each of its own best language.

        A text that changes from one learned language to another has low pooled
        probabilities and sure windows. Texts without letter bytes have zeros.
        """
        counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        sums, sure, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts))
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        for lo in range(0, len(owner), batch):
            own, at = owner[lo:lo + batch], place[lo:lo + batch]
            pieces = [texts[o][p * WINDOW:(p + 1) * WINDOW] for o, p in zip(own, at)]
            lengths = np.array([len(p) for p in pieces])
            x = np.frombuffer(b"".join(p.ljust(WINDOW, b"\0") for p in pieces), np.uint8).reshape(len(pieces), WINDOW)
            s, n = self.window_sums(x, lengths)
            np.add.at(sums, own, s)
            np.add.at(sure, own, s.max(axis=1))
            np.add.at(letters, own, n)
        letters = np.maximum(letters, 1)
        return sums / letters[:, None], sure / letters

    def gradients(self, windows, lengths, targets, weights=None):
        """Mean cross-entropy over the letter positions (of weighted windows), and its gradient, through time both ways."""
        w, h = self.weights, self.units
        x = np.ascontiguousarray(windows.T)
        valid = (np.arange(x.shape[0])[:, None] < lengths[None, :]).astype(np.float32)[:, None, :]
        runs = {d: self._run(x, valid, d, keep=True) for d in "fb"}
        p = self._softmax(runs["f"][0], runs["b"][0])
        counted = LETTERS[x][:, None, :] * valid
        if weights is not None:
            counted = counted * weights.astype(np.float32)
        total = max(counted.sum(), 1.0)
        at = np.arange(x.shape[1])
        loss = -(np.log(p[:, targets, at] + 1e-9) * counted[:, 0]).sum() / total
        p[:, targets, at] -= 1
        error = p * (counted / total).astype(np.float32)
        grads = {"bias": error.sum(axis=(0, 2))[:, None]}
        at_byte = x.ravel().astype(np.intp)
        for d in "fb":
            states, (gates, pre) = runs[d]
            grads[f"out_{d}"] = np.einsum("tkb,thb->kh", error, states)
            rec, g_rec, kind = w[f"rec_{d}"], np.zeros_like(w[f"rec_{d}"]), w[f"in_{d}"].dtype
            g_read, g_h = np.empty(gates.shape, kind), np.empty(gates.shape[1:], kind)
            from_out, left, slope = w[f"out_{d}"].T @ error, 1 - gates[:, :2 * h], 1 - gates[:, 2 * h:] * gates[:, 2 * h:]
            start = carry = np.zeros((h, x.shape[1]), np.float32)
            step = 1 if d == "f" else -1
            for t in range(len(x))[::-step]:
                before = states[t - step] if 0 <= t - step < len(x) else start
                z, r, new = gates[t, :h], gates[t, h:2 * h], gates[t, 2 * h:]
                g, g_z, g_r, g_new = from_out[t], g_read[t, :h], g_read[t, h:2 * h], g_read[t, 2 * h:]
                g += carry
                g *= valid[t]
                np.multiply(g, left[t, :h], out=g_new)
                g_new *= slope[t]
                np.subtract(before, new, out=g_z)
                for factor in (g, z, left[t, :h]):
                    g_z *= factor
                np.multiply(g_new, pre[t, 2 * h:], out=g_r)
                g_r *= r
                g_r *= left[t, h:]
                g_h[:2 * h] = g_read[t, :2 * h]
                np.multiply(g_new, r, out=g_h[2 * h:])
                g_rec += g_h @ before.T
                carry = rec.T @ g_h
                g *= z
                carry += g
            by_byte = [np.bincount(at_byte, g_read[:, i].ravel(), 256) for i in range(3 * h)]
            grads[f"in_{d}"], grads[f"rec_{d}"] = np.stack(by_byte).astype(g_read.dtype), g_rec
        return loss, grads


class Adam:
    """Steps of Adam on a network, with the gradient's norm held to 1."""

    def __init__(self, net: Network):
        self.net, self.step = net, 0
        self.m, self.v = ({k: np.zeros_like(w) for k, w in net.weights.items()} for _ in range(2))

    def __call__(self, pieces: list[bytes], targets: np.ndarray, rate: float, weights: np.ndarray | None = None) -> None:
        net, m, v = self.net, self.m, self.v
        self.step += 1
        x = np.frombuffer(b"".join(p.ljust(WINDOW, b"\0") for p in pieces), np.uint8).reshape(len(pieces), WINDOW)
        _, grads = net.gradients(x, np.array([len(p) for p in pieces]), targets, weights)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1, 1 / max(norm, 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.98 * v[k] + 0.02 * g * g
            net.weights[k] = (net.weights[k] - rate * (m[k] / (1 - 0.9 ** self.step)) / (np.sqrt(v[k] / (1 - 0.98 ** self.step)) + 1e-6)).astype(np.float32)


def train(samples: list[tuple[str, bytes]], *, units: int = 12, steps: int = 240, batch: int = 96,
          rate: float = 0.02, seed: int = 11) -> Network | None:
    """A network fitted to (language, window of bytes) by Adam; languages are drawn evenly."""
    samples = [(lang, b[:WINDOW]) for lang, b in samples if lang is not None and b]
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = Network(languages, units, rng)
    by = [[b for lang, b in samples if lang == name] for name in languages]
    descend = Adam(net)
    for step in range(1, steps + 1):
        targets = rng.integers(0, len(by), batch)
        picked = [by[y][rng.integers(0, len(by[y]))] for y in targets]
        descend(picked, targets, rate * min(1, 2 * (1 - step / (steps + 1))))
    return net


def held_out(id_col: str = "doc_id") -> F.Column:
    """True for the quarter of the ids that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def spread_sample(known: DataFrame, columns: dict[str, F.Column], total: int, max_languages: int = 1000) -> DataFrame:
    """(lang, doc_id, columns) of about ``total`` ids of ``known`` (doc_id, lang, text), as many of each language.

    One row per id and language, whatever number of rows an id has: at most ``total`` or
    30 per language. The lowest hashes of each language are taken, so every one of the
    ``max_languages`` most frequent is there at every size; ids that are far too many to
    be among them are left out before the texts are looked at.
    """
    counts = (known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
              .orderBy(F.desc("ids"), "lang").limit(max_languages).collect())
    if not counts:
        return known.select("lang", "doc_id", *[c.alias(n) for n, c in columns.items()]).limit(0)
    each = max(30, total // len(counts))
    share = known.sparkSession.createDataFrame([(r.lang, min(1.0, 4 * each / r.ids)) for r in counts], "lang string, share double")
    h = F.xxhash64("doc_id")
    some = known.join(F.broadcast(share), "lang").where(F.pmod(h, F.lit(1 << 30)) < F.col("share") * (1 << 30))
    one = some.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text"), *[c.alias(n) for n, c in columns.items()])).alias("row"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(h, "doc_id"))
    return one.withColumn("nth", rank).where(F.col("nth") <= each).select("lang", "doc_id", *[f"row.{n}" for n in columns])


def _known(docs: DataFrame) -> DataFrame:
    """Rows whose language can be learned from or checked."""
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))


def _windows(number: int | None) -> F.Column:
    """Windows of a text: ``number`` of them from hashed places, or all, end to end."""
    if number is None:
        places = F.sequence(F.lit(1), F.length("text"), F.lit(WINDOW))
        return F.transform(places, lambda at: F.substring(F.col("text"), at, F.lit(WINDOW)))
    start = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.length("text")).cast("int") + 1
    return F.array(*[F.substring(F.col("text"), start(k), F.lit(WINDOW)) for k in range(number)])


def fit(docs: DataFrame, *, max_documents: int | None = None, windows_per_document: int | None = 4) -> Network | None:
    """A network from every learnable document: some windows of each, or with ``None`` its whole text.

    ``max_documents``: from a sample of so many at most instead, equally many of each
    language, trained on the driver with some windows of each.
    """
    known = _known(docs).where(~held_out())
    if max_documents is None:
        return trained(known.select("lang", "doc_id", F.explode(_windows(windows_per_document)).alias("w")))
    rows = spread_sample(known, {"w": _windows(windows_per_document)}, max_documents)
    samples = sorted((str(r.lang), w.encode()) for r in rows.select("lang", "w").collect() for w in r.w)
    return train(samples)


def trained(windows: DataFrame, *, units: int = 12, rate: float = 0.02, seed: int = 11, max_languages: int = 1000) -> Network | None:
    """A network fitted to all of ``windows`` (lang, doc_id, w).

    Every window is read once at least; all of them as often as a shard's steps ask for if
    they are few, and those of a language with under a quarter of its even share more
    often. What is left of uneven shares is evened out by weights. A round is one job: its
    shards, of about ``SHARD`` windows, are tasks, and the driver gets one network.
    ``max_languages`` bounds the network's outputs, most frequent first.
    """
    spark = windows.sparkSession
    with small_batches(spark):
        counts = {r.lang: r["count"] for r in windows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()}
    if not counts:
        return None
    languages, every = sorted(counts), sum(counts.values())
    again = -(-ROUNDS * SHARD // every)  # a whole number of readings, 1 if there are enough
    times = {name: max(again, -(-again * every // (4 * len(counts) * n))) for name, n in counts.items()}
    read = sum(n * times[name] for name, n in counts.items())
    weights = np.array([read / (len(counts) * counts[name] * times[name]) for name in languages])
    shards = -(-read // (ROUNDS * SHARD))
    net = Network(languages, units, np.random.default_rng(seed))
    table = spark.createDataFrame([(name, i, times[name]) for i, name in enumerate(languages)], "lang string, y int, times long")
    with Scratch(spark, "windows") as scratch:
        dealt = windows.join(F.broadcast(table), "lang").select(
            "y", "doc_id", "w", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("reading"))
        h = F.xxhash64("doc_id", "w", "reading")
        path = scratch.path("dealt")
        dealt = dealt.select("y", "w", h.alias("h"), F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).alias("shard"),
                             F.pmod(F.xxhash64("h", F.lit(2)), F.lit(ROUNDS)).cast("int").alias("round"))
        # a file of each round stays open, so a task needn't sort its windows by round first
        with small_batches(spark), settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(ROUNDS)}):
            dealt.write.option("parquet.block.size", ROW_GROUP).partitionBy("round").parquet(path)
        rows = spark.read.schema("y int, w string, h long, shard long, round int").parquet(path)
        for k in range(ROUNDS):
            found = (rows.where(F.col("round") == k).groupBy("shard").applyInArrow(_shard_round(net, weights, k, rate, seed), "weights array<double>")
                     .select(F.posexplode("weights").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x")).toArrow())
            flat = np.zeros(sum(w.size for w in net.weights.values()))
            flat[found["at"].to_numpy()] = found["x"].to_numpy()
            if found.num_rows:
                net.weights = _shaped(flat, net.weights)
    return net


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ends = np.cumsum([w.size for w in like.values()])
    return {k: x.reshape(w.shape).astype(np.float32) for (k, w), x in zip(like.items(), np.split(flat, ends[:-1]))}


def _shard_round(net: Network, weights: np.ndarray, k: int, rate: float, seed: int):
    """One round of a shard: its windows once, in a shuffled order; the weights of the network it comes to."""
    def run(table: pa.Table) -> pa.Table:
        # an order that doesn't depend on how rows arrive
        table = table.sort_by([("h", "ascending"), ("y", "ascending"), ("w", "ascending")])
        order = np.random.default_rng([seed, k, int(table["shard"][0].as_py())]).permutation(table.num_rows)
        y, w = table["y"].to_numpy()[order], utf8(table["w"].combine_chunks().take(pa.array(order)))
        mine = Network(net.languages, net.units, np.random.default_rng(0))
        mine.weights = net.weights
        descend, steps = Adam(mine), -(-len(y) // BATCH)
        for step in range(steps):
            some = slice(step * BATCH, (step + 1) * BATCH)
            left = 1 - (k + step / steps) / ROUNDS
            descend([b[:WINDOW] for b in w[some]], y[some], rate * min(1, 2 * left), weights[y[some]])
        return pa.table({"weights": pa.array([np.concatenate([x.ravel() for x in mine.weights.values()]).astype(float)], pa.list_(pa.float64()))})

    return run


def least_certainty(told: DataFrame, keep: float = 0.995, slack: float = 2.0, least_documents: int = 100, even: int = 30) -> float:
    """The certainty below which a text is in no learned language.

    A text may lack ``slack`` times the certainty that the least sure of the share ``keep``
    of held-out documents lacks, of those whose language is told right. ``told`` is what
    ``identify`` gives for all of them (doc_id, lang, lang_pred, certainty); a language
    counts as much as any other that has ``even`` of them. Certainties are counted in
    steps of 1 / ``PLACES``, so the driver gets that many rows at most. With fewer than
    ``least_documents`` of them there is no such share to tell: 0, as without a network.
    """
    right = told.where(held_out() & (F.col("lang_pred") == F.col("lang").cast("string")))
    by = right.groupBy("lang", F.floor(F.col("certainty") * PLACES).alias("place")).agg(F.count("*").alias("n"))
    shares = by.groupBy("lang").agg(F.sum("n").alias("all"))
    found = (by.join(shares, "lang").groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("n") / F.greatest("all", F.lit(even))).alias("weight"))
             .orderBy("place").toPandas())
    if found["n"].sum() < least_documents:
        return 0.0
    sums = found["weight"].cumsum()
    least = found["place"][(sums >= (1 - keep) * sums.iloc[-1]).argmax()] / PLACES
    return float(max(0.0, 1 - slack * (1 - least)))


def _has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return text.upper() != text.lower() or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``certainty``; columns of these names are replaced.

    The score is the text's pooled probability of ``lang_pred``; the certainty is that of
    its windows, each of its own best language.
    """
    def make():
        def run(column):
            texts = utf8(column)
            langs, scores, certain = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            at = [i for i, t in enumerate(texts) if net and _has_letter(t)]
            if at:
                pooled, sure = net.read([texts[i] for i in at])
                best = pooled.argmax(axis=1)
                for i, b, p, c in zip(at, best, pooled, sure):
                    langs[i], scores[i], certain[i] = net.languages[b], float(min(max(p[b], 0.0), 1.0)), float(min(max(c, 0.0), 1.0))
            return [langs, scores, certain]
        return run

    return add_columns(docs, [text_col], [(n, T.StringType() if n == "lang_pred" else T.DoubleType())
                                          for n in ("lang_pred", "score", "certainty")], make)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = fit(docs)
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drops documents in no learned language; columns unchanged.

    Those are texts without a letter (``und``) and texts on which the network is far less
    sure than on nearly all held-out documents (``least_certainty``, of all of them). A
    text in several learned languages stays, as its windows are sure.
    """
    net = fit(docs, windows_per_document=None)
    passed = docs.toDF(*[f"passed_{i}" for i in range(len(docs.columns))])
    of = lambda name: F.col(f"passed_{docs.columns.index(name)}")
    told = saved(identify(passed, net, f"passed_{docs.columns.index('text')}"), "language-told")
    least = least_certainty(told.select(of("doc_id").alias("doc_id"), of("lang").alias("lang"), "lang_pred", "certainty"))
    return (told.where((F.col("lang_pred") != "und") & (F.col("certainty") >= least))
            .select(*passed.columns).toDF(*docs.columns))
