"""Vector bin packing of tokenised documents into training sequences.

An example is a vector: its tokens, one segment, its loss-bearing tokens. A sequence
has a limit on each of the three. The open sequence takes, of all examples that fit,
the one whose vector (each part as a share of its limit) has the largest dot product
with what is left of the limits; so an example that would use up the scarce part is
taken while there is still much of it, and small ones fill the end. Where no example
fits whole, one is cut: its head fills the sequence, its tail stays an example.

A sequence that cannot be filled (no segment or no loss-bearing token left, or no
example) is shortened to the next lower power of two, which needs no padding; what
stood beyond goes back to the examples.

Tokenising and packing share one pass: a task tokenises its documents and packs them
some thousands at a time, so nothing is shuffled and no id is stored. A pack is bounded
in rows and in tokens (plus one document).

As instruction data: a document's first line is the prompt, which bears no loss; what
follows, the end id included, does. Without a line break all of it bears loss.

Ids come from tiktoken where its merges are known to give the ids of the tokenizer's
own library (the same vocabulary and split) and are fast; texts with the name of a
special token and texts with very long runs go through that library itself.

Defined results: null and empty texts are the end id alone; a null or repeated doc_id
is a document like others; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import saved

END = 0
#: Rows and tokens of a pack, at most (a document's tokens are not divided over packs).
PACK_ROWS, PACK_TOKENS = 2048, 4_000_000
#: Without a blank for so long, tiktoken's merging is slow (its time is quadratic in a run).
LONG_RUN = 400


class Limits(NamedTuple):
    """Most tokens, segments and loss-bearing tokens of a sequence."""

    tokens: int = 1024
    segments: int = 32
    loss: int = 1024


class Piece(NamedTuple):
    example: int
    start: int
    length: int
    sequence: int
    offset: int
    loss: int


class Packer:
    """Pieces and sequences for one pack: ``tokens`` and ``prompt`` (tokens without loss at the head) per example."""

    def __init__(self, tokens, prompt, limits: Limits = Limits()):
        self.limits, self.pieces, self.sequences = limits, [], 0
        self.prompt = np.asarray(prompt, np.int64)
        self.start = np.zeros(len(self.prompt), np.int64)
        self.left = np.asarray(tokens, np.int64).copy()  # tokens of each example that are not placed
        self._whole()
        self.loss = self.left - np.minimum(self.left, np.maximum(0, self.prompt - self.start))

    def _whole(self) -> None:
        """Sequences of one piece each, while an example has more than a sequence of tokens."""
        most = self.limits.tokens
        for i in np.flatnonzero(self.left > most):
            while self.left[i] > most:
                silent = int(max(0, min(most, self.prompt[i] - self.start[i])))
                if most - silent > self.limits.loss:
                    break  # the loss limit cuts it: it needs others' prompts beside it
                self.pieces.append(Piece(int(i), int(self.start[i]), most, self.sequences, 0, most - silent))
                self.sequences += 1
                self.start[i] += most
                self.left[i] -= most

    def _place(self, i: int, length: int) -> None:
        silent = min(length, max(0, int(self.prompt[i] - self.start[i])))
        self.open.append(Piece(i, int(self.start[i]), length, self.sequences, self.limits.tokens - self.room[0], length - silent))
        self.room = [self.room[0] - length, self.room[1] - 1, self.room[2] - (length - silent)]
        self._set(i, int(self.start[i]) + length, int(self.left[i]) - length)

    def _set(self, i: int, start: int, left: int) -> None:
        self.start[i], self.left[i] = start, left
        self.loss[i] = left - min(left, max(0, int(self.prompt[i]) - start))

    def _cut(self) -> bool:
        """Fills the open sequence with the head of an example that is too long for it."""
        tokens, _, loss = self.room
        head = np.minimum(np.minimum(self.left, tokens), np.maximum(0, self.prompt - self.start) + loss)
        best = int(head.argmax())
        if head[best] <= 0:
            return False
        longest = np.flatnonzero(head == head[best])
        i = int(longest[self.left[longest].argmax()])
        self._place(i, int(head[i]))
        return True

    def _close(self) -> None:
        """Ends the open sequence, at a power of two if it is not full."""
        used = self.limits.tokens - self.room[0]
        beyond = used - (1 << (used.bit_length() - 1)) if self.room[0] else 0
        while beyond:
            last = self.open.pop()
            back = min(beyond, last.length)
            beyond -= back
            kept = last.length - back
            # what is left of the example begins where this piece ended
            self._set(last.example, last.start + kept, int(self.left[last.example]) + back)
            if kept:
                silent = min(kept, max(0, int(self.prompt[last.example]) - last.start))
                self.open.append(last._replace(length=kept, loss=kept - silent))
        self.pieces += self.open
        self.sequences += 1

    def run(self) -> list[Piece]:
        share = np.array([1 / self.limits.tokens, 1 / self.limits.segments, 1 / self.limits.loss])
        while self.left.any():
            self.open, self.room = [], list(self.limits)
            while self.room[0] and self.room[1]:
                fits = (self.left > 0) & (self.left <= self.room[0]) & (self.loss <= self.room[2])
                if self.room[1] == 1 and not (self.left[fits] == self.room[0]).any() and (self.left > self.room[0]).any():
                    fits[:] = False  # the last segment: a head that fills the sequence
                if fits.any():
                    room = share * share * self.room
                    score = np.where(fits, self.left * room[0] + room[1] + self.loss * room[2], -1.0)
                    self._place(int(score.argmax()), int(self.left[score.argmax()]))
                elif not self._cut():
                    break
            self._close()
        return self.pieces


class Encoder:
    """Ids of whole texts, as the library ``tokenizers`` gives them without special tokens added."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import base64
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.exact = Tokenizer.from_file(json_path)
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        special = [re.escape(t.content) for t in self.exact.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([*special, rf"\s{{{LONG_RUN}}}"]))
        # ids whose bytes hold a line break
        self.breaks = np.zeros(max(ranks.values()) + 2, bool)
        self.breaks[[i for word, i in ranks.items() if b"\n" in word]] = True

    def __call__(self, text: str) -> np.ndarray:
        if self.odd.search(text) or max(map(len, text.split()), default=0) >= LONG_RUN:
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)

    def prompt(self, ids: np.ndarray) -> int:
        """Ids to the end of the first line; 0 if there is one line only."""
        at = self.breaks[ids]
        first = int(at.argmax()) if len(at) else 0
        return first + 1 if len(at) and at[first] else 0


def tokenizer_files() -> tuple[str, str, str]:
    """Vocabulary, the same vocabulary as ranks, and its split pattern."""
    import public_tokenizers as files

    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


def packed(docs: DataFrame, limits: Limits = Limits(), files: tuple[str, str, str] | None = None,
           pack_rows: int = PACK_ROWS, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """Pieces of the whole texts of ``docs`` (doc_id, text) with their sequences.

    ``files``: see ``tokenizer_files``; every executor must have them.
    """
    files, limits = files or tokenizer_files(), tuple(limits)
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        encode = Encoder(*files)
        base, made = TaskContext.get().partitionId() << 40, 0
        held, ids, tokens = [], [], 0

        def close():
            nonlocal made
            names, length = pa.concat_arrays(held), [len(x) for x in ids]
            packer = Packer(length, [encode.prompt(x[:-1]) for x in ids], Limits(*limits))
            pieces = packer.run()
            at = np.array([p[:5] for p in pieces], np.int64)
            crc = [zlib.crc32(ids[p.example][p.start:p.start + p.length].astype("<u4").tobytes()) for p in pieces]
            out = pa.RecordBatch.from_arrays(
                [names.take(pa.array(at[:, 0])), pa.array(at[:, 1]), pa.array(at[:, 2]), pa.array(crc, pa.int64()),
                 pa.array(np.array(length, np.int64)[at[:, 0]]), pa.array(base + made + at[:, 3]), pa.array(at[:, 4]),
                 pa.array([p.loss for p in pieces], pa.int64())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"])
            made += packer.sequences
            return out

        for b in batches:
            for row, text in enumerate(b.column(1).to_pylist()):
                held.append(b.column(0).slice(row, 1))
                ids.append(np.append(encode(text or ""), np.uint32(END)))
                tokens += len(ids[-1])
                if len(ids) >= pack_rows or tokens >= pack_tokens:
                    yield close()
                    held, ids, tokens = [], [], 0
        if ids:
            yield close()

    return src.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long")


def op12_vector_packing(spark, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 tokens and 32 segments."""
    return saved(packed(spark.read.parquet(f"{sf_dir}/documents.parquet")), "sequences")
