"""Harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: a bin of class k holds exactly k pieces of
capacity / k tokens. Documents are cut freely, so a document gives whole bins (class 1) and,
for what is left, one piece for each power of two in its length (classes 2, 4, 8, ...). These
are the reciprocals that divide the capacity, hence full bins need no padding. A piece finds
its place from its number within its class alone: bin = number // k. Tasks number their own
pieces; sums over the (task, class) counts, a table of a few rows per task, shift the numbers
of each task, so no piece ever moves to another worker. At most one bin per class stays open;
its pieces are regrouped by the binary digits of their number into sequences whose length is
a power of two, which need no padding either.

Null text counts as empty; the end id still makes one token. Rows with equal keys are packed
as documents of their own.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm.common import map_rows, read_vocabulary
from millwright.scratch import store

CAPACITY = 4096
END_ID = 2
CACHED_WORDS = 250_000
WORDS_AT_ONCE = 4096


class WordIds:
    """Ids of whole texts by a vocabulary that drops white space.

    Such a vocabulary never joins what a space or line end divides, so each distinct word is
    encoded once and remembered (a bounded number of them). New words go to the library in
    long strings, divided by a control character between spaces whose id shows where each
    word's ids end. That costs less than a special token, at which the library cuts a string.
    """

    def __init__(self, vocabulary_json: str, divider: str = "\x01"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_str(vocabulary_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.divider = divider
        (self.divider_id,) = self.ids(divider)
        # words of late, and those of the time before, which are forgotten unless met again
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, np.uint32)

    def learn(self, new: list[str]) -> None:
        own = [w for w in new if "<|" in w or self.divider in w]
        plain = list(set(new).difference(own)) if own else new
        for at in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[at : at + WORDS_AT_ONCE]
            ids = self.ids(f" {self.divider} ".join(some))
            ends = np.flatnonzero(ids == self.divider_id)
            begins = [0, *(ends + 1).tolist()]
            for word, a, b in zip(some, begins, [*ends.tolist(), len(ids)]):
                self.known[word] = ids[a:b].tobytes()
        for word in own:
            self.known[word] = self.ids(word).tobytes()

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        here = set().union(*cut)
        if len(self.known) > CACHED_WORDS:
            self.before, self.known = self.known, {}
        missing = here.difference(self.known)
        again = missing.intersection(self.before)
        self.known.update(zip(again, map(self.before.__getitem__, again)))
        self.learn(list(missing.difference(again)))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in cut]


@lru_cache(maxsize=1)
def word_ids(vocabulary_json: str) -> WordIds:
    """One per Python worker, so the tasks it runs share the remembered words."""
    return WordIds(vocabulary_json)


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Whole bins, then the powers of two of the rest, largest first."""
    whole, rest = divmod(total, capacity)
    bits = range(rest.bit_length() - 1, -1, -1)
    return [capacity] * whole + [1 << b for b in bits if rest >> b & 1]


def token_pieces(
    docs: DataFrame, tokens: Callable[[], Callable], capacity: int, key: str, text: str,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents, numbered by task and class in the order of their rows."""

    def make():
        gc.disable()  # only flat data is kept
        encode = tokens()
        task = TaskContext.get().partitionId()
        made: dict[int, int] = {}
        end = np.array([end_id], "<u4").tobytes()

        def work(keys, texts):
            rows: dict[str, list] = {n: [] for n in (
                key, "start", "length", "ids_crc32", "doc_tokens", "task", "task_index")}
            for k, ids in zip(keys, encode(texts)):
                data = memoryview(ids + end)
                total, at = len(data) // 4, 0
                for length in cut_lengths(total, capacity):
                    index = made.get(length, 0)
                    made[length] = index + 1
                    crc = zlib.crc32(data[4 * at : 4 * (at + length)])
                    for column, value in zip(
                        rows.values(), (k, at, length, crc, total, task, index)
                    ):
                        column.append(value)
                    at += length
            return rows

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(
        docs, [key, text],
        f"{key} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
        " task int, task_index bigint", make, sliced=text,
    )


def place(pieces: DataFrame, capacity: int, key: str) -> DataFrame:
    """``sequence_id`` and ``offset`` of numbered pieces, without moving them."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task")
    shifts = counts.select(
        "length", "task",
        F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("shift"),
    ).na.fill(0, ["shift"])
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))
    k = F.expr(f"{capacity} div length")
    totals = totals.withColumn("full", F.floor(F.col("n") / k)).withColumn(
        "open", F.col("n") % k
    )
    made = F.col("full") + F.bit_count("open")
    # one row per class: at most log2(capacity) + 1 rows meet in this window
    base = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "length", "full", "open", F.coalesce(F.sum(made).over(base), F.lit(0)).alias("base")
    )
    numbered = pieces.join(shifts, ["length", "task"]).join(totals, "length")
    number = F.col("task_index") + F.col("shift")
    rank = F.col("rank")
    in_bin = rank % k
    # in the open bin: the highest binary digit in which the place differs from the count of
    # pieces names the group, the digits above it say where the group starts
    digit = F.floor(F.log2(in_bin.bitwiseXOR(F.col("open")).cast("double"))).cast("int")
    above = F.expr("shiftright(open, digit + 1)")
    return (
        numbered.withColumn("rank", number)
        .withColumn("bin", F.floor(rank / k))
        .withColumn("digit", F.when(F.col("bin") == F.col("full"), digit))
        .withColumn("group", F.when(F.col("digit").isNotNull(), F.bit_count(above)))
        .withColumn(
            "first",
            F.when(F.col("digit").isNotNull(), F.expr("shiftleft(shiftright(open, digit + 1),"
                                                      " digit + 1)")),
        )
        .select(
            key, "start", "length", "ids_crc32", "doc_tokens",
            (F.col("base") + F.col("bin") + F.coalesce("group", F.lit(0))).alias("sequence_id"),
            ((in_bin - F.coalesce("first", F.lit(0))) * F.col("length")).alias("offset"),
        )
    )


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pack all documents; one row per piece with its sequence and its offset there.

    ``capacity`` must be a power of two. The numbered pieces are written to the shared folder
    before they are placed, so a task that runs twice cannot number them differently.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    pieces = token_pieces(
        docs, lambda: word_ids(source.value).texts, capacity, key, text, end_id
    )
    return place(store(pieces, "pieces"), capacity, key)
