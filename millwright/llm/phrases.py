"""Phrase collocations by exact n-gram counts in counting quotient filters.

Words are counted per language first. Only words that reach the count get an id, dense and per
language, since a phrase is never more frequent than its words; rarer words end a piece as a
full stop does. An n-gram is its ids side by side, a whole number of n * bits bits. Rounds of
xor-mixing between the ids permute these numbers invertibly, so that they are spread evenly
and can still be read back.

A filter holds permuted n-grams in order: the high bits, the *quotient*, name a bucket and are
not stored (one bit per entry and bucket marks where buckets end), all other bits, the full
*remainder*, are. Counters take one byte and grow where needed. So counts are exact and no two
n-grams are ever confused. Tasks fill filters from their share of the text and cut them by the
leading quotient bits into shards; equal shards meet in one task, where the sorted filters are
merged and counters added. The permutation deals n-grams evenly, and a frequent one is a single
entry per filter, so shards are bounded whatever the text: their number follows from its words.

Phrases grow level by level: an n-gram counts only where both n-1-grams in it were frequent.
That test is a bitmap of fixed size; false hits cost work and never change a count.

The rest are joins: of every cut of a phrase with the counts of both its parts, and of every
phrase with those one word longer that hold it. A phrase inside a longer one of enough count is
also inside one a single word longer, which counts at least as often.

Null texts are empty, null languages are ``und``. Every row counts, repeated or not. A piece
(text between two punctuation marks) is held whole by its task. An empty table has no phrases.
Columns besides text and language are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import text_slices
from millwright.scratch import drop, store

LONGEST = 5
MIN_COUNT = 100
REDUNDANT = (100, 100)  # count of a longer phrase as a fraction of whole numbers
TOP = 2000
SALTS = 64
CHUNK = 2 << 20  # bytes of text with one local vocabulary
GRAMS_A_SHARD = 2_000_000
GRAMS_HELD = 2_000_000  # n-grams a task gathers before it sends filters
FILTER_WORDS = 1 << 20  # longs of the bitmap of frequent n-grams
PERMUTE_ROUNDS = 3
NO_WORD = 0

BREAK = b"\xff"  # never part of UTF-8
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


# --- words and their ids ------------------------------------------------------------


class Vocabulary(dict):
    """Local number of each word; a break is no word."""

    def __init__(self):
        super().__init__({BREAK: -1})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number


def tokens(text: str) -> list[bytes]:
    """Words in lower case (ASCII) and breaks between pieces."""
    return text.encode().lower().translate(PIECES).replace(BREAK, b" \xff ").split()


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, words, counts, codes): texts as numbers of a local vocabulary."""
    schema = "chunk bigint, lang string, words array<string>, counts array<bigint>, codes binary"

    def row(lang, vocabulary, held):
        codes = np.concatenate(held)
        counts = np.bincount(codes[codes >= 0], minlength=len(vocabulary) - 1)
        words = [w.decode() for w in vocabulary if w != BREAK]
        return lang, words, counts.tolist(), codes.astype("<i4").tobytes()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[str, tuple] = {}
        size = 0

        def flush():
            rows = [row(lang, *held) for lang, held in open_chunks.items()]
            open_chunks.clear()
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array([0] * len(rows), pa.int64()), pa.array(columns[0], pa.string()),
                 pa.array(columns[1], pa.list_(pa.string())),
                 pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.binary())],
                names=["chunk", "lang", "words", "counts", "codes"],
            )

        for part in text_slices(batches, "text", CHUNK):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                if not text:
                    continue
                vocabulary, held = open_chunks.setdefault(lang, (Vocabulary(), []))
                found = tokens(text)
                found.append(BREAK)
                held.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
                size += len(text)
                if size >= CHUNK:
                    yield flush()
                    size = 0
        if open_chunks:
            yield flush()

    made = docs.mapInArrow(make, schema)
    return made.withColumn("chunk", F.monotonically_increasing_id())


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """The stored rows with dense ids from 1, and how many there are; no row moves."""
    place = store(words.withColumn("place", F.monotonically_increasing_id()), "words")
    task = F.shiftright("place", 33)
    sizes = place.groupBy(task.alias("task")).agg(F.count("*").alias("size"))
    # one row per task of the write
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    ids = place.withColumn("task", task).join(F.broadcast(sizes), "task").withColumn(
        "id", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    )
    out = store(ids.drop("place", "task", "before"), "word-ids")
    drop(place)
    return out, out.count()


def with_ids(chunked: DataFrame, words: DataFrame) -> DataFrame:
    """(ids): each chunk's words as ids, 0 for breaks and words without one."""
    listed = chunked.select("chunk", "lang", F.posexplode("words").alias("code", "word"))
    known = listed.join(words.select("lang", "word", "id"), ["lang", "word"])
    known = known.groupBy("chunk").agg(F.collect_list(F.struct("code", "id")).alias("known"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column("codes")[i].as_py(), "<i4")
                table = np.full(codes.max(initial=0) + 2, NO_WORD, "<u4")
                pairs = batch.column("known")[i].values
                table[pairs.field("code").to_numpy()] = pairs.field("id").to_numpy()
                ids = table[codes].tobytes()  # code -1, a break, reads the last place
                yield pa.RecordBatch.from_arrays([pa.array([ids], pa.binary())], names=["ids"])

    return chunked.select("chunk", "codes").join(known, "chunk").mapInArrow(work, "ids binary")


# --- permuted n-grams ----------------------------------------------------------------


def step(columns: list[np.ndarray], target: int, turn: int, bits: int) -> np.ndarray:
    """What a round xors to one id: a mixture of all the others."""
    total = np.full(len(columns[0]), np.uint64(turn * 64 + target + 1))
    for i, column in enumerate(columns):
        if i != target:
            total = (total + column) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return mixed(total) >> np.uint64(64 - bits)


def permuted(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    columns = list(columns)
    for turn in range(PERMUTE_ROUNDS):
        for i in range(len(columns)):
            columns[i] = columns[i] ^ step(columns, i, turn, bits)
    return columns


def restored(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    columns = list(columns)
    for turn in reversed(range(PERMUTE_ROUNDS)):
        for i in reversed(range(len(columns))):
            columns[i] = columns[i] ^ step(columns, i, turn, bits)
    return columns


def widths(n: int, bits: int) -> list[int]:
    """Bits of each 64-bit word that n ids are packed into."""
    per_word = 64 // bits
    return [bits * min(per_word, n - at) for at in range(0, n, per_word)]


def packed(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    per_word, out = 64 // bits, []
    for at in range(0, len(columns), per_word):
        word = columns[at].astype(np.uint64)
        for column in columns[at + 1 : at + per_word]:
            word = (word << np.uint64(bits)) | column
        out.append(word)
    return out


def unpacked(words: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    columns, mask = [], np.uint64((1 << bits) - 1)
    for word, width in zip(words, widths(n, bits)):
        for shift in range(width - bits, -1, -bits):
            columns.append((word >> np.uint64(shift)) & mask)
    return columns


def counted(words: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct n-grams with their summed counts."""
    if len(counts) == 0:
        return words, counts
    if len(words) == 1:
        order = np.argsort(words[0], kind="stable")
    else:
        order = np.lexsort(words[::-1])
    words, counts = [w[order] for w in words], counts[order]
    new = np.zeros(len(counts), bool)
    new[0] = True
    for w in words:
        new[1:] |= w[1:] != w[:-1]
    heads = np.flatnonzero(new)
    return [w[heads] for w in words], np.add.reduceat(counts, heads)


# --- filters ------------------------------------------------------------------------


def to_bytes(values: np.ndarray, width: int) -> bytes:
    size = (width + 7) // 8
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def from_bytes(raw: memoryview, n: int, width: int) -> tuple[np.ndarray, memoryview]:
    size = (width + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw[: n * size], np.uint8).reshape(n, size)
    return out.view("<u8").ravel().astype(np.uint64), raw[n * size :]


def encode(
    words: list[np.ndarray], counts: np.ndarray, n: int, bits: int, shard: int, shard_bits: int
) -> bytes:
    """A filter of sorted distinct n-grams that share their first ``shard_bits`` bits."""
    size, first = len(counts), widths(n, bits)[0]
    quotient_bits = min(first, shard_bits + max(size.bit_length() - 1, 0))
    rest = first - quotient_bits
    buckets = 1 << (quotient_bits - shard_bits)
    bucket = (words[0] >> np.uint64(rest)).astype(np.int64) - (shard << (quotient_bits - shard_bits))
    marks = np.ones(size + buckets, bool)
    ends = np.cumsum(np.bincount(bucket, minlength=buckets)) + np.arange(buckets)
    marks[ends] = False
    out = [struct.pack("<IBBI", size, quotient_bits, shard_bits, shard), np.packbits(marks).tobytes()]
    out.append(to_bytes(words[0] & np.uint64((1 << rest) - 1), rest))
    out += [to_bytes(w, width) for w, width in zip(words[1:], widths(n, bits)[1:])]
    large = counts >= 255
    out.append(np.where(large, 255, counts).astype(np.uint8).tobytes())
    out.append(counts[large].astype("<i8").tobytes())
    return b"".join(out)


def decode(raw: bytes, n: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    size, quotient_bits, shard_bits, shard = struct.unpack_from("<IBBI", raw)
    view = memoryview(raw)[struct.calcsize("<IBBI") :]
    buckets = 1 << (quotient_bits - shard_bits)
    length = (size + buckets + 7) // 8
    marks = np.unpackbits(np.frombuffer(view[:length], np.uint8))[: size + buckets]
    bucket = np.flatnonzero(marks) - np.arange(size)
    quotient = bucket.astype(np.uint64) + np.uint64(shard << (quotient_bits - shard_bits))
    all_widths = widths(n, bits)
    rest = all_widths[0] - quotient_bits
    low, view = from_bytes(view[length:], size, rest)
    words = [(quotient << np.uint64(rest)) | low if rest < 64 else low]
    for width in all_widths[1:]:
        word, view = from_bytes(view, size, width)
        words.append(word)
    counts = np.frombuffer(view[:size], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view[size:], "<i8")
    return words, counts


def filters(words: list[np.ndarray], counts: np.ndarray, n: int, bits: int, shard_bits: int):
    """(shard, filter) pairs of sorted distinct n-grams."""
    shards = words[0] >> np.uint64(widths(n, bits)[0] - shard_bits) if shard_bits else (
        np.zeros(len(counts), np.uint64))
    begins = np.flatnonzero(np.diff(shards.astype(np.int64), prepend=-1))
    for begin, end in zip(begins, [*begins[1:], len(counts)]):
        shard = int(shards[begin])
        yield shard, encode([w[begin:end] for w in words], counts[begin:end], n, bits, shard,
                            shard_bits)


# --- counting ------------------------------------------------------------------------


def marks(columns: list[np.ndarray]) -> np.ndarray:
    """Two places in the bitmap of frequent n-grams."""
    total = np.full(len(columns[0]), np.uint64(len(columns)))
    for column in columns:
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + column)
    size = np.uint64(FILTER_WORDS * 64)
    return np.stack([total % size, (total >> np.uint64(32)) % size])


def frequent_windows(ids: np.ndarray, n: int, bitmap: np.ndarray | None) -> np.ndarray:
    """Starts of n-grams of known words whose n-1-grams may all be frequent."""
    last = len(ids) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(last, bool)
    for i in range(n):
        ok &= ids[i : i + last] != NO_WORD
    at = np.flatnonzero(ok)
    if bitmap is not None and len(at):
        for shift in (0, 1):
            for place in marks([ids[at + shift + i] for i in range(n - 1)]):
                hit = (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
                at_hit = hit.astype(bool)
                ok[at[~at_hit]] = False
        at = np.flatnonzero(ok)
    return at


def gram_counts(
    coded: DataFrame, n: int, bits: int, shard_bits: int, bitmap: np.ndarray | None, min_count: int
) -> DataFrame:
    """(gram, f, marks): n-grams that occur at least ``min_count`` times."""
    shard_bits = min(shard_bits, widths(n, bits)[0])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            words = [np.concatenate(w) for w in zip(*(h[0] for h in held))]
            words, counts = counted(words, np.concatenate([h[1] for h in held]))
            rows = list(filters(words, counts, n, bits, shard_bits))
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in rows], pa.int64()),
                 pa.array([f for _, f in rows], pa.binary())], names=["shard", "filter"],
            )

        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<u4").astype(np.uint64)
                at = frequent_windows(ids, n, bitmap)
                if len(at):
                    grams = packed(permuted([ids[at + j] for j in range(n)], bits), bits)
                    held.append(counted(grams, np.ones(len(at), np.int64)))
                    size += len(held[-1][1])
                if size >= GRAMS_HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def merge(table: pa.Table) -> pa.Table:
        parts = [decode(raw, n, bits) for raw in table.column("filter").to_pylist()]
        words, counts = counted(
            [np.concatenate(w) for w in zip(*(p[0] for p in parts))],
            np.concatenate([p[1] for p in parts]),
        )
        often = counts >= min_count
        columns = restored(unpacked([w[often] for w in words], n, bits), bits)
        grams = np.stack(columns, axis=1).astype(np.int64)
        places = marks(columns).astype(np.int64).T
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a.shape[1]).cast(
            pa.list_(pa.int64())) for a in (grams, places)]
        return pa.table([lists[0], pa.array(counts[often]), lists[1]], names=["gram", "f", "marks"])

    sent = coded.mapInArrow(fill, "shard bigint, filter binary")
    return sent.groupBy("shard").applyInArrow(
        merge, "gram array<bigint>, f bigint, marks array<bigint>"
    )


def bitmap_of(grams: DataFrame) -> np.ndarray:
    """Bitmap of frequent n-grams; ``FILTER_WORDS`` longs at any size of the input."""
    place = grams.select(F.explode("marks").alias("place"))
    rows = place.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(FILTER_WORDS, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT,
    text: str = "text", lang: str = "lang",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (lang, word, id, f), (gram, f) for all lengths from 1, and (lang, n)."""
    chunked = store(chunks(docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text}`").alias("text"),
    )), "phrase-chunks")
    sums = chunked.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    sums = sums.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    totals = store(chunked.groupBy("lang").agg(F.sum(F.expr(
        "aggregate(counts, 0L, (s, c) -> s + c)")).alias("n")), "phrase-totals")
    words, size = numbered(sums.where(F.col("f") >= min_count))
    bits = max(size.bit_length(), 1)
    if bits > 32:
        raise ValueError(f"{size} frequent words; ids have at most 32 bits")
    coded = store(with_ids(chunked, words), "phrase-ids")
    drop(chunked)
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    shard_bits = max((occurrences // GRAMS_A_SHARD).bit_length(), 0)
    levels, bitmap = [words.select(F.array("id").alias("gram"), "f")], None
    for n in range(2, longest + 1):
        level = store(gram_counts(coded, n, bits, shard_bits, bitmap, min_count), f"grams-{n}")
        levels.append(level.select("gram", "f"))
        levels[-1].scratch_path = level.scratch_path
        if n < longest:
            bitmap = bitmap_of(level)
            if not bitmap.any():
                break
    drop(coded)
    grams = store(reduce(DataFrame.unionByName, levels), "grams")
    drop(*levels[1:])
    return words, grams, totals


def scored(grams: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(gram, lang, phrase, a, l, r, n, score) of every phrase of two words or more."""
    phrases = grams.where(F.size("gram") > 1)
    spelt = phrases.select("gram", F.posexplode("gram").alias("at", "id")).join(
        words.select("id", "lang", "word"), "id"
    ).groupBy("gram").agg(
        F.min("lang").alias("lang"),
        F.expr("concat_ws(' ', transform(array_sort(collect_list(struct(at, word))),"
               " w -> w.word))").alias("phrase"),
    )
    cuts = phrases.select(
        "gram", F.col("f").alias("a"), F.expr("explode(sequence(1, size(gram) - 1))").alias("k")
    ).select(
        "*", F.expr("slice(gram, 1, k)").alias("first"),
        F.expr("slice(gram, k + 1, size(gram) - k)").alias("rest"),
    )
    cuts = cuts.join(grams.select(F.col("gram").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(grams.select(F.col("gram").alias("rest"), F.col("f").alias("r")), "rest")
    whole = "decimal(38,0)"
    score = F.expr(
        f"(cast(1000 as {whole}) * cast(a as decimal(19,0)) * cast(n as decimal(19,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    spelt = spelt.join(totals, "lang")
    lowest = cuts.join(spelt, "gram").withColumn("score", score).groupBy("gram").agg(
        F.min("lang").alias("lang"), F.min("phrase").alias("phrase"), F.min("a").alias("a"),
        F.min("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    return lowest.select("gram", "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP,
    redundant: tuple[int, int] = REDUNDANT, text: str = "text", lang: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    words, grams, totals = frequent_phrases(docs, longest, min_count, text, lang)
    over, under = redundant
    longer = grams.where(F.size("gram") > 2).select(
        F.explode(F.array(F.expr("slice(gram, 1, size(gram) - 1)"),
                          F.expr("slice(gram, 2, size(gram) - 1)"))).alias("gram"), "f",
    ).groupBy("gram").agg(F.max("f").alias("longer"))
    kept = scored(grams, words, totals).join(longer, "gram", "left").where(
        F.col("longer").isNull() | (F.col("longer") * under < F.col("a") * over)
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: each of its shares is cut first
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*best))
        kept = kept.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    result = store(
        kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations"
    )
    drop(words, grams, totals)
    return result
