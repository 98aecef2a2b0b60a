"""Byte-level BPE, encoding and decoding, over a transducer of the corpus' frequent words.

Spark counts the words of all texts. The most frequent are encoded once on the driver and
compiled into a minimal acyclic automaton: words share prefixes and suffixes, every state
knows how many words pass before a transition, so the path of a word adds up to its number,
and its number selects its ids. Each task maps the compiled tables into memory and walks all
new words of a batch through them side by side. Words that are not in the lexicon are merged
by the ranks of the vocabulary, so results never depend on what the lexicon holds.

Null text counts as empty: no ids, the SHA-256 of nothing. Nothing else of the input row is
read, so columns that clash with the results do no harm.
"""

from __future__ import annotations

import gc
import heapq
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import SLICE_BYTES, map_rows, read_vocabulary, text_slices
from millwright.scratch import drop, store

LEXICON_WORDS = 100_000
CACHED_CHUNKS = 300_000
HEAP_FROM = 64  # symbols from which a word is merged with a heap

# Fixed: how byte-level vocabularies split text before merging.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
ODD_SPACE = regex.compile(r"\s\s|\A\s|\s\Z")
SINGLE_SPACE = regex.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in symbols)
    return symbols | {b: chr(256 + i) for i, b in enumerate(others)}


class Merges:
    """Merge ranks of a byte-level vocabulary, for many words at a time."""

    def __init__(self, vocabulary_json: str):
        file = json.loads(vocabulary_json)
        vocab = file["model"]["vocab"]
        byte_of = {s: b for b, s in byte_symbols().items()}
        self.specials = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        self.token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.token_bytes |= {i: t.encode() for t, i in self.specials.items()}
        symbols = byte_symbols()
        self.byte_ids = np.array([vocab[symbols[b]] for b in range(256)], np.int64)
        self.base = max(vocab.values()) + 1
        rows = []
        for rank, (left, right) in enumerate(file["model"]["merges"]):
            rows.append((vocab[left] * self.base + vocab[right], rank, vocab[left + right]))
        rows.sort()
        pairs = np.array(rows, np.int64)
        self.keys, self.ranks, self.merged = (np.ascontiguousarray(c) for c in pairs.T)
        self.lookup = {k: (r, m) for k, r, m in rows}

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        found: list[list[int]] = [[]] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) >= HEAP_FROM:
                found[i] = self._with_heap(word)
            elif word:
                by_length.setdefault(len(word), []).append(i)
        for length, numbers in by_length.items():
            table = np.frombuffer(b"".join(words[i] for i in numbers), np.uint8)
            ids = self._side_by_side(self.byte_ids[table].reshape(len(numbers), length))
            for i, row in zip(numbers, ids):
                found[i] = row
        return found

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray):
        pairs = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        known = (self.keys[at] == pairs) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], np.iinfo(np.int64).max), self.merged[at]

    def _side_by_side(self, ids: np.ndarray) -> list[list[int]]:
        """One row per word; each round merges the first best pair of every row."""
        rows, width = ids.shape
        out: list[list[int]] = [[]] * rows
        number = np.arange(rows)
        while len(ids):
            if ids.shape[1] < 2:
                ended = np.ones(len(ids), bool)
            else:
                ranks, merged = self._pair_ranks(ids[:, :-1], ids[:, 1:])
                best = ranks.argmin(axis=1)
                every = np.arange(len(ids))
                ended = ranks[every, best] == np.iinfo(np.int64).max
            for i, row in zip(number[ended].tolist(), ids[ended].tolist()):
                out[i] = [x for x in row if x >= 0]
            if ended.all():
                break
            going = ~ended
            ids, number, best, merged = ids[going], number[going], best[going], merged[going]
            every = np.arange(len(ids))
            ids[every, best] = merged[every, best]
            # close the gap that the right half of the pair leaves
            columns = np.arange(ids.shape[1] - 1)
            source = columns + (columns > best[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
        return out

    def _with_heap(self, word: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and (hit := self.lookup.get(ids[i] * self.base + ids[j])):
                heapq.heappush(heap, (hit[0], i, ids[i], ids[j]))

        for i in range(n):
            push(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.lookup[left * self.base + right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in ids if x >= 0]


class Transducer:
    """Minimal acyclic automaton over byte strings, with an id sequence for each string.

    Kept as flat tables: ``keys`` (state * 256 + byte, sorted), the state a transition leads
    to, the number of strings that come before those behind it, and which states end a
    string. A string's number is the sum along its path.
    """

    FIELDS = ("keys", "targets", "skipped", "ends", "starts", "ids")

    def __init__(self, tables: dict[str, np.ndarray]):
        for name in self.FIELDS:
            setattr(self, name, tables[name])

    @classmethod
    def compile(cls, words: list[bytes], ids: list[list[int]]) -> Transducer:
        order = sorted(range(len(words)), key=words.__getitem__)
        registry: dict[tuple, int] = {}
        states: list[tuple] = []  # per state: (ends, ((byte, target), ...))

        def frozen(ends: bool, arcs: list) -> int:
            key = (ends, tuple(arcs))
            if key not in registry:
                registry[key] = len(states)
                states.append(key)
            return registry[key]

        path: list[list] = [[False, [], -1]]  # ends, arcs, byte that leads here
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                ends, arcs, byte = path.pop()
                path[-1][1].append((byte, frozen(ends, arcs)))

        for i in order:
            word = words[i]
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            close(shared)
            path.extend([False, [], byte] for byte in word[shared:])
            path[-1][0] = True
            last = word
        close(0)
        root = frozen(path[0][0], path[0][1])
        # targets are frozen before their sources, so one pass counts the strings behind
        behind, keys, targets, skipped = [0] * len(states), [], [], []
        for number, (ends, arcs) in enumerate(states):
            total = int(ends)
            for byte, target in arcs:
                keys.append(number * 256 + byte)
                targets.append(target)
                skipped.append(total)
                total += behind[target]
            behind[number] = total
        sequences = [ids[i] for i in order]
        return cls({
            "keys": np.array([*keys, root * 256 + 256], np.int64),
            "targets": np.array([*targets, root], np.int32),
            "skipped": np.array([*skipped, 0], np.int32),
            "ends": np.array([e for e, _ in states], np.uint8),
            "starts": np.cumsum([0, *map(len, sequences)], dtype=np.int32),
            "ids": np.array([x for s in sequences for x in s], np.int32),
        })

    def to_bytes(self) -> bytes:
        parts = [getattr(self, n) for n in self.FIELDS]
        head = json.dumps([[p.dtype.str, p.nbytes] for p in parts]).encode().ljust(512)
        return head + b"".join(p.tobytes().ljust(-(-p.nbytes // 8) * 8) for p in parts)

    @classmethod
    def mapped(cls, blob: bytes) -> Transducer:
        """Write the tables to a file without a name and map it into memory."""
        with tempfile.TemporaryFile() as file:
            file.write(blob)
            file.flush()
            memory = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at, tables = 512, {}
        for name, (kind, size) in zip(cls.FIELDS, json.loads(memory[:512])):
            tables[name] = np.frombuffer(memory, kind, size // np.dtype(kind).itemsize, at)
            at += -(-size // 8) * 8
        return cls(tables)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 where the lexicon has no such word."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        arcs, root = self.keys[:-1], int(self.targets[-1])
        state = np.full(len(words), root, np.int64)
        number = np.zeros(len(words), np.int64)
        alive = np.arange(len(words)) if len(arcs) else np.arange(0)
        out = np.full(len(words), -1, np.int64)
        step = 0
        while len(alive):
            over = lengths[alive] == step
            done = alive[over]
            good = done[self.ends[state[done]] == 1]
            out[good] = number[good]
            alive = alive[~over]
            if not len(alive):
                break
            wanted = state[alive] * 256 + data[begins[alive] + step]
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            hit = arcs[at] == wanted
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            number[alive] += self.skipped[at]
            step += 1
        return out

    def sequence(self, number: int) -> list[int]:
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


def chunks(text: str) -> list[str]:
    """Cut where a word surely begins: before a lone space between two other characters."""
    first, *rest = SINGLE_SPACE.split(text) if ODD_SPACE.search(text) else text.split(" ")
    return [first, *(" " + piece for piece in rest)]


def split_words(chunk: str, specials: Iterable[str]) -> list[str]:
    """Words of a chunk; special strings are words of their own, as the library has it."""
    for special in specials:
        if special and special in chunk:
            left, _, right = chunk.partition(special)
            return [*split_words(left, specials), special, *split_words(right, specials)]
    return WORD.findall(chunk)


@dataclass
class Encoded:
    """A chunk: its ids as text with commas, how many they are, and the bytes they decode to."""

    ids: str
    n: int
    data: bytes


class Coder:
    """Encodes and decodes whole texts; remembers a bounded number of chunks."""

    def __init__(self, merges: Merges, lexicon: Transducer, cached: int = CACHED_CHUNKS):
        self.merges, self.lexicon, self.cached = merges, lexicon, cached
        # chunks of late, and those of the time before, which are forgotten unless met again
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.before: dict[str, tuple[str, int, bytes]] = {}

    def word_ids(self, words: list[str]) -> list[list[int]]:
        raw = [w.encode() for w in words]
        numbers = self.lexicon.numbers(raw).tolist()
        unseen = [i for i, n in enumerate(numbers) if n < 0]
        found = [self.lexicon.sequence(n) if n >= 0 else [] for n in numbers]
        for i, ids in zip(unseen, self.merges.encode([raw[i] for i in unseen])):
            found[i] = ids
        return found

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.merges.token_bytes.__getitem__, ids))

    def learn(self, new: list[str]) -> None:
        specials = self.merges.specials
        words = [split_words(chunk, specials) for chunk in new]
        distinct = list({w for ws in words for w in ws if w not in specials})
        ids = dict(zip(distinct, self.word_ids(distinct))) | {w: [i] for w, i in specials.items()}
        for chunk, ws in zip(new, words):
            whole = [i for w in ws for i in ids[w]]
            self.known[chunk] = (",".join(map(str, whole)), len(whole), self.decode(whole))

    def texts(self, texts: list[str | None]) -> list[Encoded]:
        cut = [chunks(t) if t else [] for t in texts]
        here = set().union(*cut)
        if len(self.known) > self.cached:
            self.before, self.known = self.known, {}
        missing = here.difference(self.known)
        again = missing.intersection(self.before)
        self.known.update(zip(again, map(self.before.__getitem__, again)))
        self.learn(list(missing.difference(again)))
        out, known = [], self.known.__getitem__
        for cs in cut:
            ids, ns, data = zip(*map(known, cs)) if cs else ((), (), ())
            out.append(Encoded(",".join(filter(None, ids)), sum(ns), b"".join(data)))
        return out


@lru_cache(maxsize=1)
def coder(vocabulary_json: str, lexicon: bytes) -> Coder:
    """One per Python worker, so the tasks it runs share the remembered chunks."""
    return Coder(Merges(vocabulary_json), Transducer.mapped(lexicon))


def word_counts(docs: DataFrame, specials: tuple[str, ...], text: str = "text") -> DataFrame:
    """(word, n) over all texts; counted in each task, in bounded portions, before rows meet."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()

        def flush():
            words = Counter()
            for chunk, n in seen.items():
                for word in split_words(chunk, specials):
                    words[word] += n
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w.encode() for w in words], pa.binary()),
                 pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for part in text_slices(batches, text, SLICE_BYTES):
            for t in part.column(text).to_pylist():
                if t:
                    seen.update(chunks(t))
            if len(seen) > CACHED_CHUNKS:
                yield flush()
        if seen:
            yield flush()

    rows = docs.select(F.col(f"`{text}`")).mapInArrow(counted, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> list[bytes]:
    """The words above the least count that leaves at most ``limit`` of them.

    The bound is on the lexicon alone: it keeps what is broadcast small. Other words are
    merged where they occur.
    """
    stored = store(counts.where("n > 1"), "word-counts")
    steps = stored.groupBy("n").count().orderBy(F.desc("n")).take(limit)
    total, least = 0, None
    for step in steps:
        total += step["count"]
        if total > limit:
            break
        least = step["n"]
    words = [] if least is None else [r.word for r in stored.where(F.col("n") >= least).collect()]
    drop(stored)
    return [bytes(w) for w in words]


def encode_decode(
    docs: DataFrame, vocabulary: str, lexicon_words: int = LEXICON_WORDS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: the key, n_tokens, ids (decimal, comma-joined) and decoded text's digests.

    ``vocabulary`` is the path of a byte-level BPE file. Ids equal those of the tokenizers
    library without special tokens, truncation or padding; special strings in a text map to
    their ids and back.
    """
    spark = docs.sparkSession
    source = read_vocabulary(vocabulary)
    merges = Merges(source)
    specials = tuple(merges.specials)
    words = frequent_words(word_counts(docs, specials, text), lexicon_words)
    lexicon = Transducer.compile(words, merges.encode(words))
    shared = spark.sparkContext.broadcast((source, lexicon.to_bytes()))

    def make():
        gc.disable()  # the remembered chunks hold no cycles, and walking them costs time
        texts_of = coder(*shared.value).texts

        def work(keys, texts):
            found = texts_of(texts)
            decoded = [e.data.decode("utf-8", "replace") for e in found]
            return {
                key: keys,
                "n_tokens": [e.n for e in found],
                "ids_sha256": [sha256(e.ids.encode()).hexdigest() for e in found],
                "decoded_sha256": [sha256(d.encode()).hexdigest() for d in decoded],
            }

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(
        docs, [key, text],
        f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", make,
        sliced=text,
    )
