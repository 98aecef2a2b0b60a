"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct word shingles (64-bit hashes of five words; a shorter
document is one shingle). ``HASHES`` minima are taken per set. Full minima make the band keys
that propose pairs; of each minimum only the low ``BITS`` bits are kept, packed into longs, and
equal fields of two signatures are counted with bit operations. Fields agree by chance with
probability 2**-BITS, so a count m of k estimates the similarity as
(m/k - 2**-BITS) / (1 - 2**-BITS). Pairs whose estimate is within five standard deviations of
the threshold or above are confirmed on the full sets.

No group is expanded into all its pairs. Equal sets are one class from the start. In each band
group members are paired with one pivot, another in every turn; confirmed links make
components, and a turn compares only those that are not in their pivot's component. Once turns
link few more, members of bands that still hold *different* components are compared where they
share one of their rarest shingles, as two linked sets do, by size and signature inside the join.
What stays apart after that shares no band or is no link, so turns change the number of pairs
and no result.

Null and empty texts have an empty set and are linked with nothing. Every row is a document of
its own: rows with one id and different texts are compared as such, each has the smallest id of
its component, and those that bear it are kept. A null id is never linked.
"""

from __future__ import annotations

import gc
from functools import lru_cache
from itertools import count

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import map_rows
from millwright.llm.components import components
from millwright.scratch import drop, store

SHINGLE = 5
THRESHOLD = (75, 100)  # similarity as a fraction of whole numbers
HASHES = 128
ROWS = 4  # minima per band: a pair at 0.75 shares none of 32 bands once in 200,000 times
BITS = 4
CACHED_WORDS = 500_000
PAIRS_AT_ONCE = 500  # pairs of one pivot that a group confirms
LEAST_GAIN = 50  # stars go on while a turn links one in so many of those left apart

FIELD_LOW = 0x1111111111111111  # the lowest bit of each 4-bit field


class WordHashes(dict):
    """64-bit hash of each word; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ASCII letters in lower case."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    h = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(words) - size + 1 + i]
    return np.unique(mixed(h))


@lru_cache(maxsize=4)
def hash_factors(hashes: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, hashes, dtype=np.uint64)


def minima(values: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    factors, shifts = hash_factors(hashes)
    least = np.full(hashes, np.uint64(2**64 - 1))
    for at in range(0, len(values), 4096):  # bounded memory for long texts
        part = values[at : at + 4096, None] * factors + shifts
        least = np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0))
    return mixed(least)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, 16 fields to a signed long."""
    fields = (least & np.uint64(2**BITS - 1)).reshape(-1, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(fields << shifts, axis=1).view(np.int64)


def band_keys(least: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = least.reshape(-1, rows)
    key = np.arange(len(bands), dtype=np.uint64)
    for column in bands.T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tie, n_shingles, digest of the set, packed signature, band keys).

    ``tie`` tells texts of one id apart.
    """

    def make():
        gc.disable()

        def work(ids, ties, texts):
            out = {"id": ids, "tie": ties, "n_shingles": [], "digest": [], "signature": [],
                   "bands": []}
            for t in texts:
                values = shingles(t)
                out["n_shingles"].append(len(values))
                if len(values):
                    least = minima(values)
                    out["digest"].append(xxhash.xxh128_digest(values.tobytes()))
                    out["signature"].append(packed(least).tolist())
                    out["bands"].append(band_keys(least).tolist())
                else:
                    for name in ("digest", "signature", "bands"):
                        out[name].append(None)
            return out

        return work

    return map_rows(
        texts_by_id(docs, key, text), ["id", "tie", "text"],
        "id bigint, tie bigint, n_shingles bigint, digest binary, signature array<bigint>,"
        " bands array<bigint>", make,
    )


def texts_by_id(docs: DataFrame, key: str, text: str) -> DataFrame:
    name = F.col(f"`{text}`")
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(name).alias("tie"),
        name.alias("text"),
    )


def agreeing_fields(left: Column, right: Column) -> Column:
    """How many fields two packed signatures share; only bit operations."""
    equal = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = left[i].bitwiseXOR(right[i])
        for shift in (2, 1):  # gather each field's bits in its lowest one
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        equal = equal + (64 // BITS) - F.bit_count(x.bitwiseAND(F.lit(FIELD_LOW)))
    return equal


def least_agreeing(threshold: tuple[int, int], deviations: float = 5.0) -> int:
    """Fields that a pair at the threshold shares, less five standard deviations."""
    chance = 2.0**-BITS
    p = threshold[0] / threshold[1] * (1 - chance) + chance
    return int(HASHES * p - deviations * (HASHES * p * (1 - p)) ** 0.5)


def confirm(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold.

    The set of a comes before those it is compared with. A pivot of many pairs is split into
    groups of ``PAIRS_AT_ONCE`` or so, and its set copied to each.
    """
    over, under = threshold
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_AT_ONCE).alias("groups"))
    pivots = sizes.withColumn("part", F.explode(F.expr("sequence(0, groups - 1)"))).select(
        "a", "part", F.lit(None).cast("long").alias("b"), F.col("a").alias("id")
    )
    others = pairs.join(sizes, "a").select(
        "a", F.expr("pmod(xxhash64(b), groups)").alias("part"), "b", F.col("b").alias("id")
    )
    rows = pivots.unionByName(others).join(sets, "id").select("a", "part", "b", "data")
    rows = rows.repartition(F.col("a"), F.col("part")).sortWithinPartitions(
        "a", "part", F.col("b").asc_nulls_first()
    )

    def make():
        held = [None, np.zeros(0, np.uint64)]

        def work(a, part, b, data):
            out = {"a": [], "b": []}
            for i, p, j, raw in zip(a, part, b, data):
                values = np.frombuffer(raw, np.uint64)
                if j is None:
                    held[:] = (i, p), values
                    continue
                common = len(np.intersect1d(held[1], values, assume_unique=True))
                union = len(held[1]) + len(values) - common
                if under * common >= over * union:
                    out["a"].append(i)
                    out["b"].append(j)
            return out

        return work

    return map_rows(rows, ["a", "part", "b", "data"], "a bigint, b bigint", make)


def near_duplicates(
    docs: DataFrame, threshold: tuple[int, int] = THRESHOLD, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its key, n_shingles, component_id and kept."""
    signed = store(signatures(docs, key, text), "signatures")
    # equal sets are one class, numbered as it is written
    place = F.struct("id", "tie")
    classes = store(
        signed.where("id is not null and digest is not null").groupBy("digest").agg(
            F.min(place).alias("first"), F.first("n_shingles").alias("size"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        ).select(F.monotonically_increasing_id().alias("rep"), "*"),
        "classes",
    )
    links = class_links(docs, classes, threshold, key, text)
    if links is None:
        placed = classes.select("digest", F.col("first.id").alias("component_id"))
    else:
        found = components(links).withColumnRenamed("id", "rep")
        placed = store(
            classes.select("rep", "digest", F.col("first.id").alias("id")).join(
                found, "rep", "left"
            ).select("digest", "id", F.coalesce("component_id", "rep").alias("component")),
            "placed",
        )
        least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
        placed = placed.join(least, "component").select("digest", "component_id")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return (
        signed.select("id", "n_shingles", "digest").join(placed, "digest", "left")
        .select(
            F.col("id").cast(docs.schema[key].dataType).alias(key), "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )


def class_links(
    docs: DataFrame, classes: DataFrame, threshold: tuple[int, int], key: str, text: str
) -> DataFrame | None:
    """Links (a, b) that join all classes of one component; None where no band is shared."""
    members = classes.select(F.col("rep").alias("id"), F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    grouped = store(members.join(shared, "band"), "band-groups")
    if grouped.isEmpty():
        drop(grouped)
        return None
    involved = store(
        classes.join(grouped.select(F.col("id").alias("rep")).distinct(), "rep").select(
            F.col("rep").alias("id"), "first", "size", "signature"),
        "involved",
    )
    sets = store(shingle_sets(docs, involved, key, text), "shingle-sets")
    links, known, enough = None, None, least_agreeing(threshold)
    for turn in count(1):
        # what shares a band and is not in one component yet
        component = grouped.withColumn("component", F.col("id")) if known is None else (
            grouped.join(known, "id", "left").withColumn(
                "component", F.coalesce("component_id", "id")).drop("component_id"))
        pivots = component.groupBy("band").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "component")).alias("pivot"),
        ).where("low < high").select("band", "pivot")
        apart = store(component.join(pivots, "band"), "apart")
        size = apart.select("id").distinct().count()
        if not size:
            break
        stars = apart.where("component <> pivot.component").select(
            F.col("pivot.id").alias("a"), F.col("id").alias("b")
        ).distinct()
        pairs = _likely(stars, involved, enough, threshold)
        now = store(confirm(pairs, sets, threshold), "links")
        gain = now.count()
        if gain:
            links = now if links is None else links.unionByName(now)
            if known is not None:
                drop(known)
            known = store(components(links), "components")
        drop(apart, pairs)
        if gain * LEAST_GAIN < size:
            break
    if size:
        more = _rest(grouped, known, involved, sets, enough, threshold)
        now = store(confirm(more, sets, threshold), "links")
        drop(more)
        links = now if links is None else links.unionByName(now)
    drop(grouped, involved, sets)
    if known is not None:
        drop(known)
    return links


def _rest(
    grouped: DataFrame, known: DataFrame | None, involved: DataFrame, sets: DataFrame,
    enough: int, threshold: tuple[int, int],
) -> DataFrame:
    """Likely pairs of different components among what shares a mixed band.

    Texts that have a long passage in common fill whole bands without being links, so pairs are
    not met by band: two sets that reach the threshold share one of their rarest shingles.
    """
    placed = grouped.select("band", "id", F.col("id").alias("component"))
    if known is not None:
        placed = grouped.join(known, "id", "left").select(
            "band", "id", F.coalesce("component_id", "id").alias("component"))
    mixed_bands = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("band")
    apart = placed.join(mixed_bands, "band").select("id", "component").distinct()
    apart = store(apart.join(involved.select("id", "size"), "id"), "apart")
    keys = store(_rarest(apart, sets, threshold), "rarest")
    # the largest component of a shingle is never compared with itself
    parts = keys.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    mains = parts.groupBy("shingle").agg(
        F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts")
    ).where("parts > 1").select("shingle", F.col("main.component").alias("main"))
    met = store(keys.join(mains, "shingle"), "rarest")
    x, y = met.where("component <> main").alias("x"), met.alias("y")
    over, under = threshold
    # where two sets meet first, they have in common what follows there at most
    common = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")) + 1
    more = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main"))
           | (F.col("x.component") < F.col("y.component")))
        & _sizes_allow(F.col("x.size"), F.col("y.size"), threshold)
        & (common * (over + under) >= (F.col("x.size") + F.col("y.size")) * over),
    ).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs = _likely(more, involved, enough, threshold)
    drop(apart, keys, met)
    return pairs


def _rarest(apart: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(id, component, size, shingle, place): of a set of n the rarest n - ceil(n * threshold) + 1.

    Shingles are placed by the number of sets that hold them, then by value, alike in all sets;
    those that one set alone holds come first and are left out.
    """
    over, under = threshold

    def make():
        def work(ids, components, sizes, datas):
            return {
                "id": [i for i, n in zip(ids, sizes) for _ in range(n)],
                "component": [c for c, n in zip(components, sizes) for _ in range(n)],
                "size": [n for n in sizes for _ in range(n)],
                "shingle": np.concatenate([np.frombuffer(d, np.int64) for d in datas]),
            }

        return work

    rows = map_rows(
        apart.join(sets, "id"), ["id", "component", "size", "data"],
        "id bigint, component bigint, size bigint, shingle bigint", make)
    shared = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    per_set = Window.partitionBy("id")
    placed = rows.join(shared, "shingle").withColumn(
        "place", F.col("size") - F.count("*").over(per_set)
        + F.row_number().over(per_set.orderBy("n", "shingle")))
    rarest = F.expr(f"size - (size * {over} + {under} - 1) div {under} + 1")
    return placed.where(F.col("place") <= rarest).drop("n")


def _sizes_allow(left: Column, right: Column, threshold: tuple[int, int]) -> Column:
    """Sets share at most the smaller one and unite to the larger one at least."""
    over, under = threshold
    return F.least(left, right) * under >= F.greatest(left, right) * over


def _likely(
    pairs: DataFrame, involved: DataFrame, enough: int, threshold: tuple[int, int]
) -> DataFrame:
    both = pairs
    for name in ("a", "b"):
        both = both.join(
            involved.select(F.col("id").alias(name), F.col("size").alias(f"{name}_size"),
                            F.col("signature").alias(f"{name}_signature")), name)
    return store(
        both.where(
            _sizes_allow(F.col("a_size"), F.col("b_size"), threshold)
            & (agreeing_fields(F.col("a_signature"), F.col("b_signature")) >= enough)
        ).select("a", "b"),
        "pairs",
    )


def shingle_sets(docs: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """(id, data): the sets of the given classes, one row each, as packed 64-bit values."""
    firsts = classes.select(F.col("id").alias("class"), "first.id", "first.tie")
    rows = texts_by_id(docs, key, text).join(firsts, ["id", "tie"]).groupBy("id", "tie").agg(
        F.first("class").alias("class"), F.min("text").alias("text"))

    def make():
        def work(ids, texts):
            return {"id": ids, "data": [shingles(t).tobytes() for t in texts]}

        return work

    return map_rows(rows, ["class", "text"], "id bigint, data binary", make)
