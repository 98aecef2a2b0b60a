"""Near-duplicate lines: a segment-partition edit join, with DataFrame functions only.

Lines within ``MAX_EDITS`` edits of each other are linked, and within ``LONG_EDITS`` where the
longer has ``LONG_CHARS`` characters or more. A line is cut into
``MAX_EDITS + 1`` segments of even length. A longer or equally long line within the threshold
holds at least one of them unchanged, at a place that can be off by few characters only; so
each line probes the segment index of every length it could match with those of its substrings
that a match allows (multi-match-aware windows). Where many lines have a segment in common, as
near copies of one text do, they meet by finer segments instead, of which all but one for each
edit must agree. Pairs that meet and differ in at most ``2 * MAX_EDITS`` letter parities, which no
pair within the threshold exceeds, are verified: what both begin
and end with is taken off. Of what is left, up to two edits are the first and the last place; for
more, the rest is compared by a banded bit-parallel edit distance, in which one machine word
holds the vertical differences of the 2 * MAX_EDITS + 1 cells of the band.

Equal lines are one row from the start, with its number of copies and its first place, so a
frequent line costs one row. Lines shorter than ``MIN_CHARS`` characters are not compared; with
``short`` their exact copies count, save those of blank lines. Null
text has no lines. Every row is a document of its own: lines are ordered by id, null last, and
among rows with one id by a hash of the text, then by row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.components import components
from millwright.scratch import drop, store

MAX_EDITS = 1
MIN_CHARS = 20
LONG_EDITS, LONG_CHARS = 2, 200
CROWD = 6  # lines with a segment in common, above which finer segments are compared
CROWDED = -1  # in place of their ids, which begin with 0
FINE_PARTS = {1: 8, 2: 6}  # segments by edits
LETTERS = "etaoinsrhldcumfpgwyb"
FILTER_WORDS = 1 << 16  # of 64 bits each: the fixed size of the filter on line ids


ROW = "__row"  # number of a stored row
PLACE = ("doc", "tie", "row", "line_no")


def line_rows(
    docs: DataFrame, key: str, text: str, min_chars: int = 0, short: bool = False
) -> DataFrame:
    """(doc, tie, row, line_no, line) of every line, numbered from 0.

    ``tie`` tells rows with one id but different texts apart; ``row`` tells equal ones apart
    where they are numbered, and is null where not.
    """
    row = F.col(ROW) if ROW in docs.columns else F.lit(None).cast("long")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("tie"),
        row.alias("row"), F.col(f"`{text}`").alias("text"),
    ).select("doc", "tie", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    if not min_chars:
        return rows
    takes_part = F.char_length("line") >= min_chars
    return rows.where(takes_part | F.col("line").rlike(r"[^\s]") if short else takes_part)


def distinct_lines(
    docs: DataFrame, key: str, text: str, min_chars: int, short: bool
) -> DataFrame:
    """One row per different line: an id, its copies and its first place."""
    place = F.struct(F.col("doc").isNull().alias("last"), *PLACE)
    rows = line_rows(docs, key, text, min_chars, short)
    return (
        rows.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("n_copies"))
        .select(
            F.monotonically_increasing_id().alias("id"), "line", "n_copies",
            *[F.col(f"first.{c}").alias(c) for c in PLACE],
            F.char_length("line").alias("n"),
        )
    )


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """First character (from 0) and size of segment i; the last segments take the rest."""
    size = F.floor(length / parts).cast("int")
    longer = (length - size * parts).cast("int")  # so many segments have one more
    before = F.greatest(F.lit(0), F.lit(i) - (F.lit(parts) - longer))
    return size * i + before, size + (F.lit(i) >= F.lit(parts) - longer).cast("int")


def alignments(edits: int, parts: int, shorter: int) -> list[tuple[int, list]]:
    """(choice, runs): what is left of a line of ``parts`` segments without ``edits`` of them.

    A run is (first segment, segment behind the last, shift): where it may begin in a line
    ``shorter`` characters longer. Segments without an edit of their own are left out beside
    those with several, so a gap changes the shift by no more than the segments it misses.
    """
    found = []
    for choice, gone in enumerate(combinations(range(parts), edits)):
        edges = [-1, *gone, parts]
        runs, missed = [], 0  # (first, behind the last, segments missed before it)
        for i, (left, right) in enumerate(zip(edges, edges[1:])):
            if right - left > 1:
                runs.append((left + 1, right, i - missed))
                missed = i
        after = edits - missed

        def shifts(at: int, shift: int, taken: list) -> None:
            if at == len(runs):
                if abs(shorter - shift) <= after:
                    found.append((choice, taken))
                return
            first, behind, gap = runs[at]
            for step in range(-gap, gap + 1):
                shifts(at + 1, shift + step, [*taken, (first, behind, shift + step)])

        shifts(0, 0, [])
    return found


def segment_key(shorter: int, choice: int, runs: list) -> Column:
    """Hash of length, choice and characters; equal text is confirmed later."""
    cut, inside = [], F.lit(True)
    for first, behind, shift in runs:
        begin, end = F.col(f"begin_{shorter}_{first}"), F.col(f"begin_{shorter}_{behind}")
        cut.append(F.substring(F.col("chars"), (begin + shift) * 4 + 1, (end - begin) * 4))
        if shift:
            inside = inside & (begin + shift >= 0) & (end + shift <= F.col("n"))
    return F.when(inside, F.xxhash64(F.col("n") - shorter, F.lit(choice), *cut))


def letter_parities(line: Column) -> Column:
    """Bit i: whether the line holds an odd number of letter i. An edit flips at most two."""
    bits = F.lit(0)
    for i, letter in enumerate(LETTERS):
        # bytes, as the letters are ASCII: their number is known without reading the line
        found = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter)))
        bits = bits + F.shiftleft(found.bitwiseAND(F.lit(1)), i)
    return bits


def key_rows(lines: DataFrame, keys: list[Column], parts: int, shorter: int) -> DataFrame:
    """(id, k). Characters have four bytes each, so that a substring is found without reading
    what comes before it."""
    begins = [
        segment(F.col("n") - less, i, parts)[0].alias(f"begin_{less}_{i}")
        for less in range(shorter + 1) for i in range(parts + 1)]
    cut = lines.select("id", "n", F.encode("line", "UTF-32").alias("chars"), *begins)
    return cut.select("id", F.explode(F.array(*keys)).alias("k")).where("k is not null")


def index_rows(lines: DataFrame, edits: int, parts: int) -> DataFrame:
    straight = {c: [(a, b, 0) for a, b, _ in runs] for c, runs in alignments(edits, parts, 0)}
    keys = [segment_key(0, choice, runs) for choice, runs in straight.items()]
    return key_rows(lines, keys, parts, 0)


def probe_rows(lines: DataFrame, edits: int, parts: int) -> DataFrame:
    """Substrings that may equal the segments of a line at most ``edits`` shorter."""
    keys = [
        segment_key(shorter, choice, runs)
        for shorter in range(edits + 1) for choice, runs in alignments(edits, parts, shorter)]
    return key_rows(lines, keys, parts, edits)


def fine_rows(lines: DataFrame, edits: int, parts: int, shorter: int) -> DataFrame:
    """(id, parities, k) by choices of ``parts`` segments, which are too many to write out.

    Each is a row of a constant table: how much shorter, the choice, and its runs, filled up
    with empty ones.
    """
    table = set()
    for less in range(shorter + 1):
        for choice, runs in alignments(edits, parts, less):
            if shorter or not any(shift for _, _, shift in runs):
                runs = [*runs, *[(0, 0, 0)] * (edits + 1 - len(runs))]
                table.add((less, choice, *[x for run in runs for x in run]))
    ways = "array(" + ", ".join(f"array({', '.join(map(str, t))})" for t in sorted(table)) + ")"
    cut = lines.select(
        "id", "n", letter_parities(F.col("line")).alias("parities"),
        F.encode("line", "UTF-32").alias("chars"),
    ).select("id", "n", "parities", "chars", F.explode(F.expr(ways)).alias("way"))
    way, length = F.col("way"), F.col("n") - F.col("way")[0]
    found, inside = [], F.lit(True)
    for at in range(2, 2 + 3 * (edits + 1), 3):
        begin, end = (segment(length, way[at + i], parts)[0] for i in (0, 1))
        shift = way[at + 2]
        found.append(F.substring(F.col("chars"), (begin + shift) * 4 + 1, (end - begin) * 4))
        inside = inside & (begin + shift >= 0) & (end + shift <= F.col("n"))
    return cut.where(inside).select("id", "parities", F.xxhash64(length, way[1], *found).alias("k"))


def common_prefix(a: Column, b: Column, limit: Column) -> Column:
    """How many characters both begin with, by bisection with steps of halving size."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(30, -1, -1)])

    def longer(found: Column, step: Column) -> Column:
        same = F.substr(a, found + 1, step) == F.substr(b, found + 1, step)
        return F.when((found <= limit - step) & same, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), longer)


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two character arrays whose sizes differ by at most ``edits``.

    Column j of the table holds the band of rows j - edits .. j + edits. ``vp`` and ``vn`` have
    a bit for each cell that is one more or one less than the cell above it; the score is
    followed along the lowest diagonal of the band, and along the last row once that is inside.
    """
    width = 2 * edits + 1
    m = F.size(a)
    full = (1 << width) - 1
    top = 1 << (width - 1)
    start = F.struct(
        # before the first column, rows above the table are flat and those in it grow by one
        F.lit((full >> edits) << edits & full).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"),
        F.lit(edits).cast("long").alias("score"),
    )

    def step(s: Column, j: Column) -> Column:
        # bit r: row j - edits + r of this column matches the character of b
        match = F.lit(0).cast("long")
        for r in range(width):
            row = j - edits + r
            same = (row >= 1) & (row <= m) & (
                F.get(a, (row - 1).cast("int")) == F.get(b, (j - 1).cast("int"))
            )
            match = match + F.when(same, F.lit(1 << r)).otherwise(F.lit(0))
        vp, vn = s["vp"], s["vn"]
        state = F.struct(s["score"].alias("score"), vp.alias("vp"), vn.alias("vn"),
                         match.alias("eq"))
        # let-bindings: a one-element array mapped by a function
        def diagonal(t: Column) -> Column:
            x = t["eq"].bitwiseOR(t["vn"])
            d0 = ((t["vp"] + x.bitwiseAND(t["vp"])).bitwiseXOR(t["vp"])).bitwiseOR(x)
            return F.struct(t["score"].alias("score"), t["vp"].alias("vp"), t["vn"].alias("vn"),
                            d0.bitwiseAND(F.lit(full)).alias("d0"))

        def horizontal(t: Column) -> Column:
            hp = t["vn"].bitwiseOR(F.bitwise_not(t["vp"].bitwiseOR(t["d0"]))).bitwiseAND(
                F.lit(full))
            hn = t["vp"].bitwiseAND(t["d0"])
            return F.struct(t["score"].alias("score"), t["d0"].alias("d0"), hp.alias("hp"),
                            hn.alias("hn"))

        def vertical(t: Column) -> Column:
            d = F.shiftright(t["d0"], 1)
            vp_next = t["hn"].bitwiseOR(F.bitwise_not(d.bitwiseOR(t["hp"]))).bitwiseAND(
                F.lit(full))
            vn_next = d.bitwiseAND(t["hp"])
            inside = j + edits <= m
            lowest = t["score"] + F.when(
                t["d0"].bitwiseAND(F.lit(top)) == 0, F.lit(1)).otherwise(F.lit(0))
            bit = F.pow(F.lit(2), m - j + edits).cast("long")  # the last row's bit
            along = t["score"] + F.when(t["hp"].bitwiseAND(bit) != 0, F.lit(1)).when(
                t["hn"].bitwiseAND(bit) != 0, F.lit(-1)).otherwise(F.lit(0))
            return F.struct(vp_next.alias("vp"), vn_next.alias("vn"),
                            F.when(inside, lowest).otherwise(along).cast("long").alias("score"))

        return F.transform(
            F.transform(F.transform(F.array(state), diagonal), horizontal), vertical
        )[0]

    columns = F.sequence(F.lit(1), F.size(b))
    # m < edits: the lowest diagonal starts below the last row, whose score is m
    begun = F.struct(start["vp"].alias("vp"), start["vn"].alias("vn"),
                     F.least(F.lit(edits), m).cast("long").alias("score"))
    return F.aggregate(columns, begun, step, lambda s: s["score"])


def two_edits(x: Column, y: Column) -> Column:
    """Whether two edits make x into y, which differ in their first and in their last place.

    No alignment can begin or end with a match, so one edit is its first column and one its
    last, and what lies between them is equal as it stands.
    """
    found = F.lit(False)
    for a, b in ((1, 1), (1, 0), (0, 1)):  # places of x and y that the first edit takes
        for c, d in ((1, 1), (1, 0), (0, 1)):  # and the last
            n, m = F.char_length(x) - (a + c), F.char_length(y) - (b + d)
            found = found | ((n >= 0) & (n == m) & (
                F.substr(x, F.lit(a + 1), n) == F.substr(y, F.lit(b + 1), m)))
    return found


def within(pairs: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of lines ``x`` and ``y`` that are at most ``edits`` apart.

    What is cut off is written in between: a predicate that moved below the cuts would
    compute them anew wherever it names a line.
    """
    shorter = F.least(F.char_length("x"), F.char_length("y"))
    pairs = pairs.where(F.abs(F.char_length("x") - F.char_length("y")) <= edits)
    cut = store(
        pairs.withColumn("n", common_prefix(F.col("x"), F.col("y"), shorter)), "line-heads"
    )
    cut = cut.select(
        "a", "b", F.reverse(F.expr("substr(x, n + 1)")).alias("x"),
        F.reverse(F.expr("substr(y, n + 1)")).alias("y"),
    )
    ends = store(
        cut.withColumn("n", common_prefix(F.col("x"), F.col("y"), shorter)), "line-tails"
    )
    rest = ends.select(
        "a", "b", F.expr("substr(x, n + 1)").alias("x"), F.expr("substr(y, n + 1)").alias("y"),
        (F.char_length("x") - F.col("n")).alias("nx"),
        (F.char_length("y") - F.col("n")).alias("ny"),
    )
    # rests differ in their first and in their last place, so within one edit they are empty
    # or a single character; in general they hold at least two edits or are that short
    near = F.when(
        F.least("nx", "ny") == 0, F.greatest("nx", "ny") <= edits
    ).when(
        (F.greatest("nx", "ny") > 1) & (F.lit(edits) < 2), F.lit(False)
    )
    if edits <= 2:
        near = near.otherwise((F.greatest("nx", "ny") == 1) | two_edits(F.col("x"), F.col("y")))
    else:
        near = near.otherwise(
            banded_distance(F.split("x", ""), F.split("y", ""), edits) <= edits)
    return rest.where(near).select("a", "b")


def perhaps_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be in ``ids``: a bitmap of hashes, of a fixed size.

    It has ``FILTER_WORDS`` rows at most, so it may be broadcast at any input size; an exact
    join follows, and now moves few of the long rows.
    """
    bit = f"pmod(xxhash64(id), {FILTER_WORDS * 64})"
    word, place = F.expr(f"{bit} div 64"), F.expr(f"cast({bit} % 64 as int)")
    bitmap = ids.select(word.alias("word"), place.alias("place")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("bits")
    )
    kept = rows.withColumn("word", word).withColumn("place", place).join(
        F.broadcast(bitmap), "word"
    )
    return kept.where(F.expr("shiftrightunsigned(bits, place) & 1 = 1")).select(*rows.columns)


def meeting(x: DataFrame, y: DataFrame, *more: Column) -> DataFrame:
    """(a, b): a line of ``x`` and another one of ``y`` with one key."""
    condition = (F.col("x.k") == F.col("y.k")) & (F.col("x.id") != F.col("y.id"))
    for c in more:
        condition = condition & c
    return x.alias("x").join(y.alias("y"), condition).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def candidates(lines: DataFrame, edits: int, longer: int) -> DataFrame:
    """(a, b), with repetitions, of all lines that may be within ``edits``.

    Where more than ``CROWD`` lines have a segment, one row stands for them; lines that meet it
    are compared by finer segments, most of which must agree.
    """
    x = probe_rows(lines.where(F.col("n") >= longer), edits, edits + 1)
    y = index_rows(lines, edits, edits + 1)
    crowded = store(y.groupBy("k").count().where(F.col("count") > CROWD).select("k"), "crowded")
    if crowded.isEmpty():
        return meeting(x, y)
    one = crowded.select(F.lit(CROWDED).alias("id"), "k")
    met = store(
        meeting(x, y.join(crowded, "k", "left_anti").select("id", "k").unionByName(one)),
        "line-meetings",
    )
    ids = met.where(F.col("b") == CROWDED).select(F.col("a").alias("id"))
    if longer:  # lines that are looked for only
        short = index_rows(lines.where(F.col("n") < longer), edits, edits + 1)
        ids = ids.unionByName(short.join(crowded, "k", "left_semi").select("id"))
    ids = ids.distinct()
    few = store(
        perhaps_in(lines.select("id", "n", "line"), ids).join(ids, "id", "left_semi"),
        "line-crowds",
    )
    parts = FINE_PARTS.get(edits, edits + 2)
    finer = meeting(
        fine_rows(few.where(F.col("n") >= longer), edits, parts, edits),
        fine_rows(few, edits, parts, 0),
        F.bit_count(F.col("x.parities").bitwiseXOR(F.col("y.parities"))) <= 2 * edits,
    )
    return met.where(F.col("b") != CROWDED).unionByName(finer)


def linked_pairs(lines: DataFrame, edits: int, longer: int = 0) -> DataFrame:
    """(a, b): pairs within ``edits`` whose longer line has at least ``longer`` characters."""
    pairs = store(
        candidates(lines, edits, longer).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "line-pairs",
    )
    involved = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = store(
        perhaps_in(lines.select("id", "line"), involved).join(involved, "id", "left_semi")
        .withColumn("parities", letter_parities(F.col("line"))),
        "line-texts",
    )
    ends = [texts.select(F.col("id").alias(end), F.col("parities").alias(f"parities_{end}"),
                         F.col("line").alias(line)) for end, line in (("a", "x"), ("b", "y"))]
    with_text = pairs.join(ends[0], "a").join(ends[1], "b").where(
        F.bit_count(F.expr("parities_a ^ parities_b")) <= 2 * edits
    ).select("a", "b", "x", "y")
    links = store(within(with_text, edits), "line-links")
    drop(pairs, texts)
    return links


def near_lines(
    docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, key: str = "doc_id",
    text: str = "text", short: bool = False,
) -> DataFrame:
    """One row per different line: line, first place, n_copies, n_links, and its class's place.

    ``kept`` marks the line that comes first in its class.
    """
    return classed_lines(docs, edits, min_chars, key, text, short).drop("__first_row")


def classed_lines(
    docs: DataFrame, edits: int, min_chars: int, key: str, text: str, short: bool
) -> DataFrame:
    """The rows of ``near_lines`` and the number of the row that holds the first place."""
    lines = store(distinct_lines(docs, key, text, min_chars, short), "lines")
    compared = lines.where(F.col("n") >= min_chars)
    if edits < LONG_EDITS:
        # the longer line of a pair decides, so no pair is met twice
        few = linked_pairs(compared.where(F.col("n") < LONG_CHARS), edits)
        more = linked_pairs(compared.where(F.col("n") >= LONG_CHARS - LONG_EDITS), LONG_EDITS,
                            LONG_CHARS)
        links = store(few.unionByName(more), "line-links")
        drop(few, more)
    else:
        links = linked_pairs(compared, edits)
    joined = components(links)
    counts = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(
        F.count("*").alias("n_links"))
    classes = joined.join(counts, "id")
    place = F.struct(F.col("doc").isNull().alias("last"), *PLACE)
    linked = lines.select("id", *PLACE).join(classes, "id")
    firsts = linked.groupBy("component_id").agg(F.min(place).alias("first"))
    linked = store(
        linked.join(firsts, "component_id").select("id", "n_links", "first"), "line-classes"
    )
    out = lines.join(linked, "id", "left")
    has = F.col("first").isNotNull()
    drop(links)
    return out.select(
        F.col("doc").alias(key), "line_no", "n_copies",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(has, F.col("first.doc")).otherwise(F.col("doc")).alias("class_doc_id"),
        F.when(has, F.col("first.line_no")).otherwise(F.col("line_no")).alias("class_line_no"),
        F.when(
            has, F.struct(*[F.col(f"first.{c}").alias(c) for c in PLACE]).eqNullSafe(
                F.struct(*PLACE)),
        ).otherwise(True).alias("kept"),
        "line", F.col("row").alias("__first_row"),
    )


def keep_first(docs: DataFrame, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
               key: str = "doc_id", text: str = "text", length: str = "n_chars",
               short: bool = False) -> DataFrame:
    """The documents without lines whose class has an earlier line.

    Documents keep their columns and the order of their lines; those of which nothing but
    white space is left, and that had more before, go. ``length`` is counted anew.
    """
    # numbers of rows hold only once they are written
    docs = store(docs.withColumn(ROW, F.monotonically_increasing_id()), "line-docs")
    classes = classed_lines(docs, edits, min_chars, key, text, short)
    # the one place at which a class of lines stays; lines without copies or links stay anyway
    gone = classes.where("n_copies > 1 or not kept").select(
        F.xxhash64("line").alias("h"), "line", F.col("__first_row").alias("first_row"),
        F.col("line_no").alias("first_no"), "kept",
    )
    rows = line_rows(docs, key, text, min_chars, short).withColumn("h", F.xxhash64("line"))
    hit = rows.join(gone, ["h", "line"]).where(
        ~(F.col("kept") & (F.col("row") == F.col("first_row"))
          & (F.col("line_no") == F.col("first_no")))
    )
    # named apart from whatever columns the documents bring along
    per_doc = hit.groupBy(F.col("row").alias(ROW)).agg(F.collect_set("line_no").alias("__gone"))
    name = F.col(f"`{text}`")
    joined = docs.join(per_doc, ROW, "left")
    left = F.concat_ws("\n", F.filter(
        F.split(name, "\n"), lambda line, i: ~F.array_contains(F.col("__gone"), i)))
    done = joined.withColumn("__new", F.when(F.col("__gone").isNull(), name).otherwise(left))
    stays = F.col("__gone").isNull() | F.col("__new").rlike(r"[^\s]")
    columns = []
    for f in docs.drop(ROW).schema:
        c = F.col(f"`{f.name}`")
        if f.name == text:
            c = F.col("__new")
        elif f.name == length:
            c = F.when(F.col("__gone").isNotNull(), F.char_length("__new").cast(f.dataType)
                       ).otherwise(c)
        columns.append(c.alias(f.name))
    return done.where(stays).select(*columns)
