"""Personal data: fixed patterns, and candidates judged by gradient-boosted trees.

The fixed patterns find addresses, network addresses, payment cards and phone numbers; their
spans always stay. Generators of high recall then propose further spans, which may overlap:
whole runs of key-like characters, with and without dots, that hold a digit or are long, of any
length upwards; values after words such as ``password``, to their end; and number groups of any
grouping. Boosted trees judge each proposal by its format (length, shares of character
kinds, entropy, group sizes) and by its context (the words and signs before it). The threshold
of a kind is calibrated on held-out examples for a wanted precision. Of overlapping proposals
the most probable stays, on ties the longer, then the first; none overlaps a fixed span.

The trees are trained on the driver from generated examples (``examples`` of them, seeded), so
the model is the same at every input size. All scans are linear in the text. Null text counts
as empty: no spans. Spans count code points, their end is exclusive.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
# keys and passwords; phone numbers in national form; other grouped numbers of a person
ADDED_KINDS = ("secret", "contact", "number")
KINDS = BASE_KINDS + ADDED_KINDS

Span = tuple[int, int, str]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A digit run is entered at its start only: what fails there fails at its other digits too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    found, floor, at = [], 0, text.find("@")
    local = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in local:
            begin -= 1
        floor = at + 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            found.append((begin, domain.end(), "email"))
            floor = domain.end()
        at = text.find("@", floor)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    found = emails(text) if "@" in text else []
    if not DIGIT.search(text):
        return found
    found += [
        (m.start(), m.end(), "ip") for m in IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))
    ]
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) <= 37:
            digits = re.sub("[ -]", "", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [
            (m.start(), m.end(), "phone") for m in PHONE.finditer(text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15
        ]
    return sorted(found, key=by_place)


def by_place(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


# --- candidates ---------------------------------------------------------------------

RUN = re.compile(r"[A-Za-z0-9_/+=.-]*")
RUN_CHARS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/+=.-")
LONG = re.compile(r"(?<![A-Za-z0-9_/+=.-])[A-Za-z0-9_/+=.-]{12,}+")
NAMED = re.compile(
    r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|credential)s?"
    r"[ \t]{0,3}[=:][ \t]{0,3}[\"']?([^\s\"']{4,})"
)
NATIONAL = re.compile(r"(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
# Groups of digits and capitals: parts joined by signs make a group, groups follow by spaces.
PART = r"\(?[A-Z0-9]++(?!\w)\)?"
GROUP = rf"{PART}(?:[./-]{PART})*+"
GROUPS = re.compile(rf"(?<!\w){GROUP}(?:[ \u00a0]{GROUP})*+")
LEAST = 4  # characters of a secret
LEAST_DIGITS = 6  # of a grouped number
MOST_PLACES = 34  # digits and capitals of the longest account number (ISO 13616)
MOST_GROUPS = 9  # that number in groups of four
SIGNS = "=:\"'"
KIND_FEATURES = (0, 1)  # columns that tell the added kinds after the first
NEAR = 24  # characters of context before a candidate
JUDGED = 1 << 13  # proposals from which on the trees are asked


def run_spans(text: str, begin: int, end: int) -> list[Span]:
    """A run without the dots at its ends, its parts between dots, and what follows a '='."""
    while begin < end and text[begin] == ".":
        begin += 1
    while begin < end and text[end - 1] == ".":
        end -= 1
    places = [(begin, end)]
    if text.find(".", begin, end) >= 0:
        at = begin
        for part in text[begin:end].split("."):
            if len(part) >= 12 or DIGIT.search(part):
                places.append((at, at + len(part)))
            at += len(part) + 1
    for b, e in list(places):
        filled = e  # signs that fill up a code belong to it
        while filled > b and text[filled - 1] == "=":
            filled -= 1
        for cut in {text.find("=", b, filled), text.rfind("=", b, filled)} - {-1}:
            places.append((cut + 1, e))
    return [(b, e, "secret") for b, e in places if e - b >= LEAST]


def number_spans(text: str) -> list[Span]:
    """Neighbouring groups that hold enough digits and no more places than a number has."""
    found: list[Span] = []
    for m in GROUPS.finditer(text):
        if len(m[0]) <= LEAST_DIGITS or sum(map(m[0].count, "0123456789")) < LEAST_DIGITS:
            continue
        groups = [
            (g.start() + m.start(), g.end() + m.start(), sum(map(str.isdigit, g[0])),
             sum(map(str.isalnum, g[0])), len(re.findall("[A-Z0-9]+", g[0])))
            for g in re.finditer("[^ \u00a0]+", m[0])
        ]
        for i, (begin, *_) in enumerate(groups):
            digits = places = parts = 0
            for _, end, d, p, k in groups[i : i + MOST_GROUPS]:
                digits, places, parts = digits + d, places + p, parts + k
                if places > MOST_PLACES:
                    break
                if digits >= LEAST_DIGITS and parts > 1:
                    b, e, value = begin, end, text[begin:end]
                    if value[0] == "(" and value.find(")") in (-1, len(value) - 1):
                        b += 1
                    if value[-1] == ")" and value.rfind("(") in (-1, 0):
                        e -= 1
                    found.append((b, e, "number"))
    return found


def candidates(text: str) -> list[Span]:
    """Proposed spans; the same place may be proposed more than once."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        for m in NAMED.finditer(text):
            bare = len(m[1].rstrip(".,;:)]}>"))  # signs of the sentence after it
            found += [(m.start(1), m.start(1) + n, "secret") for n in (len(m[1]), bare) if n]
    for m in LONG.finditer(text):
        found += run_spans(text, *m.span())
    floor = 0
    first = DIGIT.search(text)
    if first:
        national = [m.span() for m in NATIONAL.finditer(text)]
        found += [(*place, "contact") for place in national]
        national = set(national)
        found += [s for s in number_spans(text) if s[:2] not in national]
    while first:
        begin = first.start()
        while begin > floor and text[begin - 1] in RUN_CHARS:
            begin -= 1
        end = RUN.match(text, first.end()).end()
        if LEAST <= end - begin < 12:
            found += run_spans(text, begin, end)
        floor = end
        first = DIGIT.search(text, max(end, first.end()))
    return list(dict.fromkeys(found))


CONTEXT = (
    re.compile(r"(?i)(password|passwd|pwd|token|secret|key|credential)[^\w]*$"),
    re.compile(r"(?i)(tel|phone|call|fax|mobile|contact)[^\w]*$"),
    re.compile(r"(?i)(sha\d*|md5|commit|checksum|version|isbn|order|ref|file|id|no)[^\w]*$"),
    re.compile(r"(?i)(ssn|security|iban|account|passport|tax|insurance|identity|personal|patient)"
               r"( (no|number|id))?[^\w]*$"),
)


# a value that goes on beyond the span, by signs or by a further group
JOINED = re.compile(r"[^\sA-Za-z0-9\"'()]{1,4}[A-Za-z0-9]")
JOINS = re.compile(r"[A-Za-z0-9][^\sA-Za-z0-9\"'()=:]+$")
GROUP_AFTER = re.compile(r"[ \u00a0][A-Z0-9]++(?!\w)")
GROUP_BEFORE = re.compile(r"(?<!\w)[A-Z0-9]+[ \u00a0]$")


def remainder(value: str) -> int:
    """Remainder by 97 of an account number, its first four places last (ISO 13616)."""
    plain = re.sub("[^A-Z0-9]", "", value)
    if not 15 <= len(plain) <= MOST_PLACES or not re.match("[A-Z]{2}[0-9]{2}", plain):
        return 0
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def features(text: str, span: Span) -> list[float]:
    begin, end, kind = span
    value, before = text[begin:end], text[max(0, begin - NEAR) : begin]
    n = len(value)
    counts = Counter(value)
    digits = sum(c.isdigit() for c in value)
    upper, lower = sum(c.isupper() for c in value), sum(c.islower() for c in value)
    hexa = sum(c in "0123456789abcdefABCDEF" for c in value)
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    parts = re.split(r"[^A-Za-z0-9]+", value)
    return [
        float(kind == "contact"), float(kind == "number"),
        n, digits / n, upper / n, lower / n, hexa / n, entropy, turns / n,
        max(map(len, parts)), len(parts), float(value.isupper()), float(value.startswith("AKIA")),
        float(bool(re.match(r"(ghp|gho|sk|pk|xox[abp])[_-]", value))),
        float(any(c in SIGNS for c in before[-2:])),
        *(float(bool(p.search(before))) for p in CONTEXT),
        sum(c in "aeiouAEIOU" for c in value) / n,
        float("(" in value), float(bool(re.match(r"(19|20)\d\d", value))),
        digits, min(map(len, parts)), len(parts[0]), len(parts[-1]),
        len(set(re.sub("[A-Za-z0-9]", "", value))), value.count("."), value.count("/"),
        float(remainder(value) == 1), float(bool(JOINED.match(text, end))),
        float(bool(JOINS.search(before))), float(bool(GROUP_AFTER.match(text, end))),
        float(bool(GROUP_BEFORE.search(before))),
    ]


# --- boosted trees ------------------------------------------------------------------


@dataclass
class Tree:
    """Flat binary tree: at a node go left where the feature is at most the cut."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            right = x[np.arange(len(x)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return self.value[node]


def grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, cuts: list, depth: int) -> Tree:
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.zeros(size, int), np.full(size, np.inf), np.zeros(size))
    rows_of = {0: np.arange(len(x))}
    for node in range(size):
        rows = rows_of.pop(node, np.arange(0))
        g, h = gradient[rows], weight[rows]
        tree.value[node] = g.sum() / (h.sum() + 1.0)
        if node >= size // 2 or not len(rows):
            if node < size // 2:
                rows_of |= {2 * node + 1: rows, 2 * node + 2: rows}
                tree.value[[2 * node + 1, 2 * node + 2]] = tree.value[node]
            continue
        best, whole = (1e-6, 0, np.inf), g.sum() ** 2 / (h.sum() + 1.0)
        for f, points in enumerate(cuts):
            for cut in points:
                left = x[rows, f] <= cut
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g.sum() - gl, h.sum() - hl
                if min(hl, hr) < 1e-3:
                    continue
                gain = gl**2 / (hl + 1.0) + gr**2 / (hr + 1.0) - whole
                if gain > best[0]:
                    best = (gain, f, cut)
        tree.feature[node], tree.cut[node] = best[1], best[2]
        left = x[rows, best[1]] <= best[2]
        rows_of[2 * node + 1], rows_of[2 * node + 2] = rows[left], rows[~left]
    return tree


@dataclass
class Model:
    """Trees of their own for each kind."""

    trees: dict[str, list[Tree]]
    start: dict[str, float]
    rate: float
    thresholds: dict[str, float]

    def probability(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, float)
        score = np.zeros(len(x))
        for kind, mine in by_kind(x).items():
            if len(mine):
                trees = sum(t.predict(x[mine]) for t in self.trees[kind])
                score[mine] = self.start[kind] + self.rate * trees
        return 1 / (1 + np.exp(-score))


def by_kind(x: np.ndarray) -> dict[str, np.ndarray]:
    """Places of the rows of each added kind."""
    contact, number = (x[:, f] > 0 for f in KIND_FEATURES)
    masks = zip(ADDED_KINDS, (~contact & ~number, contact, number))
    return {kind: np.flatnonzero(mask) for kind, mask in masks}


def calibrate(probability: np.ndarray, truth: np.ndarray, precision: float) -> float:
    """The least threshold from which the wanted precision holds."""
    order = np.argsort(-probability)
    hits = np.cumsum(truth[order])
    good = np.flatnonzero(hits / np.arange(1, len(order) + 1) >= precision)
    return float(max(0.5, probability[order][good[-1]])) if len(good) else 1.1


def generated(n: int, seed: int) -> tuple[list[list[float]], np.ndarray, list[str]]:
    """Labelled candidates from made-up sentences: half hold a private value."""
    rng = random.Random(seed)
    syllables = "the an er ti on re ou ha ing st en de la que ment sch ung ado os mi".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def pick(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))

    upper, digits, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    mixed = upper + upper.lower() + digits
    name = lambda: rng.choice(["password", "token", "secret", "api_key", "pwd"])
    number = lambda: (
        rng.choice(["{}-{}-{}", "({}) {}-{}", "{} {} {}", "{}.{}.{}"]).format(
            pick(digits, 3, 3), pick(digits, 3, 3), pick(digits, 4, 4))
    )
    dialled = lambda: rng.choice(["phone ", "call ", "tel: ", "contact: "])
    named = lambda: name() + rng.choice(["=", ": ", ' = "'])
    known = lambda: rng.choice([
        "ssn ", "ssn: ", "social security number ", "account: ", "passport ", "tax id ",
        "insurance number ", "personal number: ", "patient "])
    other = lambda: rng.choice(["order ", "ref ", "version ", "", "file ", "isbn "])

    def grouped(sizes: list[int], sign: str) -> str:
        return sign.join(pick(digits, k, k) for k in sizes)

    def national() -> str:
        sizes = rng.choice([[3, 2, 4], [3, 3, 3], [2, 2, 2, 2, 2], [3, 4, 4], [5, 6], [4, 3, 3],
                            [4, 4], [6, 4], [1, 2, 2, 2, 3, 3, 2], [3, 8], [4, 4, 4], [2, 4, 4]])
        return grouped(sizes, rng.choice(" -./" if len(sizes) > 2 else " -/"))

    def account() -> str:
        land, rest = pick(upper, 2, 2), pick(upper, 0, 4) + pick(digits, 11, 24)
        check = 98 - int("".join(str(int(c, 36)) for c in rest + land + "00")) % 97
        plain = f"{land}{check:02}{rest}"
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))

    def lettered() -> str:
        return f"{pick(upper, 2, 2)} {grouped([2, 2, 2], ' ')} {pick(upper, 1, 1)}"

    def dated() -> str:
        return rng.choice(["{2}-{1}-{0}", "{0}.{1}.{2}", "{1}/{0}/{2}", "{0} {1} {2}"]).format(
            f"{rng.randint(1, 28):02}", f"{rng.randint(1, 12):02}", rng.randint(1900, 2099))

    private = [
        lambda: ("AKIA" + pick(upper + digits, 16, 16), "", "secret"),
        lambda: (pick(hexa, 12, 64), named(), "secret"),
        lambda: (pick(mixed, 12, 44), named(), "secret"),
        lambda: (pick(mixed + "!$%&*#?", 8, 30) + pick(mixed, 2, 2), named(), "secret"),
        lambda: (pick(mixed, 45, 2000), named(), "secret"),
        lambda: (pick(mixed, 45, 2000), "", "secret"),
        lambda: (".".join(pick(mixed + "-_", 18, 700) + pick(mixed, 2, 2) for _ in range(3)),
                 rng.choice(["", named()]), "secret"),
        lambda: (rng.choice(["ghp_", "sk-", "xoxb-"]) + pick(mixed, 24, 40), "", "secret"),
        lambda: (pick(hexa, 32, 40), "", "secret"),
        lambda: (number(), dialled(), "contact"),
        lambda: (national(), rng.choice([dialled, known])(), "number"),
        lambda: (national(), known(), "number"),
        lambda: (account(), rng.choice(["", "iban ", "iban: ", "account "]), "number"),
        lambda: (account().replace(" ", ""), rng.choice(["", "iban: "]), "secret"),
        lambda: (lettered(), known(), "number"),
    ]
    harmless = [
        lambda: (word() + pick(digits, 1, 4) + word() + word() + word(), ""),
        lambda: (f"{rng.randint(1900, 2099)}-{pick(digits, 2, 2)}-{pick(digits, 2, 2)}-" + word(),
                 ""),
        lambda: (f"{rng.randint(1900, 2099)}{pick(digits, 4, 4)}T{pick(digits, 6, 6)}Z", ""),
        lambda: (word() + "/" + word() + "/" + word() + pick(digits, 1, 3), ""),
        lambda: ("-".join(word() for _ in range(4)) + "-" + pick(digits, 1, 4), ""),
        lambda: (pick(digits, 12, 24), rng.choice(["", "order ", "no. "])),
        lambda: (word() + "_" + pick(digits, 8, 8) + "_" + pick(digits, 4, 4), "file "),
        lambda: ((word() + word() + word())[:16], name() + ": "),
        lambda: (number(), rng.choice(["order ", "ref ", "version ", "", "file "])),
        lambda: (national(), other()),
        lambda: (lettered(), other()),
        lambda: (dated() + rng.choice(["", " " + pick(digits, 2, 2) + ":" + pick(digits, 2, 2)]),
                 rng.choice(["", known(), "on "])),
        lambda: (grouped([rng.randint(1, 4) for _ in range(rng.randint(3, 9))], " "), ""),
        lambda: (word() + pick(digits, 1, 6), ""),
        lambda: (pick(digits, 1, 6) + rng.choice(["", ".", "/", "-"]) + pick(digits, 1, 3), ""),
        lambda: ("".join(word() for _ in range(rng.randint(3, 6))), ""),
        lambda: (f"www.{word()}.{rng.choice(['com', 'de', 'org'])}/{word()}/{word()}-{word()}"
                 + pick(digits, 0, 5), ""),
        lambda: (".".join(word() for _ in range(rng.randint(2, 5))) + pick(digits, 0, 2), ""),
        lambda: (rng.choice("-=_.+/a0x") * rng.randint(12, 400), ""),
    ]
    rows, truth, kinds = [], [], []
    while len(rows) < n:
        yes = rng.random() < 0.5
        value, lead, *kind = rng.choice(private if yes else harmless)()
        head = " ".join(word() for _ in range(rng.randint(1, 8))) + " " + lead
        text = head + value + rng.choice([" ", '" ', ". ", "\n"]) + word()
        for span in candidates(text):
            exact = span[0] == len(head) and span[1] == len(head) + len(value)
            rows.append(features(text, span))
            truth.append(float(exact and span[2] in kind))
            kinds.append(span[2])
    return rows[:n], np.array(truth[:n]), kinds[:n]


def train(
    examples: int = 18000, trees: int = 40, depth: int = 3, rate: float = 0.3,
    precision: float = 0.99, seed: int = 7,
) -> Model:
    rows, truth, kinds = generated(examples, seed)
    x = np.array(rows, float)
    model = Model({}, {}, rate, {})
    fit = np.arange(len(x)) % 3 > 0  # the others calibrate the thresholds
    for k, mine in by_kind(x).items():
        mine = mine[fit[mine]]
        mx, mt = x[mine], truth[mine]
        cuts = [np.unique(np.quantile(c, np.linspace(0.05, 0.95, 12))) for c in mx.T]
        share = mt.mean()
        model.start[k], model.trees[k] = math.log(share / (1 - share)), []
        score = np.full(len(mine), model.start[k])
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tree = grow(mx, mt - p, p * (1 - p), cuts, depth)
            model.trees[k].append(tree)
            score += rate * tree.predict(mx)
    held = np.flatnonzero(~fit)
    p = model.probability([rows[i] for i in held])
    kind = np.array(kinds)[held]
    for k in ADDED_KINDS:
        mine = kind == k
        model.thresholds[k] = calibrate(p[mine], truth[held][mine], precision)
    return model


def free_candidates(text: str, base: list[Span]) -> list[Span]:
    """Proposals that overlap no fixed span."""
    begins = [b[0] for b in base]
    reached = list(accumulate((b[1] for b in base), max))

    def free(span: Span) -> bool:
        before = bisect_left(begins, span[1])  # fixed spans that begin before its end
        return not before or reached[before - 1] <= span[0]

    return [s for s in candidates(text) if free(s)]


def chosen_spans(proposed: list[Span], p: Iterable[float], model: Model) -> list[Span]:
    chosen: list[Span] = []
    likely = sorted(zip(proposed, p), key=lambda x: (-x[1], x[0][0] - x[0][1], x[0][0]))
    begun: list[int] = []  # chosen spans are apart, so begins and ends have one order
    ended: list[int] = []
    for s, q in likely:
        if q < model.thresholds[s[2]]:
            continue
        at = bisect_left(ended, s[0] + 1)  # the first chosen span that ends after its begin
        if at == len(begun) or begun[at] >= s[1]:
            chosen.append(s)
            begun.insert(at, s[0])
            ended.insert(at, s[1])
    return chosen


def find_all(texts: Iterable[str], model: Model) -> Iterator[tuple[list[Span], list[Span]]]:
    """Fixed spans, and all spans, of each text; both by start and then kind.

    The trees judge the proposals of many texts at once.
    """
    held: list[tuple[list[Span], list[Span]]] = []
    rows: list[list[float]] = []

    def judged():
        p = model.probability(rows) if rows else np.zeros(0)
        at = 0
        for base, proposed in held:
            added = chosen_spans(proposed, p[at : at + len(proposed)], model)
            at += len(proposed)
            yield base, sorted([*base, *added], key=by_place)

    for text in texts:
        base = base_spans(text)
        proposed = free_candidates(text, base)
        held.append((base, proposed))
        rows += [features(text, s) for s in proposed]
        if len(rows) >= JUDGED:
            yield from judged()
            held, rows = [], []
    yield from judged()


def find_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Fixed spans, and all spans; both by start and then kind."""
    return next(find_all([text], model))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def detect(
    docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: counts of the fixed kinds, their digest, and all spans."""
    model = model or train()

    def make():
        def work(keys, texts):
            found = list(find_all((t or "" for t in texts), model))
            out = {key: keys}
            for kind in BASE_KINDS:
                out[f"n_{kind}"] = [sum(s[2] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [sha256(written(b).encode()).hexdigest() for b, _ in found]
            out["spans"] = [written(every) for _, every in found]
            return out

        return work

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE_KINDS)
    return map_rows(
        docs, [key, text], f"{key} {kind}, {counts}, base_sha256 string, spans string", make
    )


def redacted(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in brackets; overlapping spans become one."""
    parts, at = [], 0
    for begin, end, kind in spans:
        if begin >= at:
            parts += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(
    docs: DataFrame, model: Model | None = None, text: str = "text", length: str = "n_chars"
) -> DataFrame:
    """The same rows and columns with spans replaced; null text stays null.

    Where there is a column ``length`` it is counted anew for changed texts.
    """
    model = model or train()

    @F.pandas_udf("string")
    def clean(texts):
        found = find_all((t or "" for t in texts), model)
        new = [
            redacted(t, spans) if spans else t for t, (_, spans) in zip(texts, found, strict=True)
        ]
        return pd.Series(new, dtype=object)

    done = docs.withColumn("__new", clean(F.col(f"`{text}`")))
    changed = ~F.col("__new").eqNullSafe(F.col(f"`{text}`"))
    columns = []
    for field in docs.schema:
        c = F.col(f"`{field.name}`")
        if field.name == text:
            c = F.col("__new")
        elif field.name == length:
            c = F.when(changed, F.char_length("__new").cast(field.dataType)).otherwise(c)
        columns.append(c.alias(field.name))
    return done.select(*columns)
