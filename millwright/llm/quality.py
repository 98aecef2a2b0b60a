"""Quality rules: document statistics, and a line-labelling conditional random field.

Every line of a document is content or boilerplate. A linear-chain conditional random field
scores the labels of a line from what the line looks like (its words, signs, capitals,
repetition) and from the label before it; Viterbi decoding finds the best sequence for the
whole document. The share of words in content lines decides whether the document stays.

The field is trained on the driver from a bounded sample of labelled documents: at most
``sample`` of each label, texts of at most ``SAMPLE_CHARS`` characters, chosen by a hash of
their id. A line's training label is that of its document. Without documents of both labels
there is nothing to learn, and every line counts as content.

Words are runs between the six ASCII white-space characters. Null text has no words and fails
the base rule. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_rows

SAMPLE = 600
SAMPLE_CHARS = 20_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
CONTENT, BOILERPLATE = 1, 0


@dataclass
class Statistics:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def repeat_words(words: list) -> int:
    """Words that stand in a 3-word window which the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, reached = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(i, reached)
            reached = i + 3
    return covered


def statistics(text: str) -> Statistics:
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(SPACE)]
    return Statistics(
        n_words=len(words),
        word_chars=len(text) - sum(map(text.count, SPACE.decode())),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeat_words(words),
    )


def base_failed(s: Statistics) -> bool:
    return s.n_words < MIN_WORDS or 100 * s.n_repeat_words > MAX_REPEAT_PERCENT * s.n_words


# --- lines --------------------------------------------------------------------------

FEATURES = 22


def split_lines(text: str) -> list[str]:
    """Lines that hold a word."""
    return [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of a document's lines, and their numbers of words."""
    rows, sizes, seen = [], [], set()
    for line in lines:
        words = line.split()
        n, chars = max(len(words), 1), max(len(line), 1)
        symbols = sum(map(line.count, SYMBOLS)) / n
        shouts = line.count("!") / n
        upper = sum(w.isupper() and len(w) > 1 for w in words) / n
        distinct = len(set(words)) / n
        length = sum(map(len, words)) / n
        digits = sum(w.isdigit() for w in words) / n
        commas = (line.count(",") + line.count(".")) / n
        rows.append((
            1.0, n <= 2, 3 <= n <= 8, n > 8, n > 40,
            symbols > 0.05, symbols > 0.3, symbols > 0.8, shouts > 0.1, shouts > 0.6,
            upper > 0.3, upper > 0.7, distinct < 0.5, distinct < 0.8,
            length < 3, length > 8, digits > 0.2, line in seen,
            line.rstrip()[-1:] in ".!?:;\"'", commas > 0.03, line.count("|") / chars > 0.02,
            line.count("http") > 0,
        ))
        sizes.append(len(words))
        seen.add(line)
    return np.array(rows, float).reshape(len(rows), FEATURES), np.array(sizes, float)


@dataclass
class LineField:
    """Weights of a linear chain with two labels."""

    emission: np.ndarray  # features x 2
    transition: np.ndarray  # 2 x 2
    first: np.ndarray  # 2

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Viterbi: the best label sequence; ties go to content."""
        n = len(x)
        if not n:
            return np.zeros(0, int)
        scores = (x @ self.emission).tolist()
        (t00, t01), (t10, t11) = self.transition.tolist()
        a, b = self.first[0] + scores[0][0], self.first[1] + scores[0][1]
        from_content: list[tuple[bool, bool]] = []
        for e0, e1 in scores[1:]:
            a0, b0, a1, b1 = a + t00, b + t10, a + t01, b + t11
            from_content.append((b0 >= a0, b1 >= a1))
            a, b = max(a0, b0) + e0, max(a1, b1) + e1
        label = int(b >= a)
        labels = [label]
        for step in reversed(from_content):
            label = int(step[label])
            labels.append(label)
        return np.array(labels[::-1])


def log_likelihood(field: LineField, x: np.ndarray, y: np.ndarray, real: np.ndarray):
    """Mean log likelihood of padded sequences and its gradients.

    ``x``: documents x lines x features, ``y``: labels, ``real``: which lines exist.
    """
    docs, lines, _ = x.shape
    e = x @ field.emission
    alpha = np.empty((docs, lines, 2))
    alpha[:, 0] = field.first + e[:, 0]
    for t in range(1, lines):
        step = alpha[:, t - 1, :, None] + field.transition
        step = np.logaddexp(step[:, 0], step[:, 1]) + e[:, t]
        alpha[:, t] = np.where(real[:, t, None], step, alpha[:, t - 1])
    whole = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    beta = np.zeros((docs, lines, 2))
    pairs = np.zeros((2, 2))
    for t in range(lines - 1, 0, -1):
        after = field.transition + (e[:, t] + beta[:, t])[:, None, :]
        on = real[:, t]
        joint = np.exp(alpha[:, t - 1, :, None] + after - whole[:, None, None])
        pairs += joint[on].sum(axis=0)
        back = np.logaddexp(after[:, :, 0], after[:, :, 1])
        beta[:, t - 1] = np.where(on[:, None], back, beta[:, t])
    marginal = np.exp(alpha + beta - whole[:, None, None]) * real[:, :, None]
    truth = np.eye(2)[y] * real[:, :, None]
    same = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    score = (truth * e).sum() + (same * field.transition).sum() + (truth[:, 0] * field.first).sum()
    gradient = LineField(
        np.einsum("dtf,dtk->fk", x, truth - marginal),
        same.sum(axis=(0, 1)) - pairs,
        (truth[:, 0] - marginal[:, 0]).sum(axis=0),
    )
    return score - whole.sum(), gradient


def train(documents: list[tuple[list[str], int]], rounds: int = 120, l2: float = 1.0) -> LineField:
    """Fit by gradient ascent with adaptive steps; ``documents``: (lines, label)."""
    field = LineField(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    if len({label for _, label in documents}) < 2:
        field.emission[0] = (-1.0, 1.0)
        return field
    done = sorted(((line_features(ls)[0], y) for ls, y in documents if ls), key=lambda d: len(d[0]))
    blocks = []
    for at in range(0, len(done), 128):  # of like length, so little is padded
        some = done[at : at + 128]
        longest = len(some[-1][0])
        x = np.zeros((len(some), longest, FEATURES))
        real = np.zeros((len(some), longest), bool)
        y = np.zeros((len(some), longest), int)
        for i, (rows, label) in enumerate(some):
            x[i, : len(rows)], real[i, : len(rows)], y[i] = rows, True, label
        blocks.append((x, y, real))
    parts = ("emission", "transition", "first")
    mean = {p: np.zeros_like(getattr(field, p)) for p in parts}
    square = {p: np.zeros_like(getattr(field, p)) for p in parts}
    for step in range(1, rounds + 1):
        slopes = [log_likelihood(field, *b)[1] for b in blocks]
        for p in parts:
            weights = getattr(field, p)
            g = (sum(getattr(s, p) for s in slopes) - l2 * weights) / len(done)
            mean[p] = 0.9 * mean[p] + 0.1 * g
            square[p] = 0.99 * square[p] + 0.01 * g * g
            weights += 0.1 * (mean[p] / (1 - 0.9**step)) / (
                np.sqrt(square[p] / (1 - 0.99**step)) + 1e-8
            )
    return field


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE
) -> list[tuple[list[str], int]]:
    """At most ``sample`` documents of each quality label, in the order of a hash.

    Labels without a document, and documents of more than ``SAMPLE_CHARS`` characters, take no
    place in the sample. Of several rows of one id the least text stands for all.
    """
    texts = docs.where(F.char_length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    known = labels.where("quality in (0, 1)").select("doc_id", "quality").distinct()
    known = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    some = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample)
            for q in (0, 1)]
    # two bounded sides of some hundred ids each, and one row for each of them
    rows = texts.join(F.broadcast(some[0].union(some[1])), "doc_id").groupBy(
        "doc_id", "quality").agg(F.min("text").alias("text")).collect()
    ordered = sorted(rows, key=lambda r: (r.doc_id, r.quality))
    return [(split_lines(r.text), r.quality) for r in ordered]


def content_share(field: LineField, text: str) -> float:
    x, sizes = line_features(split_lines(text))
    return float(sizes[field.decode(x) == CONTENT].sum() / sizes.sum()) if len(x) else 0.0


def judge(
    docs: DataFrame, field: LineField, min_share: float = MIN_CONTENT_SHARE,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: its statistics, its share of content, and whether it stays."""

    def make():
        def work(keys, texts):
            every = [statistics(t or "") for t in texts]
            failed = [base_failed(s) for s in every]
            shares = [content_share(field, t or "") for t in texts]
            out = {key: keys}
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
                out[name] = [getattr(s, name) for s in every]
            out["base_failed"] = failed
            out["kept"] = [not f and share >= min_share for f, share in zip(failed, shares)]
            out["content_share"] = shares
            return out

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(
        docs, [key, text],
        f"{key} {kind}, n_words bigint, word_chars bigint, n_symbols bigint,"
        " n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean,"
        " content_share double", make,
    )


def keep(docs: DataFrame, field: LineField, min_share: float = MIN_CONTENT_SHARE,
         text: str = "text") -> DataFrame:
    """The rows that stay, with their columns as they are."""

    @F.pandas_udf("boolean")
    def stays(texts):
        def one(t):
            t = t or ""
            return not base_failed(statistics(t)) and content_share(field, t) >= min_share

        return texts.map(one)

    return docs.where(stays(F.col(f"`{text}`")))
