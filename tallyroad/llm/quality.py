"""Quality rules by gradient-boosted trees over document statistics.

Every document gets base statistics and a few shares derived from its text.
Boosted trees, trained in numpy on a bounded sample of labelled documents, give
the probability that its quality label is 1. Trees are flattened into node
arrays and scored for a whole batch of rows at once, one level after another.
On chosen features (symbols, repeated lines, repeated words) the probability
may only fall as the feature grows: a split that would do otherwise is refused,
and the values below a split stay on their side of its middle.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has none and fails the
base rule. Without labels of both kinds every document that passes the base
rule is kept. A text is read in blocks, whatever its length. Repeated ids are
separate rows; an id labelled both ways counts as low quality.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.common import stored, word_blocks

SAMPLE = 20_000
HASH_RANGE = 1 << 30
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 64
LEAST_ROWS = 8
SHRINK = 1.0
SYMBOLS = "#*$%&|<>"
WHITE_SPACE = " \t\n\v\f\r"
LEAST_WORDS = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Features and their direction: -1 where more must never look better.
FEATURES = {
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "same_word_share": -1,
    "word_length": 0,
    "variety": 0,
    "bar_share": 0,
    "shout_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "line_words": 0,
    "n_words": 0,
}


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """``COUNTS`` and ``FEATURES`` of one text."""
    text = text or ""
    data = text.encode()
    # Of each word only a 64-bit hash is held.
    words = np.array([h for block in word_blocks(data) for h in map(hash, block)], dtype=np.int64).view(np.uint64)
    n = len(words)
    repeated = in_repeats(words)
    same = int((words[1:] == words[:-1]).sum())
    bars = data.count(b" | ")
    shouts = data.count(b"!!")
    spaces = sum(map(text.count, WHITE_SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WHITE_SPACE)]
    dup_lines = len(lines) - len(set(lines))
    chars = len(text) - spaces
    counts = [n, chars, symbols, dup_lines, repeated]
    per_word, per_char, per_line = 1 / max(n, 1), 1 / max(chars, 1), 1 / max(len(lines), 1)
    raw = np.frombuffer(data, dtype=np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    return counts, [
        symbols * per_char,
        dup_lines * per_line,
        repeated * per_word,
        same * per_word,
        chars * per_word,
        len(np.unique(words)) * per_word,
        bars * per_word,
        shouts * per_word,
        upper * per_char,
        digits * per_char,
        n * per_line,
        float(n),
    ]


def in_repeats(words: np.ndarray) -> int:
    """Words that are in a run of three which occurs at least twice."""
    if len(words) < 4:
        return 0
    odd = np.uint64(0x9E3779B97F4A7C15)
    runs = (words[:-2] * odd + words[1:-1]) * odd + words[2:]
    _, which, times = np.unique(runs, return_inverse=True, return_counts=True)
    twice = times[which] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(twice)] |= twice
    return int(inside.sum())


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the counts, and ``features`` (an array)."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            counts = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
            features = pa.array([r[1] for r in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, features], names=[id_col, *COUNTS, "features"])

    fields = ", ".join(f"{c} bigint" for c in COUNTS)
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {key}, {fields}, features array<double>")


@dataclass
class Forest:
    """Flat node arrays of all trees: a leaf points to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def train(
    x: np.ndarray,
    y: np.ndarray,
    directions: Sequence[int],
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
) -> Forest:
    """Boosting on the logistic loss with histograms of ``BINS`` quantiles."""
    share = np.clip(y.mean() if len(y) else 1.0, 1e-6, 1 - 1e-6)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    margin = np.full(len(y), np.log(share / (1 - share)))
    if 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            grow(nodes, binned, edges, p - y, p * (1 - p), np.arange(len(y)), directions, depth, rate, -np.inf, np.inf, margin)
    flat = nodes or [[0, 0.0, 0, 0, 0.0]]
    columns = list(zip(*flat))
    return Forest(
        float(np.log(share / (1 - share))),
        np.array(roots, dtype=np.int64),
        np.array(columns[0]),
        np.array(columns[1]),
        np.array(columns[2]),
        np.array(columns[3]),
        np.array(columns[4]),
        depth,
    )


def grow(nodes, binned, edges, slope, curve, rows, directions, depth, rate, low, high, margin) -> int:
    """Adds the best subtree of ``rows`` with values in [low, high]."""

    def leaf_value(g, h):
        return np.clip(-g / (h + SHRINK), low, high)

    me = len(nodes)
    g, h = slope[rows], curve[rows]
    value = float(leaf_value(g.sum(), h.sum()))
    nodes.append([0, 0.0, me, me, value * rate])
    best = (1e-9, 0, 0, 0.0, 0.0)
    if depth and len(rows) >= 2 * LEAST_ROWS:
        whole = gain(g.sum(), h.sum(), value)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            n = np.bincount(b, minlength=len(e) + 1)[:-1].cumsum()
            gl = np.bincount(b, g, len(e) + 1)[:-1].cumsum()
            hl = np.bincount(b, h, len(e) + 1)[:-1].cumsum()
            gr, hr = g.sum() - gl, h.sum() - hl
            vl, vr = leaf_value(gl, hl), leaf_value(gr, hr)
            win = gain(gl, hl, vl) + gain(gr, hr, vr) - whole
            win[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = -1
            if directions[f]:
                win[(vr - vl) * directions[f] < 0] = -1
            k = int(win.argmax())
            if win[k] > best[0]:
                best = (win[k], f, k, vl[k], vr[k])
    won, f, k, vl, vr = best
    if won <= 1e-9:
        margin[rows] += value * rate
        return me
    middle = (vl + vr) / 2
    bounds = ((low, high), (low, high))
    if directions[f] < 0:  # the left side is the better one
        bounds = ((middle, high), (low, middle))
    elif directions[f] > 0:
        bounds = ((low, middle), (middle, high))
    side = binned[rows, f] <= k
    children = [
        grow(nodes, binned, edges, slope, curve, part, directions, depth - 1, rate, *b, margin)
        for part, b in zip((rows[side], rows[~side]), bounds)
    ]
    nodes[me] = [f, float(edges[f][k]), *children, value * rate]
    return me


def gain(g, h, value):
    """How much a leaf of this value lowers the loss."""
    return -(g * value + 0.5 * (h + SHRINK) * value * value)


def labelled_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``id, label`` of about ``sample`` ids at most, chosen by a hash."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    n = one.count()
    below = HASH_RANGE if n <= sample else int(HASH_RANGE * sample / n)
    return one.where(F.pmod(F.xxhash64("id"), F.lit(HASH_RANGE)) < below)


def fit(measured: DataFrame, labelled: DataFrame, id_col: str = "doc_id") -> Forest:
    """``labelled`` is bounded: it may be broadcast and its features fetched."""
    rows = measured.join(F.broadcast(labelled), F.col(id_col) == F.col("id")).select("id", "label", "features").collect()
    rows = sorted((r[0], r[1], r[2]) for r in rows)
    x = np.array([r[2] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return train(x, np.array([r[1] for r in rows], dtype=float), list(FEATURES.values()))


def probability(forest: Forest, features: Column) -> Column:
    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in parts:
            x = np.array(rows.tolist(), dtype=float).reshape(len(rows), len(FEATURES))
            yield pd.Series(forest.probability(x))

    return of(features)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``kept`` and ``quality``, the
    probability the trees give."""
    measured = stored(measure(docs, id_col, text_col), "quality")
    forest = fit(measured, labelled_ids(labels), id_col)
    scored = measured.withColumn("quality", probability(forest, F.col("features")))
    return scored.select(
        id_col,
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("quality") >= threshold)).alias("kept"),
        "quality",
    )
