"""Language identification by a small convolutional network over bytes.

A text is cut into windows of ``WINDOW`` bytes, the last one padded with zeros.
Filters of several widths slide over a window, each filter's largest response
counts (max pooling), and a softmax layer turns the responses into a
probability per language. A filter over bytes is a sum of table entries, one
table per position in the filter, so a window costs lookups and additions
only. A text's probabilities are the mean over all of its windows, weighted by
their bytes.

The network is trained in numpy on a bounded sample of labelled texts:
``SAMPLE_DOCS`` documents per language, about, and at most ``SAMPLE_CHARS``
characters of each, from a place that a hash chooses. Which texts those are
depends on hashes of their ids only.

A null text, or one without a letter, is ``und`` with score 0; so is every text
when nothing labelled is there to learn from. Repeated ids are separate rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.common import fresh

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 6
SAMPLE_DOCS = 400
SAMPLE_CHARS = 2048
HASH_RANGE = 1 << 30
EPOCHS = 12
BATCH = 48
# Windows whose responses are held at once.
BLOCK = 32
UNKNOWN = "und"
# Some number signs are among these too, so what is found is looked at again.
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """Rows of ``size`` bytes."""
    data += b"\0" * (-len(data) % size)
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, size)


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, filters)
    bias: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def responses(self, x: np.ndarray, where: bool = False):
        """Pooled responses of all filters, and the places of the maxima."""
        pooled, places = [], []
        for table, bias in zip(self.tables, self.bias):
            width = len(table)
            steps = x.shape[1] - width + 1
            sums = table[0][x[:, :steps]]
            for k in range(1, width):
                sums += table[k][x[:, k : k + steps]]
            if where:
                place = sums.argmax(axis=1)
                places.append(place)
                pooled.append(np.take_along_axis(sums, place[:, None, :], axis=1)[:, 0, :] + bias)
            else:
                pooled.append(sums.max(axis=1) + bias)
        return np.maximum(np.concatenate(pooled, axis=1), 0), places

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The same responses for scoring: one lookup per position, of all
        filters that reach it. Widths ascend, so these are the last ones."""
        size = x.shape[1]
        sums = None
        for k in range(max(map(len, self.tables))):
            rows = np.concatenate([t[k] for t in self.tables if len(t) > k], axis=1)
            found = rows.take(x[:, k:], axis=0)
            if sums is None:
                sums = found
            else:
                sums[:, : size - k, -rows.shape[1] :] += found
        at = 0
        for table in self.tables:  # where a filter would reach over the end
            sums[:, size - len(table) + 1 :, at : at + table.shape[2]] = -np.inf
            at += table.shape[2]
        return np.maximum(sums.max(axis=1) + np.concatenate(self.bias), 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), dtype=np.float32)
        for at in range(0, len(x), BLOCK):
            hidden = self.pooled(x[at : at + BLOCK])
            out[at : at + BLOCK] = softmax(hidden @ self.weights + self.offset)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        data = text.encode()
        total = np.zeros(len(self.languages))
        piece = WINDOW * 4096
        for at in range(0, len(data), piece):
            part = data[at : at + piece]
            chances = self.probabilities(windows(part))
            weight = np.full(len(chances), WINDOW, dtype=np.float64)
            weight[-1] -= -len(part) % WINDOW
            total += weight @ chances
        best = int(total.argmax())
        return self.languages[best], float(min(1.0, total[best] / len(data)))


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: Sequence[str], epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Adam on the cross-entropy of windows ``x`` with language numbers ``y``."""
    rng = np.random.default_rng(seed)
    hidden = FILTERS * len(WIDTHS)
    net = Network(
        list(languages),
        [rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, (hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    values = [*net.tables, *net.bias, net.weights, net.offset]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            step += 1
            for v, g, m, s in zip(values, gradients(net, x[rows], y[rows]), first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                v -= rate * m / (np.sqrt(s) + 1e-7)
    return net


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    hidden, places = net.responses(x, where=True)
    error = softmax(hidden @ net.weights + net.offset)
    error[np.arange(n), y] -= 1
    error /= n
    back = (error @ net.weights.T) * (hidden > 0)
    tables, bias = [], []
    for i, (table, place) in enumerate(zip(net.tables, places)):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        grad = np.zeros_like(table)
        column = np.broadcast_to(np.arange(FILTERS), place.shape)
        for k in range(len(table)):
            np.add.at(grad[k], (x[np.arange(n)[:, None], place + k], column), own)
        tables.append(grad)
        bias.append(own.sum(axis=0))
    return [*tables, *bias, hidden.T @ error, error.sum(axis=0)]


def fit(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Network:
    """A network that has learnt from rows with ``learn`` and a language: about
    ``sample_docs`` of each, ``sample_chars`` characters of a text."""
    known = learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    sizes = {r[0]: r[1] for r in docs.where(known).groupBy(lang_col).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Network([], [], [], np.zeros((0, 0)), np.zeros(0))
    hashed = F.pmod(F.xxhash64(id_col), F.lit(HASH_RANGE))
    below = F.create_map(
        *[F.lit(x) for lang, n in sizes.items() for x in (lang, int(HASH_RANGE * min(1.0, sample_docs / n)))]
    )
    room = F.greatest(F.length(text_col) - sample_chars, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(F.lit(7), id_col), room) + 1).cast("int")
    sample = (
        docs.where(known & (hashed < F.element_at(below, F.col(lang_col))))
        .select(lang_col, F.substring(F.col(text_col), start, F.lit(sample_chars)).alias("part"))
        .collect()
    )
    number = {lang: i for i, lang in enumerate(languages)}
    x, y = [], []
    for lang, part in sorted(sample, key=lambda r: (r[0], r[1])):
        if has_letter(part):
            rows = windows(part.encode())
            x.append(rows)
            y += [number[lang]] * len(rows)
    if not x:
        return Network([], [], [], np.zeros((0, 0)), np.zeros(0))
    return train(np.concatenate(x), np.array(y), languages)


def predict(net: Network, text: Column) -> Column:
    """``struct<lang, score>`` of a text column."""

    @F.pandas_udf("lang string, score double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([net.predict(t) for t in texts], columns=["lang", "score"])

    return of(text)


def accepted(
    docs: DataFrame, net: Network, text_col: str = "text", least: float = 0.4, allowed: Sequence[str] | None = None
) -> DataFrame:
    """The rows whose text is in a known language (one of ``allowed``, where
    given) with at least that score; rows and columns as they were."""
    name = fresh(docs, "predicted")
    rows = docs.withColumn(name, predict(net, F.col(text_col)))
    lang = F.col(name)["lang"]
    good = (lang != UNKNOWN) & (F.col(name)["score"] >= least)
    if allowed is not None:
        good = good & lang.isin(list(allowed))
    return rows.where(good).select([F.col(f"`{c}`") for c in docs.columns])
