"""Toxicity scores that do not depend on which group a text mentions.

A logistic regression over the presence of words and word beginnings (a language
that compounds or inflects shows an insult in many forms) is trained on labelled
texts.
For every labelled text that mentions an identity term, copies with the term
swapped for others of its family, or for a plain word, are made, and the
squared change of the score is part of what training minimises. So a group's
name cannot carry weight just because insults occur near it.

Training uses a bounded sample of labelled documents and the words that tell
most about the label there. Scoring reads whole texts, block by block. A null
or empty text has the score of a text without known words. Without labels of
both kinds the score is the share of toxic labels (0 where there is none).
Repeated ids are separate rows; an id labelled both ways counts as toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.common import byte_blocks, stored

SAMPLE = 20_000
HASH_RANGE = 1 << 30
WORDS = 4096
LEAST_DOCS = 3
ROUNDS = 250
SHRINK = 3e-4
FAIRNESS = 4.0
# How many standard deviations a word's toxic share has to be from the whole.
SIGMAS = 3.0
WORD = re.compile(r"\w+")
# Features a task counts before it hands its counts on.
COUNTED = 200_000
# Lengths of word beginnings; they are written with a star.
BEGINNINGS = (4, 5, 6)

# Identity terms by family; the first of each is the plain word.
FAMILIES = (
    ("person", "woman", "man", "girl", "boy", "transgender", "nonbinary"),
    ("people", "women", "men", "gays", "lesbians", "jews", "muslims", "christians", "immigrants", "refugees"),
    ("local", "black", "white", "asian", "latino", "african", "european", "american", "mexican", "chinese", "arab"),
    ("religious", "muslim", "jewish", "christian", "hindu", "buddhist", "catholic", "atheist"),
    ("someone", "gay", "lesbian", "bisexual", "straight", "queer"),
    ("citizen", "immigrant", "refugee", "foreigner", "native"),
    ("resident", "deaf", "blind", "disabled", "elderly", "young"),
)


def features(text: str | None) -> set[str]:
    """Words of a text in lower case, and their beginnings."""
    found: set[str] = set()
    for block in byte_blocks((text or "").encode()):
        found.update(WORD.findall(block.decode().lower()))
    return found | {w[:k] + "*" for w in found for k in BEGINNINGS if len(w) >= k}


class Known:
    """The features a model knows, looked up without building all others."""

    def __init__(self, names: Sequence[str]):
        self.words = {n for n in names if not n.endswith("*")}
        self.starts = {k: {n[:-1] for n in names if n.endswith("*") and len(n) == k + 1} for k in BEGINNINGS}

    def present(self, text: str | None) -> set[str]:
        found: set[str] = set()
        for block in byte_blocks((text or "").encode()):
            words = set(WORD.findall(block.decode().lower()))
            found |= self.words & words
            for k, starts in self.starts.items():
                if starts:
                    found |= {start + "*" for start in starts & {w[:k] for w in words}}
        return found


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray
    base: float

    def scorer(self):
        weights = dict(zip(self.words, self.weights.tolist()))
        known = Known(self.words)

        def score(text: str | None) -> float:
            margin = self.base + sum(weights[w] for w in sorted(known.present(text)))
            return 1 / (1 + float(np.exp(-np.clip(margin, -500, 500))))

        return score


def swaps(words: set[str], families: Sequence[Sequence[str]] = FAMILIES) -> list[set[str]]:
    """The text's words with the terms of one family changed for another."""
    out = []
    for family in families:
        mine = words & set(family[1:])
        if mine:
            out += [(words - mine) | {other} for other in family if {other} != mine]
    return out


def sparse(rows: Sequence[set[str]], column: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of all entries."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]) if rows else np.zeros(0, dtype=np.int64)
    return row.astype(np.int64), np.array([column[w] for r in rows for w in sorted(r)], dtype=np.int64)


def train(rows: Sequence[set[str]], labels: np.ndarray, words: Sequence[str], fairness: float = FAIRNESS) -> Model:
    """Adam on log loss + fairness * mean squared change of the score + shrinkage."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model([], np.zeros(0), 500.0 if share else -500.0)
    column = {w: i for i, w in enumerate(words)}
    row, col = sparse(rows, column)
    pairs = [(i, s & column.keys()) for i, r in enumerate(rows) for s in swaps(r)]
    origin = np.array([i for i, _ in pairs], dtype=np.int64)
    twin_row, twin_col = sparse([s for _, s in pairs], column)
    n, d = len(rows), len(words)
    w = np.zeros(d + 1)
    w[d] = np.log(share / (1 - share))
    first, second = np.zeros_like(w), np.zeros_like(w)

    def scores(r, c, size):
        return 1 / (1 + np.exp(-np.clip(np.bincount(r, w[c], size) + w[d], -500, 500)))

    def slope(r, c, size, part):
        return np.append(np.bincount(c, part[r], d), part.sum())

    for step in range(1, ROUNDS + 1):
        p = scores(row, col, n)
        part = (p - labels) / n
        g = np.zeros_like(w)
        if pairs and fairness:
            q = scores(twin_row, twin_col, len(pairs))
            change = 2 * fairness * (p[origin] - q) / len(pairs)
            part = part + np.bincount(origin, change, n) * p * (1 - p)
            g += slope(twin_row, twin_col, len(pairs), -change * q * (1 - q))
        g += slope(row, col, n, part)
        g[:d] += SHRINK * w[:d]
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(list(words), w[:d], float(w[d]))


def labelled_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """``id, label`` of about ``sample`` ids at most, chosen by a hash."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    n = one.count()
    below = HASH_RANGE if n <= sample else int(HASH_RANGE * sample / n)
    return one.where(F.pmod(F.xxhash64("id"), F.lit(HASH_RANGE)) < below)


def counted(batches: Iterator[pa.RecordBatch], limit: int = COUNTED) -> Iterator[pa.RecordBatch]:
    """``word, n, bad`` of batches of ``label, text``: texts, and texts of label
    1, that have the feature. A word comes again after ``limit`` others."""
    n: Counter[str] = Counter()
    bad: Counter[str] = Counter()

    def taken() -> pa.RecordBatch:
        columns = [pa.array(n, pa.string()), pa.array(n.values(), pa.int64()), pa.array([bad[w] for w in n], pa.int64())]
        n.clear(), bad.clear()
        return pa.RecordBatch.from_arrays(columns, names=["word", "n", "bad"])

    for batch in batches:
        for label, text in zip(batch.column(0), batch.column(1)):
            found = features(text.as_py())
            n.update(found)
            if label.as_py() == 1:
                bad.update(found)
            if len(n) >= limit:
                yield taken()
    if n:
        yield taken()


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> Model:
    """``labelled`` (``id, label``) is bounded, so it may be broadcast."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    mine = texts.join(F.broadcast(labelled), F.col("_id") == F.col("id"))

    # The sample is kept as texts: arrays of all their features would go through
    # the JVM's heap three times, and most features occur in one text only.
    rows = stored(mine.select("id", "label", F.col("_text").alias("text")), "toxicity-sample")
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    toxic, total = sizes.get(1, 0), sum(sizes.values())
    if not 0 < toxic < total:
        return train([], np.array([1.0] if toxic else []), [])
    counts = (
        rows.select("label", "text")
        .mapInArrow(counted, "word string, n bigint, bad bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    # How far the word's toxic share is from the whole, in standard deviations.
    share = toxic / total
    far = F.abs(F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)) + 1)
    best = counts.where((F.col("n") >= LEAST_DOCS) & (far >= SIGMAS)).orderBy(far.desc(), "word").limit(words).collect()
    terms = {t for family in FAMILIES for t in family}
    chosen = sorted({r["word"] for r in best} | terms)

    @F.pandas_udf("array<string>")
    def present(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Known(chosen)
        for texts in parts:
            yield texts.map(lambda t: sorted(known.present(t)))

    sample = sorted((r[0], r[1], r[2]) for r in rows.select("id", "label", present("text")).collect())
    return train([set(r[2]) for r in sample], np.array([float(r[1]) for r in sample]), chosen)


def score(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for texts in parts:
            yield pd.Series([scorer(t) for t in texts], dtype=float)

    return of(text)
