"""Mixing documents to target weights with soft domain membership.

A classifier learnt from labelled documents (softmax regression over the words
and shape marks that tell most about the domain) gives every document a
probability for each domain. Rates w >= 0 per document are then fitted so
that the expected tokens of a domain, the sum of w * tokens * probability over
all documents, match its target. This is least squares over as many unknowns as
there are documents, solved by projected gradient: every step adds the same
combination of a document's probabilities to its rate and clips the rate. So a
rate is a short chain of steps over the document's own probabilities, and only
the steps, a few numbers each, are kept. Each iteration is one aggregate of
the narrow table of probabilities; documents are neither shuffled nor joined.

With shares a_d = tokens_d / all tokens and the matrix M = sum a_d p_d p_d', the
objective is r' M^-1 r / 2 for the residual r = sum w_d a_d p_d - target, its
gradient for w_d in the metric of the shares is p_d' M^-1 r, and a step of
length 1 never overshoots. Once rates rest on a bound, M over the others is
tried first, which takes fewer steps. Targets that rates can meet are met in a
few steps. Those at the edge of what is possible, or beyond it (0 for a domain
that all documents belong to a little), would take thousands. Where ``STEPS``
steps do not meet the targets, the fixed point of the projected gradient is
sought directly: with a weight e on the distance from 1, it is one projected step
clip(1 - p' l) with l = M^-1 r / e, and the few numbers l are found by Newton's
method, each trial again one aggregate, for an e that shrinks until nothing is
gained. ``Fit.reached`` tells where the expected shares ended.

Everything is DataFrame expressions. Words are separated by ASCII white space
and lower-cased; a null text has no words and no tokens, and its rate follows
from its probabilities like any other. Unlabelled ids, repeated ids (each row
counts) and an empty table (rates of no rows) are fine; where there is no
labelled document, all domains are equally likely, and a label without a
document is not missed.
"""

from __future__ import annotations

import functools
import logging
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.common import fresh, stored
from tallyroad.llm.places import Scratch

log = logging.getLogger(__name__)

# Labelled documents the classifier is learnt from, about: all of a smaller
# table, and of a larger one those whose ids hash lowest.
SAMPLE = 20_000
# Words and shape marks the classifier looks at.
FEATURES = 128
LEAST_DOCS = 5
ROUNDS = 300
SHRINK = 1e-4
STEPS = 12
TOLERANCE = 1e-4
# Weights on the distance from 1 in the search for a fixed point, and the gain
# over the last one, in parts of the objective, below which it ends.
NEARNESS = (1e-1, 1e-2, 1e-3, 1e-4, 1e-5, 1e-6)
GAIN = 1e-3
TRIALS = 40
HASH_RANGE = 1 << 30

# Domains of the ``labels`` table and how a row belongs to them.
DOMAINS = ("clean", "low", "toxic")
SYMBOLS = "#*$%&|<>"
WHITE_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def label_domain() -> Column:
    """NULL, which is no label, where neither is bad and not both are known."""
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when(known, "clean")


def domain_ids(labels: DataFrame, domain: Column, id_col: str = "doc_id") -> DataFrame:
    """``id, domain`` of all labelled ids. An id with several labels takes the
    last by name."""
    one = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(domain).alias("domain"))
    return one.where(F.col("domain").isNotNull())


def labelled_ids(labels: DataFrame, domain: Column, id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows of ``domain_ids`` at most, chosen by a hash of the
    id."""
    one = domain_ids(labels, domain, id_col)
    n = one.count()
    below = HASH_RANGE if n <= sample else int(HASH_RANGE * sample / n)
    return one.where(F.pmod(F.xxhash64("id"), F.lit(HASH_RANGE)) < below)


def words(text: Column) -> Column:
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), WHITE_SPACE)
    return F.filter(split, lambda w: w != "")


def marks(text: Column, all_words: Column, own_words: Column) -> Column:
    """What a text looks like, as words no text can contain."""
    whole = F.coalesce(text, F.lit(""))
    length = F.greatest(F.length(whole), F.lit(1))
    count = F.greatest(F.size(all_words), F.lit(1))
    symbols = F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")) / length
    shouts = (F.length(whole) - F.length(F.replace(whole, F.lit("!!"), F.lit("")))) / length
    pipes = (F.length(whole) - F.length(F.replace(whole, F.lit("|"), F.lit("")))) / count
    variety = F.size(own_words) / count
    found = [
        F.when(symbols > 0.02, " symbols"),
        F.when(symbols > 0.1, " many symbols"),
        F.when(pipes > 0.1, " pipes"),
        F.when(pipes > 0.3, " many pipes"),
        F.when(shouts > 0.02, " shouts"),
        F.when(variety < 0.3, " repetitive"),
        F.when(variety < 0.15, " very repetitive"),
        F.when(F.size(all_words) < 50, " short"),
    ]
    return F.filter(F.array(*found), lambda m: m.isNotNull())


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row. A plain column would
    be written into every expression that uses it, and computed there again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def featured(df: DataFrame, text_col: str, tokens: str, features: str) -> DataFrame:
    """``df`` with its number of words, and its distinct words and marks."""
    split, own = fresh(df, "_words"), fresh(df, "_own")
    rows = pinned(pinned(df, split, words(F.col(text_col))), own, F.array_distinct(split))
    marked = F.concat(own, marks(F.col(text_col), F.col(split), F.col(own)))
    rows = rows.withColumns({tokens: F.size(split).cast("bigint"), features: marked})
    return rows.drop(split, own)


@dataclass(frozen=True)
class Classifier:
    """Softmax regression over the presence of features."""

    domains: tuple[str, ...]
    base: tuple[float, ...]
    weights: Mapping[str, tuple[float, ...]]

    def scores(self, features: Column) -> list[Column]:
        """One column per domain, of a row's distinct features."""
        if not self.weights:
            return [F.lit(float(b)) for b in self.base]
        known = F.array_intersect(features, F.array(*[F.lit(f) for f in self.weights]))
        vectors = {f: F.array(*[F.lit(float(x)) for x in w]) for f, w in self.weights.items()}
        table = F.create_map(*[x for f, w in vectors.items() for x in (F.lit(f), w)])
        # One look-up per feature, for all domains.
        start = F.array(*[F.lit(float(b)) for b in self.base])
        add = functools.partial(F.zip_with, f=lambda x, y: x + y)
        total = F.aggregate(F.transform(known, functools.partial(F.element_at, table)), start, lambda t, w: add(t, w))
        return [F.get(total, F.lit(k)) for k in range(len(self.base))]


def train(
    docs: DataFrame,
    labelled: DataFrame,
    domains: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    features: int = FEATURES,
) -> Classifier:
    """``labelled`` (``id, domain``) is bounded, so it may be broadcast."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    mine = texts.join(F.broadcast(labelled), F.col("_id") == F.col("id")).select("_text", "domain")
    rows = stored(featured(mine, "_text", "_tokens", "_features").drop("_text"), "mixing-sample")
    sizes = {r[0]: r[1] for r in rows.groupBy("domain").count().collect()}
    n = [sizes.get(d, 0) for d in domains]
    total = sum(n)
    even = tuple(math.log((x + 1) / (total + len(n))) for x in n)
    if not total:
        return Classifier(tuple(domains), even, {})
    counts = (
        rows.select("domain", F.explode("_features").alias("feature"))
        .groupBy("feature")
        .agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(domains)])
    )
    # Mutual information of "has the feature" and the domain.
    having = sum((F.col(f"n{k}") for k in range(1, len(n))), F.col("n0"))
    gain = F.lit(0.0)
    for k, size in enumerate(n):
        if size:
            for part, of in ((F.col(f"n{k}"), having), (F.lit(size) - F.col(f"n{k}"), F.lit(total) - having)):
                gain = gain + F.when(part > 0, part / total * F.log(part * float(total) / (of * float(size)))).otherwise(0.0)
    best = (
        counts.where(having >= LEAST_DOCS)
        .withColumn("gain", gain)
        .orderBy(F.col("gain").desc(), "feature")
        .limit(features)
        .collect()
    )
    chosen = [r["feature"] for r in best]
    if not chosen:
        return Classifier(tuple(domains), even, {})
    # The sample is bounded, and of each row only the chosen features come.
    known = F.array_intersect("_features", F.array(*[F.lit(f) for f in chosen]))
    sample = rows.select("domain", F.array_sort(known).alias("known")).collect()
    base, weights = regress(sorted(sample), chosen, domains, even)
    return Classifier(tuple(domains), base, dict(zip(chosen, weights)))


def regress(
    sample: Sequence[tuple[str, Sequence[str]]], chosen: Sequence[str], domains: Sequence[str], start: Sequence[float]
) -> tuple[tuple[float, ...], list[tuple[float, ...]]]:
    """Softmax regression by accelerated gradient descent."""
    column = {f: i for i, f in enumerate(chosen)}
    x = np.zeros((len(sample), len(chosen) + 1))
    y = np.zeros((len(sample), len(domains)))
    x[:, -1] = 1
    for i, (domain, known) in enumerate(sample):
        x[i, [column[f] for f in known]] = 1
        y[i, list(domains).index(domain)] = 1
    w = np.zeros((x.shape[1], y.shape[1]))
    w[-1] = start
    # Half the largest eigenvalue of the mean of x x' bounds the curvature.
    rate = 1 / (0.5 * np.linalg.norm(x, 2) ** 2 / len(x) + SHRINK)
    ahead, old = w, w
    for step in range(ROUNDS):
        scores = x @ ahead
        raised = np.exp(scores - scores.max(axis=1, keepdims=True))
        slope = x.T @ (raised / raised.sum(axis=1, keepdims=True) - y) / len(x)
        slope[:-1] += SHRINK * ahead[:-1]
        w = ahead - rate * slope
        ahead = w + step / (step + 3) * (w - old)
        old = w
    return tuple(w[-1].tolist()), [tuple(r) for r in w[:-1].tolist()]


def posteriors(df: DataFrame, model: Classifier, text_col: str, tokens: str, names: Sequence[str]) -> DataFrame:
    """``df`` with its number of words and a probability per domain."""
    features, scores = fresh(df, "_features"), fresh(df, "_scores")
    rows = featured(df, text_col, tokens, features)
    rows = pinned(rows, scores, F.array(*model.scores(F.col(features))))
    score = [F.get(F.col(scores), F.lit(k)) for k in range(len(names))]
    chances = [1.0 / sum((F.exp(other - s) for other in score), F.lit(0.0)) for s in score]
    return rows.withColumns(dict(zip(names, chances))).drop(features, scores)


@dataclass
class Fit:
    """Steps of the descent, or the one step to its fixed point, and expected
    shares before and after."""

    upper: float | None
    targets: list[float]
    steps: list[list[float]] = field(default_factory=list)
    start: list[float] = field(default_factory=list)
    reached: list[float] = field(default_factory=list)

    def rate(self, names: Sequence[str]) -> Column:
        """The rate of a row with these probability columns."""
        w = F.lit(1.0)
        for step in self.steps:
            move = sum((F.col(p) * c for p, c in zip(names[1:], step[1:])), F.col(names[0]) * step[0])
            w = F.greatest(F.lit(0.0), w - move)
            if self.upper is not None:
                w = F.least(F.lit(float(self.upper)), w)
        return w


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """A domain that hardly any document belongs to must not blow up steps."""
    return np.linalg.pinv(matrix, rcond=1e-9, hermitian=True)


def fixed_point(
    measure: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], goal: np.ndarray, matrix: np.ndarray, inverse: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The step l from rates of 1 that least squares end at, and the expected
    shares there. ``measure`` gives the shares for a step, and M over the
    documents whose rates are off their bounds."""
    step = np.zeros(len(goal))
    shares, near = measure(step)
    last = math.inf
    for weight in NEARNESS:

        def miss(step: np.ndarray, shares: np.ndarray) -> np.ndarray:
            return weight * matrix @ step - (shares - goal)

        error = miss(step, shares)
        for _ in range(TRIALS):
            if np.abs(error).max() <= TOLERANCE / 10:
                break
            way = -inverse_of(near + weight * matrix) @ error
            for length in (1.0, 0.5, 0.25, 0.1, 0.03, 0.01):
                trial = step + length * way
                new, off = measure(trial)
                left = miss(trial, new)
                if left @ inverse @ left < error @ inverse @ error * (1 - length / 10):
                    break
            else:
                break
            step, shares, near, error = trial, new, off, left
        residual = shares - goal
        value = residual @ inverse @ residual
        if np.abs(residual).max() <= TOLERANCE or value > last * (1 - GAIN):
            break
        last = value
    return step, shares


def fit(
    rows: DataFrame,
    names: Sequence[str],
    targets: Sequence[float],
    upper: float | None = None,
    steps: int = STEPS,
    relative: bool = False,
    held: Column | None = None,
) -> Fit:
    """Rates for ``rows`` (``_tokens`` and ``names``). Targets are shares of
    all tokens, or, if ``relative``, multiples of what the domains have now.
    Rows that are ``held`` count with a rate of 1 whatever the others' are."""
    free_rows = F.lit(True) if held is None else ~held
    k = len(names)
    total = rows.agg(F.sum("_tokens")).first()[0] or 0
    if not total:
        return Fit(upper, list(targets))
    share = F.col("_tokens") / float(total)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def measure(rate: Column, free: Column) -> tuple[np.ndarray, np.ndarray]:
        """Expected shares, and M over documents with ``free``."""
        rated = rows.withColumn("_rate", F.when(free_rows, rate).otherwise(1.0))
        weight = share * F.when(free & free_rows, 1.0).otherwise(0.0)
        sums = rated.agg(
            *[F.sum(share * F.col(n) * F.col("_rate")) for n in names],
            *[F.sum(weight * F.col(names[i]) * F.col(names[j])) for i, j in pairs],
        ).first()
        matrix = np.zeros((k, k))
        for (i, j), value in zip(pairs, sums[k:]):
            matrix[i, j] = matrix[j, i] = value
        return np.array(sums[:k]), matrix

    def inside(upper: float | None) -> Column:
        free = F.col("_rate") > 0.0
        return free if upper is None else free & (F.col("_rate") < upper)

    def measure_at(step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return measure(Fit(upper, [], [step.tolist()]).rate(names), inside(upper))

    start, matrix = measure(F.lit(1.0), F.lit(True))
    whole = inverse_of(matrix)
    goal = np.array(targets, dtype=float) * (start if relative else 1.0)
    result = Fit(upper, goal.tolist(), [], start.tolist(), start.tolist())
    reached, inverse = start, whole
    for _ in range(steps):
        residual = reached - goal
        if np.abs(residual).max() <= TOLERANCE:
            break
        # M over the rates that are off their bounds makes longer steps. Where
        # one leads astray, the step of the whole M, which never does, follows.
        for metric in (inverse, whole):
            result.steps.append((metric @ residual).tolist())
            rate = result.rate(names)
            new, near = measure(rate, inside(upper))
            near = inverse_of(near)
            if (new - goal) @ whole @ (new - goal) < residual @ whole @ residual * (1 - 1e-2):
                break
            result.steps.pop()
        else:
            break
        reached, inverse = new, near
        result.reached = reached.tolist()
    if np.abs(reached - goal).max() > TOLERANCE:
        step, ended = fixed_point(measure_at, goal, matrix, whole)
        if (ended - goal) @ whole @ (ended - goal) < (reached - goal) @ whole @ (reached - goal):
            result.steps, result.reached = [step.tolist()], ended.tolist()
    return result


def rates(
    docs: DataFrame,
    labelled: DataFrame,
    domains: Sequence[str],
    targets: Sequence[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    upper: float | None = None,
) -> DataFrame:
    """``id_col, n_tokens``, the probabilities ``p_<domain>`` and ``rate`` of
    every row."""
    model = train(docs, labelled, domains, id_col, text_col)
    names = [f"p_{d}" for d in domains]
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = stored(posteriors(plain, model, "_text", "_tokens", names).drop("_text"), "posteriors")
    result = fit(found, names, targets, upper)
    return found.select(
        F.col("_id").alias(id_col), F.col("_tokens").alias("n_tokens"), *names, result.rate(names).alias("rate")
    )


def resample(
    docs: DataFrame,
    labelled: DataFrame,
    domains: Sequence[str],
    multiples: Sequence[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    spared: str | None = None,
    spared_ids: DataFrame | None = None,
) -> DataFrame:
    """The rows that stay when the domains' expected tokens go to ``multiples``
    of what they are, no row more than once. A row stays if a hash of its id
    and text, between 0 and 1, is below its rate. Of whole rows, only those
    that would go are shuffled, to look for their ids among the spared ones.

    All rows whose most likely domain is ``spared`` stay, and those whose id is
    in ``spared_ids`` (``id``, each once). The rates of the others are then fitted to the other domains' multiples; as spared rows
    belong to those a little too, they may be out of reach, which is logged."""
    scratch = Scratch(docs.sparkSession)
    model = train(docs, labelled, domains, id_col, text_col)
    names = [f"p_{d}" for d in domains]
    chances, tokens = [fresh(docs, n) for n in names], fresh(docs, "_tokens")
    # Texts are classified once; their rows get the probabilities beside them.
    marked = scratch.keep(posteriors(docs, model, text_col, tokens, chances), "classified")
    narrow = [F.col(tokens).alias("_tokens"), *[F.col(c).alias(n) for c, n in zip(chances, names)]]
    found = marked.select(F.col(id_col).alias("_id"), *narrow)
    if spared_ids is None:
        flagged = found.withColumn("_sure", F.lit(False))
    else:
        ids = spared_ids.select(F.col("id").alias("_id"), F.lit(True).alias("_on"))
        flagged = found.join(ids, "_id", "left").withColumn("_sure", F.coalesce("_on", F.lit(False))).drop("_on")

    def likely(columns: Sequence[str]) -> Column:
        if spared is None:
            return F.lit(False)
        return F.col(columns[list(domains).index(spared)]) >= F.greatest(*[F.col(c) for c in columns])

    rows = scratch.keep(flagged.withColumn("_sure", F.col("_sure") | likely(names)), "flagged")
    aimed = [k for k, d in enumerate(domains) if d != spared]
    goals = [multiples[k] for k in aimed]
    result = fit(rows, [names[k] for k in aimed], goals, upper=1.0, relative=True, held=F.col("_sure"))
    scratch.drop(rows)
    for k, start, target, reached in zip(aimed, result.start, result.targets, result.reached):
        log.info("%s: share of tokens %.4f, target %.4f, reached %.4f", domains[k], start, target, reached)
    draw = F.pmod(F.xxhash64(id_col, text_col), F.lit(HASH_RANGE)) / float(HASH_RANGE)
    staying = likely(chances) | (draw < result.rate([chances[k] for k in aimed]))
    kept = marked.where(staying)
    if spared_ids is not None:
        # Only rows that would go are looked up by id.
        key = fresh(docs, "_id")
        ids = spared_ids.select(F.col("id").alias(key))
        kept = kept.unionByName(marked.where(~staying).join(ids, F.col(id_col) == F.col(key), "left_semi"))
    return kept.select([F.col(f"`{c}`") for c in docs.columns])
