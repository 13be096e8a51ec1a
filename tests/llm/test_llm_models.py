"""Trained and counted models: mixing, language ID, language-model scores,
quality trees, toxicity."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroad.llm import langid, lmscore, mixing, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- mixing ---------------------------------------------------------------


def brute_fit(tokens, p, goal, steps=4000, upper=np.inf):
    """Plain projected gradient over all rates."""
    a = tokens / tokens.sum()
    inverse = np.linalg.pinv(p.T @ (a[:, None] * p), rcond=1e-9, hermitian=True)
    w = np.ones(len(a))
    for _ in range(steps):
        w = np.clip(w - p @ (inverse @ (p.T @ (a * w) - goal)), 0, upper)
    return p.T @ (a * w)


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = rng.integers(1, 500, 400)
    rows = spark.createDataFrame([(int(n), *map(float, r)) for n, r in zip(tokens, p)], "_tokens bigint, a double, b double, c double")
    # The last target is 0 for a domain that all documents belong to a little;
    # plain steps take thousands.
    for goal, near in (([0.9, 0.08, 0.02], 1e-3), ([0.2, 0.3, 0.5], 1e-3), ([0.5, 0.4, 0.3], 1e-3), ([0.6, 0.6, 0.0], 0.01)):
        fitted = mixing.fit(rows, ["a", "b", "c"], goal)
        found = rows.withColumn("w", fitted.rate(["a", "b", "c"]))
        w = np.array([r["w"] for r in found.collect()])
        assert w.min() >= 0 and len(fitted.steps) <= mixing.STEPS
        reached = p.T @ (tokens / tokens.sum() * w)
        assert np.allclose(reached, fitted.reached, atol=1e-9)
        assert np.abs(reached - brute_fit(tokens, p, np.array(goal))).max() < near
        assert np.abs(reached - goal).max() < max(near, 0.005)
    bounded = mixing.fit(rows, ["a", "b", "c"], [1.0, 0.3, 0.1], upper=1.0, relative=True)
    assert rows.where(bounded.rate(["a", "b", "c"]) > 1.0).count() == 0
    # Out of reach: no rates come nearer than the fixed point.
    far = np.array(bounded.targets)
    best = brute_fit(tokens, p, far, steps=20_000, upper=1.0)
    inverse = np.linalg.inv(p.T @ ((tokens / tokens.sum())[:, None] * p))
    value = lambda r: (r - far) @ inverse @ (r - far)
    assert value(np.array(bounded.reached)) < value(best) * 1.01 and value(best) > 1e-3


def test_mixing_query(spark):
    rows = queries.op4_mixing(spark, SF).toPandas()
    docs = documents(spark).toPandas()
    assert len(rows) == len(docs)
    assert dict(zip(rows.doc_id, rows.n_tokens)) == {i: len(t.encode().split()) for i, t in zip(docs.doc_id, docs.text)}
    chances = rows[[f"p_{d}" for d in mixing.DOMAINS]]
    assert np.allclose(chances.sum(axis=1), 1) and (rows.rate >= 0).all()
    reached = (chances.mul(rows.rate * rows.n_tokens, axis=0)).sum() / rows.n_tokens.sum()
    assert np.allclose(reached, [queries.MIX[d] for d in mixing.DOMAINS], atol=2e-3)
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("domain", mixing.label_domain()).toPandas()
    both = rows.merge(labels, on="doc_id")
    guess = both[chances.columns].idxmax(axis=1).str[2:]
    assert (guess == both.domain).mean() > 0.9


def test_mixing_plan_is_native(spark):
    plan = queries.op4_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def mixed(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, p_clean string, _tokens string")
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return docs, mixing.labelled_ids(marked, mixing.label_domain())


def test_labels_without_a_value_do_not_count(spark):
    rows = [(1, None, None), (2, 1, None), (3, None, 1), (4, 0, None), (5, 1, 0), (6, None, None), (6, 1, 0)]
    marked = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    got = dict(map(tuple, mixing.labelled_ids(marked, mixing.label_domain()).collect()))
    assert got == {3: "toxic", 4: "low", 5: "clean", 6: "clean"}


def test_mixing_edges(spark):
    rows = [(i, "good words here " * 20 if i % 2 else "bad bad words " * 20, "x", "y") for i in range(40)]
    rows += [(None, None, None, None), (1, "good words here", "x", "y"), (1, "good words here", "x", "y"), (99, "", "x", "y")]
    docs, labelled = mixed(spark, rows, [(i, i % 2, 0) for i in range(30)] + [(None, 1, 1), (5, None, None), (777, 1, 0)])
    out = mixing.rates(docs, labelled, mixing.DOMAINS, [0.8, 0.2, 0.0])
    assert out.count() == len(rows) and out.where("rate IS NULL OR isnan(rate)").count() == 0
    kept = mixing.resample(docs, labelled, mixing.DOMAINS, [1.0, 0.2, 0.1])
    assert kept.schema == docs.schema
    assert kept.where("doc_id % 2 = 1").count() >= 21 and kept.where("doc_id % 2 = 0").count() < 14
    for nothing in (docs.limit(0), docs):
        none = mixing.rates(nothing, labelled.limit(0), mixing.DOMAINS, [0.8, 0.1, 0.1])
        assert none.count() == nothing.count()


# --- language ID ------------------------------------------------------------


def test_pooled_responses_equal_convolution():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (3, 20)).astype(np.uint8)
    net = langid.train(x, np.array([0, 1, 0]), ["a", "b"], epochs=1)
    got, _ = net.responses(x)
    assert np.array_equal(net.pooled(x), got)
    for i, row in enumerate(x):
        plain = []
        for table, bias in zip(net.tables, net.bias):
            w = len(table)
            sums = [sum(table[k][row[t + k]].astype(float) for k in range(w)) for t in range(20 - w + 1)]
            plain += list(np.maximum(np.max(sums, axis=0) + bias, 0))
        assert np.allclose(got[i], plain, atol=1e-5)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    x, y = rng.integers(97, 110, (8, 16)).astype(np.uint8), rng.integers(0, 3, 8)
    net = langid.train(x, y, ["a", "b", "c"], epochs=1)
    net.tables = [t.astype(np.float64) for t in net.tables]
    net.bias = [b.astype(np.float64) + 0.05 for b in net.bias]
    net.weights, net.offset = net.weights.astype(np.float64), net.offset.astype(np.float64)

    def loss():
        hidden, _ = net.responses(x)
        return -np.log(langid.softmax(hidden @ net.weights + net.offset)[np.arange(8), y]).mean()

    values = [*net.tables, *net.bias, net.weights, net.offset]
    for value, slope in zip(values, langid.gradients(net, x, y)):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            value[at] += 1e-6
            up = loss()
            value[at] -= 2e-6
            down = loss()
            value[at] += 1e-6
            assert slope[at] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_language_query_on_held_out_rows(spark):
    rows = queries.op5_language_id(spark, SF).toPandas().merge(documents(spark).toPandas(), on="doc_id")
    assert len(rows) == 1000
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_language_edges(spark):
    rows = [(i, ("the cat sat " if i % 2 else "löwe für öl ") * (i + 3), "en" if i % 2 else "de") for i in range(60)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !?", "de"), (None, "the cat sat", None), (3, "für öl löwe", None),
           (103, "für öl löwe " * 60_000, None)]
    df = spark.createDataFrame(rows + odd, DOCS).withColumn("predicted", F.lit(1))
    net = langid.fit(df, F.lit(True))
    assert net.languages == ["de", "en"]
    texts = {r[0]: net.predict(r[1]) for r in odd}
    assert texts[100] == texts[101] == texts[102] == ("und", 0.0)
    assert texts[103][0] == "de" and texts[None][0] == "en" and 0 <= texts[103][1] <= 1
    kept = langid.accepted(df, net)
    assert kept.schema == df.schema and kept.count() == len(rows) + 3
    assert langid.accepted(df, net, allowed=["de"]).where("lang = 'en'").count() == 0
    empty = langid.fit(df.limit(0), F.lit(True))
    assert empty.predict("anything") == ("und", 0.0)
    assert df.limit(0).select(langid.predict(net, F.col("text"))).count() == 0


# --- language-model scores --------------------------------------------------


def brute_scores(texts, good, mu):
    docs = {i: [w.decode() for w in (t or "").encode().lower().split()] for i, t in texts.items()}
    types = len({w for d in docs.values() for w in d}) + 1

    def model(chosen, factor):
        one, before, pair = Counter(), Counter(), Counter()
        for i in chosen:
            for a, b in zip([None, *docs[i]], docs[i]):
                one[b] += factor
                before[a] += factor
                pair[a, b] += factor
        total = sum(one.values()) + types
        return lambda a, b: -math.log((pair[a, b] + mu * (one[b] + 1) / total) / (before[a] + mu))

    scale = sum(len(docs[i]) for i in good) / sum(map(len, docs.values()))
    target, background = model(good, 1), model(docs, scale)
    return {
        i: tuple(sum(m(a, b) for a, b in zip([None, *d], d)) / len(d) if d else 0.0 for m in (target, background))
        for i, d in docs.items()
    }


# One chunk; several at one level; two and three levels.
@pytest.mark.parametrize("chunk_tokens,fan", [(1 << 20, 512), (200, 512), (100, 8), (60, 3)])
def test_scores_equal_brute_force(spark, chunk_tokens, fan):
    rng = random.Random(fan)
    vocab = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(rng.choices(vocab, weights=range(1, 61), k=rng.randrange(80))) for i in range(60)}
    texts |= {100: None, 101: "", 102: "Ünder W3 W3\tw3", 103: "w1 w2 " * 700}
    good = {i for i in texts if i % 3 == 0 and i < 60}
    labels = [(i, 1 if i in good else 0, 0) for i in texts if i % 2 == 0 or i in good] + [(4, 1, 1), (None, 1, 0), (999, 1, 0)]
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    named = df.withColumns({c: F.lit("x") for c in ("id", "chunk", "good", "unit", "words")})
    rows = lmscore.score(named, marked, mu=5.0, chunk_tokens=chunk_tokens, fan=fan).collect()
    expected = brute_scores(texts, good, 5.0)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(expected[r["doc_id"]], abs=1e-9)
        assert r["score"] == pytest.approx(r["target_loss"] - r["background_loss"])
        assert r["n_tokens"] == len((texts[r["doc_id"]] or "").split())


def test_packed_numbers_come_back():
    rng = np.random.default_rng(5)
    for top in (1, 255, 256, 1 << 16, 1 << 40, (1 << 64) - 1):
        values = np.append(rng.integers(0, top, 500, dtype=np.uint64, endpoint=True), np.uint64(top))
        assert np.array_equal(lmscore.unpacked(lmscore.packed(values)), values)
        keys = np.unique(values)
        assert np.array_equal(lmscore.unpacked_keys(lmscore.packed_keys(keys)), keys)
    assert len(lmscore.unpacked(lmscore.packed(np.zeros(0, np.uint64)))) == 0


def test_scores_are_of_exact_counts(spark):
    """More distinct words than fit into 16 bits, over many chunks."""
    rng = random.Random(8)
    texts = {i: " ".join(f"w{min(int(rng.paretovariate(0.1)), 10**15)}" for _ in range(800)) for i in range(180)}
    good = {i for i in texts if i % 3 == 0}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    marked = spark.createDataFrame([(i, 1, 0) for i in good], "doc_id bigint, quality int, toxic int")
    docs = {i: t.split() for i, t in texts.items()}
    assert len({w for d in docs.values() for w in d}) > 50_000

    def model(chosen, factor):
        one, before, pair = Counter(), Counter(), Counter()
        for i in chosen:
            one.update(docs[i])
            before.update(["", *docs[i][:-1]])
            pair.update(zip(["", *docs[i]], docs[i]))
        total = sum(one.values()) * factor + len({w for d in docs.values() for w in d}) + 1
        p = lambda w: (one[w] * factor + 1) / total
        return lambda v, w: -math.log((pair[v, w] * factor + 20 * p(w)) / (before[v] * factor + 20))

    models = model(good, 1), model(docs, len(good) / len(docs))
    rows = lmscore.score(df, marked, chunk_tokens=9_000).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        d = docs[r["doc_id"]]
        expected = [sum(m(v, w) for v, w in zip(["", *d], d)) / len(d) for m in models]
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(expected, abs=1e-9)
        assert r["n_tokens"] == len(d) and min(r["target_loss"], r["background_loss"]) >= 0


def test_scores_without_a_target(spark):
    df = spark.createDataFrame([(1, "a b a"), (1, "a b a"), (None, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["score"] for r in lmscore.score(df, labels).collect()] == [0.0] * 3
    assert lmscore.score(df.limit(0), labels).count() == 0


# --- quality ------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.add(line)
    runs = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i, r in enumerate(zip(words, words[1:], words[2:])) if runs[r] > 1 for j in (i, i + 1, i + 2)}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)]


def test_counts():
    texts = [None, "", "a b c a b c", "a a a a", "x\n\nx\n \n x\nx", "é\xa0ü z #$% a|b", "p q r s p q r t q r s", "a b c", "w " * 300_000]
    for text in texts:
        counts, features = quality.statistics(text)
        assert counts == brute_counts(text)
        assert len(features) == len(quality.FEATURES) and np.isfinite(features).all()


def walk(forest, row):
    total = forest.base
    for node in forest.roots:
        for _ in range(forest.depth):
            low = row[forest.feature[node]] <= forest.threshold[node]
            node = forest.left[node] if low else forest.right[node]
        total += forest.value[node]
    return total


def test_trees_are_monotone_and_flat_scoring_is_right():
    rng = np.random.default_rng(4)
    x = rng.random((1500, 4))
    y = ((x[:, 0] < 0.5) ^ (rng.random(1500) < 0.1) ^ (np.abs(x[:, 1] - 0.5) < 0.1)).astype(float)
    forest = quality.train(x, y, [-1, 0, 1, -1], trees=30)
    assert np.allclose(forest.margin(x[:50]), [walk(forest, r) for r in x[:50]])
    free = (forest.probability(x) > 0.5) == (y > 0.5)
    assert free.mean() > 0.8
    for f, sign in ((0, -1), (2, 1), (3, -1)):
        for row in x[:40]:
            line = np.repeat(row[None], 50, axis=0)
            line[:, f] = np.linspace(-0.1, 1.1, 50)
            assert (np.diff(forest.margin(line)) * sign >= -1e-12).all()


def test_quality_query(spark):
    rows = queries.op7_quality_rules(spark, SF).toPandas()
    docs = documents(spark).toPandas()
    texts = dict(zip(docs.doc_id, docs.text))
    assert len(rows) == len(texts)
    for r in rows.itertuples():
        expected = brute_counts(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == expected
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = rows[~rows.base_failed].merge(labels, on="doc_id")
    assert both[both.quality_y == 1].kept.mean() > 0.98


def test_quality_edges(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (2, "w%d " * 60), (2, "w%d " * 60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(2, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    rows = quality.judge(df.withColumn("quality", F.lit("x")), labels).collect()
    assert sorted((str(r["doc_id"]), r["base_failed"], r["kept"]) for r in rows) == sorted(
        [("None", True, False), ("1", True, False)] + [("2", True, False)] * 2
    )
    fine = spark.createDataFrame([(2, " ".join(f"w{i}" for i in range(60)))], "doc_id bigint, text string")
    assert quality.judge(fine, labels).first()["kept"]
    assert quality.judge(df.limit(0), labels.limit(0)).count() == 0


# --- toxicity -----------------------------------------------------------------


def sentences():
    """Insults occur near one group's name, neutral mentions are few."""
    rng = random.Random(8)
    filler = [f"f{i}" for i in range(30)]
    rows = []
    for i in range(400):
        words = rng.sample(filler, 6)
        toxic = i % 3 == 0
        if toxic:
            words += ["idiot"] if i % 2 else ["moron"]
        if rng.random() < (0.8 if toxic else 0.05):
            words.append("muslim")
        rows.append((set(words), float(toxic)))
    return [r[0] for r in rows], np.array([r[1] for r in rows])


def test_identity_terms_lose_their_weight():
    rows, labels = sentences()
    words = sorted(set.union(*rows) | {t for f in toxicity.FAMILIES for t in f})
    plain, fair = (toxicity.train(rows, labels, words, f) for f in (0.0, toxicity.FAIRNESS))
    neutral = "f1 f2 muslim"
    gap = [abs(m.scorer()("f1 f2 muslim") - m.scorer()("f1 f2 christian")) for m in (plain, fair)]
    assert gap[1] < 0.3 * gap[0]
    assert fair.scorer()(neutral) < 0.5 and fair.scorer()("f1 idiot") > 0.5
    assert fair.scorer()("f1 f2") < 0.5


def test_swaps():
    got = toxicity.swaps({"a", "gay", "woman"}, (("person", "woman", "man"), ("someone", "gay")))
    assert {frozenset(s) for s in got} == {
        frozenset(s) for s in ({"a", "gay", "person"}, {"a", "gay", "man"}, {"a", "woman", "someone"})
    }
    assert toxicity.swaps({"a"}) == []


def test_toxicity_query_on_held_out_rows(spark):
    rows = queries.op9_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert ((held.predicted == held.toxic).mean()) > 0.95


def test_toxicity_edges(spark):
    df = spark.createDataFrame([(1, "idiot you"), (2, "fine words"), (3, None), (None, ""), (2, "fine words")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (2, None)], "doc_id bigint, toxic int")
    for marked, low, high in ((labels, 0, 1), (labels.where("toxic = 0"), 0, 0.01), (labels.where("doc_id = 1"), 0.99, 1), (labels.limit(0), 0, 0.01)):
        model = toxicity.fit(df, toxicity.labelled_ids(marked))
        scores = [r[0] for r in df.select(toxicity.score(model, F.col("text"))).collect()]
        assert len(scores) == 5 and all(low <= s <= high for s in scores)
    assert df.limit(0).select(toxicity.score(model, F.col("text"))).count() == 0
    long = "word " * 400_000 + "idiot"
    assert toxicity.Known(["idiot", "absent", "idio*", "wor*"]).present(long) == {"idiot", "idio*"}


def test_sample_is_kept_as_texts(spark, monkeypatch):
    """Arrays of features filled the executors' heap; the model is that of a plain count."""
    rng = random.Random(3)
    rows = [(i // 2 if i < 20 else i, " ".join(rng.choices(["fool", "Fools", "kind", "a_b", "über"] + [f"w{k}" for k in range(40)], k=12)), i % 3) for i in range(300)]
    rows += [(900, None, 0), (901, "", 1)]
    df = spark.createDataFrame([(i, t if k or t is None else t + " rotten") for i, t, k in rows], "doc_id bigint, text string")
    marks = {i: int(k == 0) for i, _, k in rows}
    kept = []
    monkeypatch.setattr(toxicity, "stored", lambda frame, name, f=toxicity.stored: kept.append(frame) or f(frame, name))
    model = toxicity.fit(df, toxicity.labelled_ids(spark.createDataFrame([*marks.items()], "doc_id bigint, toxic int")))
    assert [f.dtypes for f in kept] == [[("id", "bigint"), ("label", "int"), ("text", "string")]]
    sample = sorted((r[0], marks[r[0]], sorted(toxicity.features(r[1]))) for r in df.collect() if r[1] is not None)
    share = sum(r[1] for r in sample) / len(sample)
    chosen = {t for family in toxicity.FAMILIES for t in family}
    for word in set().union(*(r[2] for r in sample)):
        has = [r[1] for r in sample if word in r[2]]
        far = abs(sum(has) - len(has) * share) / math.sqrt(len(has) * (share * (1 - share)) + 1)
        chosen |= {word} if len(has) >= toxicity.LEAST_DOCS and far >= toxicity.SIGMAS else set()
    words = sorted(chosen)
    plain = toxicity.train([set(r[2]) & chosen for r in sample], np.array([float(r[1]) for r in sample]), words)
    assert "rotten" in words and model.words == words
    assert np.allclose(model.weights, plain.weights) and np.isclose(model.base, plain.base)


def test_feature_counts_in_parts():
    texts = ["ab cd", "ab", "", "ab ef cd"] * 3
    batch = pa.RecordBatch.from_pydict({"label": [1, 0, 1, 0] * 3, "text": texts})
    for limit in (1, 2, 100):
        got = {}
        for part in toxicity.counted(iter([batch, batch]), limit):
            for word, n, bad in zip(*(c.to_pylist() for c in part.columns)):
                got[word] = [a + b for a, b in zip(got.get(word, [0, 0]), (n, bad))]
        assert got == {"ab": [18, 6], "cd": [12, 6], "ef": [6, 0]}


def test_known_features_are_those_of_the_text():
    texts = ["Idiots and idiot, idi", "", None, "Äußerst schöne-Wörter_1", "a b abcd abcdefgh"]
    every = sorted(set().union(*map(toxicity.features, texts)))
    for text in texts:
        assert toxicity.Known(every).present(text) == toxicity.features(text)


def test_number_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "the and of to in that", "en") for i in range(6)] + [(10 + i, "der die und das ist", "de") for i in range(6)], "doc_id bigint, text string, lang string")
    net = langid.fit(docs, F.lit(True))
    for text in ("½ ² ①", "12 _ ٣", "Ⅷ½"):
        assert net.predict(text)[0] == langid.UNKNOWN, text
    assert net.predict("½ der")[0] == "de" or net.predict("½ der")[0] == "en"


def test_columns_named_like_the_operators_own(spark):
    """``id``, ``domain``, ``label`` and others may be columns of the input."""
    rows = [(i, f"word{i % 3} some text here {'bad' if i % 4 == 0 else 'good'}") for i in range(40)]
    names = ["id", "domain", "label", "words", "features", "row", "fp", "_id", "_text", "tokens"]
    docs = spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    labelled = mixing.labelled_ids(labels, mixing.label_domain())
    assert mixing.rates(docs, labelled, mixing.DOMAINS, [0.8, 0.2, 0.0]).count() == 40
    kept = mixing.resample(docs, labelled, mixing.DOMAINS, [1.0, 0.5, 0.5])
    assert kept.columns == docs.columns and 0 < kept.count() <= 40
    toxic = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(30)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, toxicity.labelled_ids(toxic))
    assert docs.select(toxicity.score(model, F.col("text"))).count() == 40
