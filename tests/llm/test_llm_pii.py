"""Personal data: base patterns against plain ones, votes and classifier
against brute force, planted texts."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from tallyroad.llm import pii, queries

SF = "/root/testdata/sf0.001"


def plain_spans(text):
    """The base rules as they are stated, with backtracking patterns."""
    text = text or ""
    found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, m.start(), m.end()))
    return found


CASES = [
    "", None, "@", "a@b", "a@b.c", "a@b.c@d.e f@@g.h x@y..z a@-.-b.", "é😀ann.o+n%e-_@Mail-1.example.com.", "a@b.c.d@e.f.g",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.01.1 1.2.3 1..2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111x 4111111111111112",
    "4111  1111", "0" * 19, "0" * 20, "+1 (555) 555-0123. +49", "+1((((2 +12345678 +1234567890123456 +1 2 3 4 5 6 7 8 9 ",
    "x+14155550123@mail.example.org", "٣٣٣.٣.٣.٣",
]


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(4)
    fuzz = ["".join(rng.choice("01259.@+-() \nab_%é") for _ in range(rng.randrange(60))) for _ in range(3000)]
    fuzz += ["".join(rng.choice("0123456789  -") for _ in range(400)) for _ in range(50)]
    for text in CASES + fuzz:
        assert pii.base_spans(text or "") == plain_spans(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "1 ", "+1(", "a@", "@", "A-", "A ", "Mr A", "-", "(1", "a at ", "a.b@c"])
def test_long_runs_take_time_in_proportion(unit):
    model = pii.Model({}, np.zeros(pii.DIMENSIONS), 0.9)
    begun = time.process_time()
    pii.scan(unit * (400_000 // len(unit)), model)
    assert time.process_time() - begun < 12


def test_estimate_finds_reliabilities_of_made_up_labelers():
    rng = np.random.default_rng(0)
    n, rates = 40_000, [0.95, 0.8, 0.7, 0.9]
    truth = rng.random(n) < 0.3
    votes = np.full((n, 4), "0")
    for j, rate in enumerate(rates):
        right = rng.random(n) < rate
        votes[:, j] = np.where(rng.random(n) < 0.8, np.where(truth == right, "+", "-"), "0")
    patterns = ["".join(v) for v in votes]
    counts = {p: patterns.count(p) for p in set(patterns)}
    found = pii.estimate(counts)
    assert abs(found.prior - 0.3) < 0.02
    for j, rate in enumerate(rates):
        assert abs(found.reliability[j, 1, 2] / found.reliability[j, 1, [0, 2]].sum() - rate) < 0.04
    right = np.mean([(found.likely[p] > 0.5) == t for p, t in zip(patterns, truth)])
    best = np.mean([vote_of(p, rates, 0.3) == t for p, t in zip(patterns, truth)])
    assert right > best - 0.005


def vote_of(pattern, rates, prior):
    odds = prior / (1 - prior)
    for v, r in zip(pattern, rates):
        odds *= {"+": r / (1 - r), "-": (1 - r) / r, "0": 1}[v]
    return odds > 1


def test_a_round_equals_plain_loops():
    rng = random.Random(1)
    counts = {"".join(p): rng.randrange(1, 50) for p in itertools.product("-0+", repeat=3)}
    found = pii.estimate(counts, rounds=2)
    table = [[[0.3, 0.6, 0.1], [0.1, 0.6, 0.3]] for _ in range(3)]
    prior = 0.5
    for last in (False, True):
        likely = {}
        for p in counts:
            a, b = 1 - prior, prior
            for j, v in enumerate(p):
                a, b = a * table[j][0]["-0+".index(v)], b * table[j][1]["-0+".index(v)]
            likely[p] = b / (a + b)
        total = sum(counts.values())
        prior = (sum(counts[p] * likely[p] for p in counts) + 1) / (total + 2)
        for j in range(3):
            for c in (0, 1):
                mass = [1 + sum(counts[p] * (likely[p] if c else 1 - likely[p]) for p in counts if p[j] == v) for v in "-0+"]
                table[j][c] = [m / sum(mass) for m in mass]
            raw = [list(row) for row in table[j]]
            for v, side in ((2, 1), (0, 0)):
                if table[j][side][v] < table[j][1 - side][v]:
                    mean = (table[j][0][v] + table[j][1][v]) / 2
                    for row in table[j]:
                        left = 1 - row[v]
                        row[:] = [mean if k == v else x * (1 - mean) / left for k, x in enumerate(row)]
            if table[j][1][2] < table[j][0][2] - 1e-12 or table[j][0][0] < table[j][1][0] - 1e-12:
                table[j] = [[(x + y) / 2 for x, y in zip(*raw)] for _ in range(2)]
    assert abs(found.prior - prior) < 1e-12
    assert np.allclose(found.reliability, table, atol=1e-12)
    assert all(abs(found.likely[p] - likely[p]) < 1e-12 for p in counts)


def test_a_vote_never_counts_against_its_own_class():
    rng = random.Random(9)
    for _ in range(20):
        counts = {"".join(rng.choice("-0+") for _ in range(7)): rng.randrange(1, 1000) for _ in range(12)}
        table = pii.estimate(counts).reliability
        assert (table[:, 1, 2] >= table[:, 0, 2] - 1e-9).all() and (table[:, 0, 0] >= table[:, 1, 0] - 1e-9).all()
        assert np.allclose(table.sum(2), 1)


def test_the_gradient_equals_differences():
    rng = np.random.default_rng(5)
    rows = [pii.slots([f"f{rng.integers(6)}", f"g{rng.integers(6)}"]) for _ in range(30)]
    targets = rng.random(30)
    weights = rng.normal(size=pii.DIMENSIONS)
    of_row = np.repeat(np.arange(30), 3)
    slot = np.concatenate(rows)

    def loss(w):
        z = np.bincount(of_row, w[slot], 30)
        return np.mean(np.logaddexp(0, z) - targets * z) + 0.5e-3 * w @ w

    found = pii.loss_gradient(1 / (1 + np.exp(-np.bincount(of_row, weights[slot], 30))), targets, of_row, slot, weights, 1e-3)
    for k in set(slot.tolist()):
        step = np.zeros(pii.DIMENSIONS)
        step[k] = 1e-5
        assert abs((loss(weights + step) - loss(weights - step)) / 2e-5 - found[k]) < 1e-6


def planted(rng, i):
    """A text, and what in it is personal beyond the base patterns."""
    words = " ".join(rng.choice("ba no mi ru ta el os und chen".split()) for _ in range(12))
    number = f"{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    plain = "".join(rng.choice("0123456789") for _ in range(16))
    host = rng.choice(["gmail", "gmx", "yahoo"])
    return [
        (f"{words} call phone {number} {words}", number),
        (f"{words} order invoice {plain} {words}", None),
        (f"{words} email ann{i} at {host} dot com {words}", f"ann{i} at {host} dot com"),
        (f"{words} my name is Anna Meierova, {words}", "Anna Meierova"),
        (f"{words} The Meierova {words} released on 2020-01-1{i % 9} {words}", None),
        (f"{words} mail ann{i}@mail.example.com {words}", None),
    ][i % 6]


def test_planted_spans_are_found_and_others_are_not(spark):
    rng = random.Random(11)
    cases = [planted(rng, i) for i in range(600)]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, (t, _) in enumerate(cases)], "doc_id bigint, text string, kind int, votes string")
    model = pii.fit(docs.where("doc_id < 400"), sample=1000)
    assert model.labels.keys() == {"contact", "number", "name"}
    right = wrong = 0
    for r in pii.find(docs, model).collect():
        text, expected = cases[r["doc_id"]]
        extra = [text[s["start"] : s["end"]] for s in r["spans"] if s["kind"] in pii.ADDED_KINDS]
        base = [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE_KINDS]
        assert base == plain_spans(text)
        if r["doc_id"] >= 400:
            right += extra == ([expected] if expected else [])
            wrong += extra != ([expected] if expected else [])
    assert right / (right + wrong) > 0.95


def test_nulls_repeats_empty_tables_and_the_threshold(spark):
    rows = [(1, None), (None, "a@b.c"), (1, ""), (2, "call 555-123-4567"), (2, "call 555-123-4567"), (3, "x" * 3_000_000 + " a@b.c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = pii.fit(docs)
    got = sorted((str(r["doc_id"]), len(r["spans"])) for r in pii.find(docs, model).collect())
    extra = len(pii.scan("call 555-123-4567", model))
    assert got == [("1", 0), ("1", 0), ("2", extra), ("2", extra), ("3", 1), ("None", 1)]
    none = docs.limit(0)
    assert pii.find(none, pii.fit(none)).collect() == [] and pii.fit(none).labels == {}
    # A score equal to the threshold is enough.
    level = pii.Model({}, np.zeros(pii.DIMENSIONS), 0.5)
    assert pii.scan("call 555-123-4567", level) == [(5, 5, 17)]
    assert pii.scan("call 555-123-4567", pii.Model({}, np.zeros(pii.DIMENSIONS), 0.5001)) == []


def test_query_equals_a_plain_scan(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = queries.op12_pii(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        base = plain_spans(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == i for s in base) for i in range(4)]
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        everything = pii.scan(docs[r["doc_id"]], model)
        assert set(base) <= set(everything)
        assert r["spans"] == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in everything)
