"""SimHash components, graph components and Hamming search against brute force."""

import random

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyroad.llm import graph, hamming, queries, simhash
from tallyroad.llm.common import word_blocks
from tallyroad.session import scratch_dir

SF = "/root/testdata/sf0.01"


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_fingerprint(text, k):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").replace("\f", " ")
             .replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


TEXTS = ["", None, " \n", "one", "One", "two words", "a b c", "A B C d", "x y z", "É é", "the same text here " * 30, "q " * 50]


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_fingerprints(k):
    for text in TEXTS:
        assert simhash.text_fingerprint(text, k) == brute_fingerprint(text, k)


def test_fingerprint_of_a_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(4000))
    expected = brute_fingerprint(text, 3)
    for size in (1, 7, 100, 10_000):
        blocks = list(word_blocks(text.encode(), size))
        assert sum(blocks, []) == text.encode().split()
        monkeypatch.setattr(simhash, "word_blocks", lambda data, blocks=blocks: iter(blocks))
        assert simhash.text_fingerprint(text, 3) == expected


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((1, 0), (60, 40), (80, 200), (50, 49)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        if (n, m) == (50, 49):
            pairs = [(i, i + 1) for i in range(49)]  # a long path
        df = spark.createDataFrame(pairs, "a bigint, b bigint")
        got = {r["node"]: r["component"] for r in graph.components(df, "a", "b").collect()}
        nodes = {x for p in pairs if p[0] != p[1] for x in p}
        assert got == brute_components(nodes, [p for p in pairs if p[0] != p[1]])


def test_links_cover_every_pair_within_the_radius(spark):
    rng = random.Random(1)
    values = {rng.getrandbits(64) for _ in range(30)}
    for v in list(values):
        near = v
        for _ in range(4):
            near ^= 1 << rng.randrange(64)
            values.add(near)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(s,) for s in signed * 3], "fp bigint")
    got = {r["fp"]: r["root"] for r in simhash.roots(df).collect()}
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    expected = brute_components({x for p in pairs for x in p}, pairs)
    assert got == expected
    for r in simhash.links(df).collect():
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 2


def test_simhash_query(spark):
    rows = queries.op10_simhash(spark, SF).collect()
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    assert len(rows) == len(texts)
    prints = {i: simhash.text_fingerprint(t, 3) for i, t in texts.items()}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], dtype=np.uint64)
    pairs = [(ids[i], ids[j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2)]
    expected = brute_components(ids, pairs)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == expected[r["doc_id"]]


def test_simhash_edges(spark):
    rows = [(3, None, 1), (7, "", 1), (None, "", 2), (5, "same text of words", 3), (5, "same text of words", 3), (4, "same text of words", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp bigint")
    got = sorted(map(str, ((r["doc_id"], r["component_id"]) for r in simhash.components(df).collect())))
    assert got == sorted(map(str, [(3, 3), (7, 3), (None, 3), (5, 4), (5, 4), (4, 4)]))
    kept = simhash.keep_one(df)
    assert kept.schema == df.schema
    assert sorted(map(tuple, kept.collect())) == [(3, None, 1), (4, "same text of words", 3)]
    # Rows that are equal in all columns leave one.
    assert simhash.keep_one(df.where("doc_id = 5")).count() == 1
    assert simhash.components(df.limit(0)).count() == simhash.keep_one(df.limit(0)).count() == 0


def codes_of(spark, values):
    return spark.createDataFrame(
        [(i, [v >> 16 * s & 0xFFFF for s in range(4)] if v is not None else None) for i, v in values], "id bigint, code array<int>"
    )


@pytest.mark.parametrize("n,k", [(400, 10), (6, 10), (300, 1)])
def test_search_equals_brute_force(spark, n, k):
    rng = random.Random(n)
    near = rng.getrandbits(64)
    values = [(i, near ^ (1 << rng.randrange(64)) if i % 3 == 0 else rng.getrandbits(64)) for i in range(n)]
    values += [(n + i, near) for i in range(20 if n > 10 else 0)] + [(9999, None)]
    asked = [v for v in values if v[0] % 20 == 0]
    got = {}
    for r in hamming.nearest(codes_of(spark, values), codes_of(spark, asked), k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["distance"], r["id"]))
    for i, q in asked:
        best = sorted((bin(q ^ v).count("1"), j) for j, v in values if v is not None)[:k]
        assert sorted(got[i]) == [(rank + 1, d, j) for rank, (d, j) in enumerate(best)]


def test_a_large_group_of_near_copies_leaves_one(spark):
    """Texts that differ in a word each, and one text many times over."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts = []
    for n, copies in ((900, 150), (900, 1), (40, 60)):
        source = [word() for _ in range(n)]
        for _ in range(copies):
            copy = list(source)
            copy[rng.randrange(n)] = word()
            texts.append(" ".join(copy))
    texts += ["the same words again and again"] * 300
    prints = [simhash.text_fingerprint(t, 3) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    expected = set(brute_components(range(len(texts)), near).values())
    order = list(range(len(texts)))
    rng.shuffle(order)
    df = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id bigint, text string")
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == expected
    assert 3 < len(expected) < 130


def test_rounds_split_a_hot_node(spark):
    """The join of a round reads plain tables, so a skewed side can be split."""
    edges = spark.createDataFrame([(i, 0) for i in range(1, 50)], "u bigint, v bigint")
    path = scratch_dir(spark, "down")
    edges.groupBy("u").agg(F.min("v").alias("least")).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph.large_star(edges, spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("Join") :]
    assert "Aggregate" not in below and "Aggregate" in plan


def test_search_of_nothing(spark):
    empty = codes_of(spark, [])
    assert hamming.nearest(empty, empty).count() == 0


def test_sign_codes(spark):
    vectors = [[1.0, -1.0, 0.0, 2.0], None, [], [-1.0] * 16 + [5.0], [1.0] * 70]
    df = spark.createDataFrame([(v,) for v in vectors], "v array<float>").select(hamming.sign_code(F.col("v")).alias("c"))
    assert [r["c"] for r in df.collect()] == [[9, 0, 0, 0], None, [0] * 4, [0, 1, 0, 0], [65535] * 4]


def test_hamming_query_equals_sql(spark):
    got = sorted(map(tuple, queries.op8_hamming_search(spark, SF).select("query_id", "id", "distance", "rank").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = con.execute(f"SELECT query_id, id, distance, rank FROM ({queries.OP8_SQL})").fetchall()
    assert got == sorted(expected) and len(got) > 0
