"""The Merkle manifest against trees built on the driver, and its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyroad.llm import merkle, places, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    paths, nodes, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = nodes[i - i % 3 : i - i % 3 + 3]
            path.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((r[0], leaf(*r)))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([x[1] for x in by[s]]) for s in sources]
    root, upper = tree([t[0] for t in trees])
    return in_order(
        (d, x, sub, root, path + up)
        for s, (sub, paths), up in zip(sources, trees, upper)
        for (d, x), path in zip(by[s], paths)
    )


def in_order(rows):
    return sorted(rows, key=lambda r: (str(r[0]), *r[1:]))


def collected(df):
    return in_order((r[0], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["proof"]]) for r in df.collect())


@pytest.mark.parametrize("height", [0, 1, 2, 7])
def test_proofs_equal_brute_force(spark, height):
    rng = random.Random(height)
    rows = []
    for s, n in (("hot", 100), ("é", 28), ("b", 27), ("z", 10), ("a", 9), ("one", 1), (None, 4)):
        rows += [(rng.randrange(-50, 10**9), f"t{i}\n{rng.random()}", "en", s, i) for i in range(n)]
    rng.shuffle(rows)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), height=height)
    assert collected(got) == brute(rows)


def test_nulls_repeats_long_texts_and_further_columns(spark):
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (1, "x", None, "", 3), (-4, None, "de", "s", None)]
    rows += [(7, "word " * 400_000, "en", "s", 2_000_000)] * 2
    docs = spark.createDataFrame([(*r, "t", 1, "n") for r in rows], SCHEMA + ", tree string, block int, digest string")
    assert collected(merkle.manifest(docs, height=1)) == brute(rows)
    assert merkle.manifest(docs.limit(0)).collect() == []


def test_a_changed_text_does_not_verify(spark):
    rows = [(i, f"a\nb{i}" if i % 3 else f"ab{i}", "en", f"s{i % 4}", 3) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs, other_text=F.replace("text", F.lit("\n"), F.lit("")), height=1)
    folded = merkle.fold(F.coalesce("other_leaf", "leaf"), F.col("proof"))
    for r in found.withColumn("ok", folded == F.col("root")).collect():
        assert r["ok"] == (r["doc_id"] % 3 == 0)


def test_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = duck.execute(queries.oracle_sql()["op11_merkle_manifest"])
    names = [c[0] for c in result.description]
    got = queries.op11_merkle_manifest(spark, SF)
    assert got.columns == names
    assert sorted(tuple(r) for r in got.collect()) == sorted(result.fetchall())
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0) >= (not r["verified"]) for r in got.collect())


def test_positions_have_no_gaps_also_where_all_is_equal(spark):
    scratch = places.Scratch(spark)
    rows = [("a", 5)] * 300 + [("b", i % 7) for i in range(100)] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = places.place(df, ["g"], ["v"], scratch).collect()
    for g, n in (("a", 300), ("b", 100), ("c", 1)):
        mine = sorted((r["place"], r["v"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(n)) and {r["total"] for r in got if r["g"] == g} == {n}
        assert [v for _, v in mine] == sorted((v for _, v in mine), key=lambda v: (v is not None, v))
