"""The corpus pipeline, stage by stage, and how the queries are registered."""

import re

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tallyroad.llm import langid, mixing, packing, queries, secrets, simhash

SF = "/root/testdata/sf0.001"
EXTRA = [
    (9_000_001, None, "en", "s", 0, "x"),
    (9_000_002, "12345 67890", "en", "s", 11, "x"),
    (9_000_003, "the words in that and this for with, copied twice over. " * 9 + "token=abcdefghijkl1234", None, None, None, None),
    (9_000_003, "the words in that and this for with, copied twice over. " * 9 + "token=abcdefghijkl1234", None, None, None, None),
    (None, "the words in that and this for with, copied twice over. " * 9 + "token=abcdefghijkl1234", "en", "s", 5, "y"),
]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(EXTRA, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string")
    docs = docs.withColumn("fp", F.lit("clash")).union(extra)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "secret_scans", "mix_sources", "pack"]
    stage = dict(corpus_pipeline.STAGES)

    known = stage["language_id"](spark, docs, SF).cache()
    assert known.schema == docs.schema
    net = langid.fit(docs, queries.language_rows())
    expected = sorted(str(r["doc_id"]) for r in docs.collect() if net.predict(r["text"])[1] >= 0.4)
    assert sorted(str(r["doc_id"]) for r in known.collect()) == expected
    assert not {"9000001", "9000002"} & set(expected)

    single = stage["near_dedup"](spark, known, SF).cache()
    assert single.schema == docs.schema
    rows = known.collect()
    prints = [simhash.text_fingerprint(r["text"], 3) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    first = {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        first[find(i)] = min(first.get(find(i), key), key)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in single.collect()) == sorted(first.values())

    masked = stage["secret_scans"](spark, single, SF).cache()
    assert masked.count() == single.count() and masked.schema == docs.schema
    for r in masked.collect():
        assert not [s for s in secrets.scan(r["text"]) if s[1] != 3]

    mixed = stage["mix_sources"](spark, masked, SF).cache()
    assert mixed.schema == docs.schema and 0 < mixed.count() < masked.count()
    assert mixed.exceptAll(masked).count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0")
    clean = masked.join(labels, "doc_id", "left_semi").count()
    assert mixed.join(labels, "doc_id", "left_semi").count() == clean

    pieces = stage["pack"](spark, mixed, SF).collect()
    encoder = packing.Encoder(queries.vocabulary())
    total = sum(len(encoder.ids(r["text"])) + 1 for r in mixed.collect())
    assert sum(r["length"] for r in pieces) == total
    for df in (known, single, masked, mixed):
        df.unpersist()


def test_mix_sources_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = corpus_pipeline.mix_sources(spark, docs, sf).select("doc_id").cache()
    clean = docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id", "left_semi").select("doc_id")
    found = mixing.labelled_ids(labels, mixing.label_domain())
    rows = mixing.rates(docs, found, mixing.DOMAINS, [queries.MIX[d] for d in mixing.DOMAINS])
    likely = rows.where("p_clean >= greatest(p_low, p_toxic)").select("doc_id")
    assert likely.exceptAll(kept).count() == 0
    assert clean.exceptAll(kept).count() == 0
    for bad, most in (("quality = 0", 0.6), ("quality = 1 AND toxic = 1", 0.5)):
        these = docs.join(labels.where(bad), "doc_id", "left_semi").select("doc_id")
        assert these.join(kept, "doc_id", "left_semi").count() <= most * these.count()
    kept.unpersist()


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name


def test_run_is_repeatable(spark):
    one, two = (
        sorted((r["doc_id"], r["start"], r["length"]) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2)
    )
    assert [x[0] for x in one] == [x[0] for x in two] and len(one) > 0
    tokens = [np.sum([x[2] for x in run]) for run in (one, two)]
    assert tokens[0] == tokens[1]


def test_registered():
    numbers = sorted(int(m[1]) for m in map(re.compile(r"op(\d+)_").match, entry_point.queries()) if m)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry_point.queries()
    assert "op8_hamming_search" in entry_point.oracle_sql()
