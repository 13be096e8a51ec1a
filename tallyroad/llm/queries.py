"""Queries over the operators, with production settings and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyroad.llm import (
    hamming,
    langid,
    lmscore,
    merkle,
    mixing,
    packing,
    pii,
    prefixtrie,
    quality,
    secrets,
    sharding,
    simhash,
    sql,
    toxicity,
)
from tallyroad.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# Shares of all tokens.
MIX = {"clean": 0.92, "low": 0.05, "toxic": 0.03}


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[number(kind) for kind in secrets.BASE_KINDS],
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        number("entropy"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.assign(table(spark, sf_dir, "documents"), shards=24)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.labelled_ids(table(spark, sf_dir, "labels"), mixing.label_domain())
    targets = [MIX[d] for d in mixing.DOMAINS]
    return mixing.rates(table(spark, sf_dir, "documents"), labelled, mixing.DOMAINS, targets)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs, language_rows())
    found = docs.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        langid.predict(net, F.col("text")).alias("found"),
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def language_rows() -> Column:
    """Rows a language may be learnt from."""
    return remainder("doc_id", 3) != 1


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every 20th vector."""
    coded = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code")
    )
    return hamming.nearest(coded, coded.where(F.col("id") % 20 == 0), k=10)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.fit(docs, toxicity.labelled_ids(learn))
    found = docs.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        toxicity.score(model, F.col("text")).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", simhash.hex_text(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 2 divides the id's checksum, one checked
    against a text without its line ends."""
    cut = F.when((remainder("doc_id", 2) == 0) & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit("")))
    found = merkle.manifest(table(spark, sf_dir, "documents"), other_text=cut)
    folded = merkle.fold(F.coalesce("other_leaf", "leaf"), F.col("proof"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[pii.number_of(kind) for kind in pii.BASE_KINDS],
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        *[pii.number_of(kind) for kind in pii.ADDED_KINDS],
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.branched_trie(table(spark, sf_dir, "conversations"))


def all_queries() -> dict[str, Query]:
    found = [
        op1_secret_scans,
        op2_sharding,
        op3_packing,
        op4_mixing,
        op5_language_id,
        op6_lm_scoring,
        op7_quality_rules,
        op8_hamming_search,
        op9_toxicity,
        op10_simhash,
        op11_merkle_manifest,
        op12_pii,
        op13_prefix_trie,
    ]
    return {q.__name__: q for q in found}


OP8_SQL = """
WITH bits AS (
    SELECT vec_id, CAST(i AS INTEGER) AS i, CASE WHEN embedding[i + 1] > 0 THEN 1 ELSE 0 END AS b
    FROM embeddings, range(64) AS t(i)
    WHERE embedding IS NOT NULL
), codes AS (
    SELECT vec_id,
           CAST(sum(CASE WHEN i < 32 THEN b * power(2, i) ELSE 0 END) AS BIGINT) AS low,
           CAST(sum(CASE WHEN i >= 32 THEN b * power(2, i - 32) ELSE 0 END) AS BIGINT) AS high
    FROM bits GROUP BY vec_id
), ranked AS (
    SELECT q.vec_id AS query_id, r.vec_id AS id,
           CAST(bit_count(xor(q.low, r.low)) + bit_count(xor(q.high, r.high)) AS INTEGER) AS distance
    FROM codes q, codes r WHERE q.vec_id % 20 = 0
)
SELECT * FROM (
    SELECT query_id, id, distance,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank
    FROM ranked
) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    # The other operators give positions, hashes of shingles, tokens, schedules
    # or scores of trained models, which SQL can't express: see tests/llm.
    return {
        "op8_hamming_search": OP8_SQL,
        "op11_merkle_manifest": sql.OP11_MERKLE,
        "op13_prefix_trie": sql.OP13_TRIE,
    }
