"""Merkle manifest of a table by a butterfly exchange.

Each row is a leaf, each source a tree over its leaves by id, and the sources'
roots are the leaves of one tree on top. Nodes of a level are hashed in runs of
``FANOUT``; a last run may have fewer, even one.

Leaves of a tree are cut into aligned blocks of ``FANOUT ** HEIGHT``. A block is
one subtree, built by one task. Then blocks exchange: in round r, those aligned
groups of blocks that share an ancestor r + 1 levels up swap the roots of their
subtrees, each block with the partners at its own offset, and every block hashes
the common ancestor itself. After the last round each block has all upper
siblings of its leaves; nothing is handed down. A round moves one narrow row per
block and partner, so the rounds (logarithm of the number of blocks) cost little.

Rules: nulls are leaves like others (see ``leaf``), a null source is a tree of
its own and comes first, a null id comes first in its tree. Rows equal in source
and id are ordered by their leaf. An empty table has no rows. Text length does
not matter: texts are hashed whole, in the scan, and not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.places import Scratch, place

FANOUT = 3
# A block of 2,187 leaves is small enough to deal a hot source evenly.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "struct<before:string,after:string>"
ITEM = "struct<id:bigint,name:string,digest:string,other:string>"
BLOCK = f"tree string, block bigint, blocks bigint, items array<{ITEM}>, node string"
PROOF = f"tree string, id bigint, name string, digest string, other string, proof array<{STEP}>, node string"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """A null is ``-``, other values are their UTF-8 length, a colon and the
    value; all joined."""
    parts = []
    for value in fields:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def tree_key(source: Column) -> Column:
    """A name without nulls that sorts as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def hashed(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels(leaves: list[str], least: int) -> Iterator[list[str]]:
    """All levels from the leaves up to a single node, at least ``least``
    above the leaves."""
    nodes, height = leaves, 0
    yield nodes
    while len(nodes) > 1 or height < least:
        nodes = [hashed(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        height += 1
        yield nodes


def siblings(all_levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands before and after a leaf's ancestor in its run, per level."""
    out = []
    for nodes in all_levels[:-1]:
        start = at - at % FANOUT
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FANOUT])))
        at //= FANOUT
    return out


def blocks_of(leaves: DataFrame, order: list[str], height: int, scratch: Scratch) -> DataFrame:
    """One row per block of ``leaves`` (``tree`` and the fields of an item):
    its items in order and the root of its subtree."""
    size = FANOUT**height

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "block", "blocks", "items", "node"]
        item = pa.struct([("id", pa.int64()), ("name", pa.string()), ("digest", pa.string()), ("other", pa.string())])

        def finished(key, items):
            tree, block, blocks = key
            *_, top = levels([i["digest"] for i in items], height if blocks > 1 else 0)
            return pa.RecordBatch.from_arrays(
                [pa.array([tree]), pa.array([block]), pa.array([blocks]), pa.array([items], pa.list_(item)), pa.array(top)],
                names=names,
            )

        key, items = None, []
        for batch in batches:
            columns = batch.to_pydict()
            rows = zip(columns["tree"], columns["block"], columns["blocks"], columns["item"])
            for tree, block, blocks, one in rows:
                if key != (tree, block, blocks):
                    if items:
                        yield finished(key, items)
                    key, items = (tree, block, blocks), []
                items.append(one)
        if items:
            yield finished(key, items)

    placed = place(leaves, ["tree"], order, scratch).select(
        "tree",
        F.floor(F.col("place") / size).alias("block"),
        F.ceil(F.col("total") / size).alias("blocks"),
        "place",
        F.struct("id", "name", "digest", "other").alias("item"),
    )
    dealt = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    return scratch.keep(dealt.drop("place").mapInArrow(build, BLOCK), "blocks")


def exchange(state: DataFrame, span: int) -> DataFrame:
    """A round among blocks (``tree, block, blocks, node, path``) whose node is
    the root of ``span`` blocks. A tree that has one such node is finished."""
    span_col, group = F.lit(span), FANOUT * span
    first = F.floor(F.col("block") / span) * span
    run = F.floor(F.col("block") / group) * group
    size = F.least(span_col, F.col("blocks") - first)
    offset = F.col("block") - first
    open_tree = F.col("blocks") > span

    def partners(j: int) -> Column:
        # Blocks of the run's j-th subtree at this block's offset. A last
        # subtree with fewer blocks serves several offsets.
        start = run + j * span
        end = F.least(start + span, F.col("blocks")) - 1
        return F.when(start + offset <= end, F.sequence(start + offset, end, size)).otherwise(F.array().cast("array<bigint>"))

    to = F.when(open_tree, F.concat(*[partners(j) for j in range(FANOUT)])).otherwise(F.array("block"))
    place_in_run = ((first - run) / span).cast("int")
    sent = state.select("tree", "block", "blocks", "node", "path", place_in_run.alias("j"), F.explode(to).alias("to"))
    own = F.col("to") == F.col("block")
    got = sent.groupBy("tree", F.col("to").alias("block")).agg(
        F.max("blocks").alias("blocks"),
        F.max(F.when(own, F.col("path"))).alias("path"),
        F.max(F.when(own, F.col("j"))).alias("j"),
        F.max(F.when(own, F.col("node"))).alias("own"),
        *[F.coalesce(F.max(F.when(F.col("j") == j, F.col("node"))), F.lit("")).alias(f"n{j}") for j in range(FANOUT)],
    )

    def joined(keep) -> Column:
        return F.concat(*[F.when(keep(j), F.col(f"n{j}")).otherwise("") for j in range(FANOUT)])

    step = F.struct(joined(lambda j: F.col("j") > j).alias("before"), joined(lambda j: F.col("j") < j).alias("after"))
    return got.select(
        "tree",
        "block",
        "blocks",
        F.when(open_tree, digest(F.concat(*[f"n{j}" for j in range(FANOUT)]))).otherwise(F.col("own")).alias("node"),
        F.when(open_tree, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
    )


def exchanged(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """All rounds: ``tree, block, blocks``, the tree's root ``node`` and the
    steps from the block's root to it, ``path``."""
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    state = blocks.select("tree", "block", "blocks", "node", F.array().cast(f"array<{STEP}>").alias("path"))
    span, last = 1, None
    while span < most:
        state = scratch.keep(exchange(state, span), "butterfly")
        if last is not None:
            scratch.drop(last)
        last = state
        span *= FANOUT
    return state


def proofs(blocks: DataFrame, state: DataFrame, height: int) -> DataFrame:
    """One row per leaf with the siblings from it to the root. ``state`` has
    one row per block, so no block meets more than one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = pa.struct([("before", pa.string()), ("after", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                items = row["items"]
                all_levels = list(levels([i["digest"] for i in items], height if row["blocks"] > 1 else 0))
                upper = [(s["before"], s["after"]) for s in row["path"]]
                steps = [siblings(all_levels, at) + upper for at in range(len(items))]
                flat = [s for one in steps for s in one]
                offsets = [0]
                for one in steps:
                    offsets.append(offsets[-1] + len(one))
                values = pa.StructArray.from_arrays(
                    [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], fields=list(step)
                )
                n = len(items)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * n, pa.string()),
                        pa.array([i["id"] for i in items], pa.int64()),
                        *[pa.array([i[f] for i in items], pa.string()) for f in ("name", "digest", "other")],
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                        pa.array([row["node"]] * n, pa.string()),
                    ],
                    names=["tree", "id", "name", "digest", "other", "proof", "node"],
                )

    both = blocks.drop("node", "blocks").join(state, ["tree", "block"])
    return both.select("tree", "blocks", "items", "node", "path").mapInArrow(run, PROOF)


def forest(leaves: DataFrame, order: list[str], height: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    blocks = blocks_of(leaves, order, height, scratch)
    return blocks, exchanged(blocks, scratch)


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    fields: tuple[str, ...] = FIELDS,
    other_text: Column | None = None,
    text_col: str = "text",
    height: int = HEIGHT,
) -> DataFrame:
    """``id_col, leaf, other_leaf, subroot, root, proof`` of every row.

    ``proof`` lists, from the leaf up, what has to be put before and after a
    digest to get its parent's. ``other_text`` is a text that a row might have
    instead; where it is not null, ``other_leaf`` is the leaf with it."""
    scratch = Scratch(docs.sparkSession)
    empty = F.lit(None).cast("string")

    def with_text(text: Column | None) -> Column:
        return leaf([text if f == text_col and text is not None else F.col(f) for f in fields])

    other = empty if other_text is None else F.when(other_text.isNotNull(), with_text(other_text))
    rows = docs.select(
        tree_key(F.col(source_col)).alias("tree"),
        F.col(id_col).cast("bigint").alias("id"),
        empty.alias("name"),
        with_text(None).alias("digest"),
        other.alias("other"),
    )
    blocks, state = forest(rows, ["id", "digest"], height, scratch)
    sources = state.where("block = 0").select(
        F.lit("").alias("tree"),
        F.lit(None).cast("bigint").alias("id"),
        F.col("tree").alias("name"),
        F.col("node").alias("digest"),
        empty.alias("other"),
    )
    top = proofs(*forest(sources, ["name"], height, scratch), height)
    top = top.select(F.col("name").alias("tree"), F.col("proof").alias("upper"), F.col("node").alias("root"))
    found = state.join(top, "tree").withColumn("path", F.concat("path", "upper"))
    # Both digests travel with the block, so that no row is looked up by source.
    both = found.select(
        "tree", "block", "blocks", "path", F.concat_ws(" ", "node", "root").alias("node")
    )
    roots = F.split("node", " ")
    return proofs(blocks, both, height).select(
        F.col("id").alias(id_col),
        F.col("digest").alias("leaf"),
        F.col("other").alias("other_leaf"),
        roots[0].alias("subroot"),
        roots[1].alias("root"),
        "proof",
    )


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, start, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""))
