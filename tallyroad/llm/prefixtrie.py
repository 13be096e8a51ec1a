"""Trie of conversation prefixes by range minima over sorted common prefixes.

Sequences of turns are sorted, neighbours' longest common prefixes (LCP) taken,
and a sparse table of their range minima built. Each prefix is a candidate at
the row where it first occurs; binary searches over the sparse table find how
far left and right it reaches, for all candidates independently. Member counts,
smallest members, leaves and savings are then sums and minima over intervals.

At scale:

* A turn is a 128-bit digest with its text length; texts are not shuffled.
* Equal sequences are one row with a number of copies.
* A conversation may hold any share of all turns. Only turns up to the depth at
  which a sequence parts from all others are gathered into a row, found by
  doubling a limit for those that still share their beginning. Deeper turns
  become nodes row by row. Two sequences that share m turns need rows of up to
  2 m digests; nothing else is held whole.
* Sorted rows are dealt into blocks of ``BLOCK_ROWS`` with one neighbour row on
  either side. Prefixes that reach over a block's edge are sums of their parts.
* Ids of copies are hashed in order, in chunks of text: the digest of a large
  group is one stream over chunks, not a list.

Rules: turns are ordered by turn (null first), then digest of role and text; a
null role or text is empty; rows without a conversation id are left out; texts
may have any length. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyroad.llm.places import Scratch, place

BLOCK_ROWS = 512
FIRST_LIMIT = 64
DIGITS = 32  # of a turn's digest
CHUNK_BITS = 12

PARTS = (
    "block bigint, depth bigint, conv bigint, parent bigint, n bigint, children bigint, leaves bigint, "
    "saved bigint, ends bigint, edge string, parent_edge string"
)
MEASURES = ("n", "children", "leaves", "saved")


def digested(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, token, chars``; a turn that is null stays null."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.md5(marked.cast("binary")).alias("token"),
        F.char_length(text).cast("bigint").alias("chars"),
    )


def chunk(position: str) -> Column:
    return F.shiftright(position, CHUNK_BITS)


def chunks(rows: Column) -> Column:
    """Numbers of the chunks of so many rows; none for none."""
    last = F.shiftright(rows - 1, CHUNK_BITS)
    return F.when(rows > 0, F.sequence(F.lit(0).cast("bigint"), last)).otherwise(F.array().cast("array<bigint>"))


def rebuilt(turns: DataFrame, anchor: Column, heads: Column, most: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first ``heads`` turns (``most`` at most)
    taken from the conversation ``anchor``; both are columns of ``conv``.

    Two tables: ``conv, length``, and ``conv, pos, token, chars``."""
    ordered = scratch.keep(place(turns, ["conv"], ["turn", "token"], scratch).drop("turn"), "turns")
    turn = F.struct("place", "token", "chars")
    first = ordered.where(F.col("place") < most).groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("first"))
    own = ordered.groupBy("conv").agg(F.max("total").alias("total"))
    plan = own.select("conv", "total", anchor.alias("anchor"), heads.alias("heads").cast("int")).join(
        first.withColumnRenamed("conv", "anchor"), "anchor", "left"
    )
    none = F.array().cast("array<struct<place:bigint,token:string,chars:bigint>>")
    plan = plan.withColumn("head", F.slice(F.coalesce("first", none), F.lit(1), F.col("heads")))
    plan = scratch.keep(plan.select("conv", "total", "heads", "head", F.size("head").alias("kept")), "rebuilt")
    lengths = plan.select(
        "conv", (F.col("kept") + F.greatest(F.col("total") - F.col("heads"), F.lit(0))).cast("bigint").alias("length")
    )
    begun = plan.select("conv", F.posexplode("head").alias("pos", "t"))
    begun = begun.select("conv", F.col("pos").cast("bigint").alias("pos"), "t.token", "t.chars")
    # By conversation and chunk, so that a large conversation is no hot key.
    shifts = plan.select("conv", "heads", (F.col("kept") - F.col("heads")).alias("shift"), F.explode(chunks(F.col("total"))).alias("chunk"))
    went_on = (
        ordered.withColumn("chunk", chunk("place"))
        .join(shifts, ["conv", "chunk"])
        .where(F.col("place") >= F.col("heads"))
        .select("conv", (F.col("place") + F.col("shift")).alias("pos"), "token", "chars")
    )
    return lengths, scratch.keep(begun.unionByName(went_on), "sequences")


def fingerprint() -> list[Column]:
    """128 bits of a set of positions and tokens, whatever their order."""
    return [
        F.bit_xor(F.xxhash64("pos", "token")).alias("p1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "token", "pos")).alias("p2"),
    ]


def distinct_sequences(lengths: DataFrame, turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``first, length, n``: the smallest id and number of equal sequences,
    and ``first, conv`` of all."""
    prints = lengths.join(turns.groupBy("conv").agg(*fingerprint()), "conv", "left")
    prints = scratch.keep(prints.na.fill(0, ["p1", "p2"]), "prints")
    key = ["length", "p1", "p2"]
    kinds = scratch.keep(prints.groupBy(*key).agg(F.min("conv").alias("first"), F.count("*").alias("n")), "kinds")
    members = prints.join(kinds, key).select("first", "conv")
    return kinds.select("first", "length", "n"), members


def parting_limits(kinds: DataFrame, turns: DataFrame, scratch: Scratch, limit: int = FIRST_LIMIT) -> DataFrame:
    """``first, limit`` of sequences over ``limit`` turns: a number of turns
    that no other sequence longer than it begins with as well. ``turns`` has
    the ``length`` of the sequence in each row."""
    open_kinds = kinds.where(F.col("length") > limit).select("first", "length")
    left = open_kinds.select("first", F.lit(limit).alias("limit"))
    while True:
        begun = turns.where(F.col("pos") < limit).join(open_kinds.select("first"), "first").groupBy("first", "length").agg(*fingerprint())
        begun = scratch.keep(begun, "begun")
        shared = begun.groupBy("p1", "p2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        again = scratch.keep(begun.join(shared, ["p1", "p2"]).select("first", "length"), "shared")
        scratch.drop(begun)
        if again.isEmpty():
            return left
        limit *= 2
        left = left.join(again.select("first"), "first", "left_anti").unionByName(again.select("first", F.lit(limit).alias("limit")))
        left = scratch.keep(left, "limits")
        open_kinds = again.where(F.col("length") > limit)


def extents(lcp: np.ndarray, rows: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around each of ``rows`` that shares its first
    ``depths`` turns. ``lcp[i]`` is that of rows i - 1 and i."""
    table = [lcp]
    while 2 << (len(table) - 1) <= len(lcp):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    left, right = rows.copy(), rows.copy()
    for level in range(len(table) - 1, -1, -1):
        step, low = 1 << level, table[level]
        # Rows right + 1 to right + step, if there are so many.
        at = np.minimum(right + 1, len(low) - 1)
        go = (right + step < len(lcp)) & (low[at] >= depths)
        right = np.where(go, right + step, right)
        at = np.maximum(left - step + 1, 1)
        go = (left - step >= 0) & (low[np.minimum(at, len(low) - 1)] >= depths)
        left = np.where(go, left - step, left)
    return left, right


def least_between(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minima over ``values[left..right]``, by two overlapping ranges."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    out = np.empty(len(left), values.dtype)
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][left[at]], table[k][right[at] - (1 << int(k)) + 1])
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def before_and(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def block_nodes(rows: list[dict], before: str | None, after: str | None) -> dict[str, list]:
    """Nodes among sorted ``rows``: ``path, chars, n, first, cut, tail``.
    ``before`` and ``after`` are the neighbours' paths. Measures of a node that
    reaches over an edge are the parts that this block adds."""
    paths = [np.frombuffer(r["path"].encode(), f"S{DIGITS}") for r in rows]
    outer = [None if p is None else np.frombuffer(p.encode(), f"S{DIGITS}") for p in (before, after)]
    m = len(rows)
    length = np.array([len(p) for p in paths])
    lcp = np.array([0, *[common(a, b) for a, b in zip(paths, paths[1:])]])
    from_before = -1 if outer[0] is None else common(outer[0], paths[0])
    to_after = -1 if outer[1] is None else common(paths[-1], outer[1])

    # Candidates: prefixes where they first occur, by row and depth.
    least = lcp + 1
    least[0] = 0
    many = length - least + 1
    start = before_and(many)
    row = np.repeat(np.arange(m), many)
    depth = np.arange(start[-1]) - np.repeat(start[:-1], many) + np.repeat(least, many)
    left, right = extents(lcp, row, depth)
    # A node counts in the block where it begins.
    fresh = (row > 0) | (depth > from_before)

    copies = np.array([r["n"] for r in rows])
    first = np.array([r["first"] for r in rows])
    cut = np.array([r["cut"] for r in rows])
    n_sum = before_and(copies)
    n = n_sum[right + 1] - n_sum[left]
    conv = least_between(first, left, right)

    # The parent of a row's first candidate begins in an earlier row.
    parent = np.arange(start[-1]) - 1
    heads = start[1:-1]
    begins, _ = extents(lcp, np.arange(1, m), lcp[1:])
    parent[heads] = start[begins] + lcp[1:] - least[begins]
    deepest = start[1:] - 1
    children = np.bincount(parent[1:], weights=fresh[1:], minlength=start[-1]).astype(np.int64)
    children[deepest] += cut

    following = np.append(lcp[1:], to_after)
    leaf_sum = before_and(following < length)
    leaves = leaf_sum[right + 1] - leaf_sum[left]

    chars = np.concatenate([[0, *r["chars"]][low:] for r, low in zip(rows, least)]).astype(np.int64)
    saved_sum = before_and((n - fresh) * chars)
    tail_sum = before_and((copies - 1) * np.array([r["tail"] for r in rows]))
    saved = saved_sum[start[right + 1]] - saved_sum[: start[-1]] + tail_sum[right + 1] - tail_sum[left]

    ends: list = [None] * start[-1]
    for i in range(m):
        if not cut[i]:
            ends[deepest[i]] = int(first[i])

    over = ((left == 0) & (depth <= from_before)) | ((right == m - 1) & (depth <= to_after))
    edge: list = [None] * start[-1]
    for k in np.flatnonzero(over):
        edge[k] = hashlib.md5(rows[row[k]]["path"][: depth[k] * DIGITS].encode()).hexdigest()
    root = parent < 0
    return {
        "depth": depth,
        "conv": conv,
        "parent": [None if r or edge[p] else int(conv[p]) for p, r in zip(parent, root)],
        "n": n,
        "children": children,
        "leaves": leaves,
        "saved": saved,
        "ends": ends,
        "edge": edge,
        "parent_edge": [None if r else edge[p] for p, r in zip(parent, root)],
    }


def find_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted, with their neighbours' rows in place."""
    names = [c.split()[0] for c in PARTS.split(", ")]
    kinds = [pa.string() if "edge" in c else pa.int64() for c in names]

    def finished(block: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        own = [r for r in rows if r["side"] == 0]
        if not own:
            return
        outer = {r["side"]: r["path"] for r in rows}
        found = block_nodes(own, outer.get(-1), outer.get(1))
        size = len(found["depth"])
        whole = pa.RecordBatch.from_arrays(
            [pa.array([block] * size if c == "block" else found[c], k) for c, k in zip(names, kinds)], names=names
        )
        for at in range(0, size, 10_000):
            yield whole.slice(at, 10_000)

    block, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["block"] != block:
                if rows:
                    yield from finished(block, rows)
                block, rows = r["block"], []
            rows.append(r)
    if rows:
        yield from finished(block, rows)


def shared_nodes(kinds: DataFrame, turns: DataFrame, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Nodes down to the depth that is gathered. ``kinds``: ``first, length, n,
    held``; ``turns``: ``first, length, n, pos, token, chars, held``."""
    turn = F.struct("pos", "token", "chars")
    held = F.col("pos") < F.col("held")
    gathered = turns.groupBy("first").agg(
        F.sort_array(F.collect_list(F.when(held, turn))).alias("turns"),
        F.sum(F.when(held, 0).otherwise(F.col("chars"))).alias("tail"),
    )
    none = F.array().cast("array<struct<pos:bigint,token:string,chars:bigint>>")
    rows = kinds.join(gathered, "first", "left").withColumn("turns", F.coalesce("turns", none))
    rows = rows.select(
        F.array_join(F.transform("turns", lambda t: t["token"]), "").alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
        "n",
        "first",
        (F.col("length") > F.col("held")).alias("cut"),
        F.coalesce("tail", F.lit(0)).cast("bigint").alias("tail"),
    )
    placed = place(rows, [], ["path"], scratch)
    block = F.floor(F.col("place") / block_rows)
    # The first row of a block follows the block before, the last precedes the next.
    at_start = F.when((F.col("place") % block_rows == 0) & (F.col("place") > 0), F.lit(1))
    at_end = F.when(F.col("place") % block_rows == block_rows - 1, F.lit(-1))
    sides = F.filter(F.array(F.lit(0), at_start, at_end), lambda s: s.isNotNull())
    dealt = placed.withColumn("side", F.explode(sides)).withColumn("block", (block - F.col("side")).cast("bigint"))
    dealt = dealt.repartition("block").sortWithinPartitions("block", "place").drop("place", "total")
    parts = scratch.keep(dealt.mapInArrow(find_nodes, PARTS), "parts")

    over = parts.where(F.col("edge").isNotNull())
    sums = over.groupBy("edge").agg(
        F.max("depth").alias("depth"),
        F.min("conv").alias("conv"),
        *[F.sum(c).alias(c) for c in MEASURES],
        F.max("ends").alias("ends"),
        F.max("parent_edge").alias("parent_edge"),
    )
    sums = scratch.keep(sums, "edges")
    names = sums.select(F.col("edge").alias("parent_edge"), F.col("conv").alias("parent"))
    columns = ["depth", "conv", "parent", *MEASURES, "ends"]
    whole = sums.join(names, "parent_edge", "left").select(columns)
    # Children of an edge node may be any share of a level: each block gets
    # the ids of its own edge nodes, and joins them by itself.
    known = over.select("block", F.col("edge").alias("parent_edge")).distinct().join(names, "parent_edge")
    inner = parts.where(F.col("edge").isNull())
    beside = inner.where(F.col("parent_edge").isNotNull()).drop("parent").join(known, ["block", "parent_edge"])
    inside = inner.where(F.col("parent_edge").isNull())
    return whole.unionByName(inside.select(columns)).unionByName(beside.select(columns))


def tail_nodes(turns: DataFrame) -> DataFrame:
    """Nodes below the depth that is gathered: a chain for each sequence."""
    rows = turns.where(F.col("pos") >= F.col("held")).withColumn("chunk", chunk("pos"))
    sums = rows.groupBy("first", "chunk").agg(F.sum("chars").alias("sum"))
    later = Window.partitionBy("first").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("first", "chunk", F.coalesce(F.sum("sum").over(later), F.lit(0)).alias("later"))
    here = Window.partitionBy("first", "chunk").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("pos") + 1 == F.col("length")
    return (
        rows.withColumn("rest", F.sum("chars").over(here))
        .join(sums, ["first", "chunk"])
        .select(
            (F.col("pos") + 1).alias("depth"),
            F.col("first").alias("conv"),
            F.col("first").alias("parent"),
            "n",
            F.when(last, 0).otherwise(1).cast("bigint").alias("children"),
            F.lit(1).cast("bigint").alias("leaves"),
            ((F.col("n") - 1) * (F.col("rest") + F.col("later"))).alias("saved"),
            F.when(last, F.col("first")).alias("ends"),
        )
    )


def digests_of_ids(members: DataFrame, scratch: Scratch) -> DataFrame:
    """``ends, ends_sha256``: the digest of the joined ids of equal sequences."""
    placed = place(members, ["first"], ["conv"], scratch)
    texts = placed.groupBy("first", chunk("place").alias("chunk"), "total").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("text")
    )
    texts = scratch.keep(texts, "ids")
    small = F.col("total") <= 1 << CHUNK_BITS

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            for first, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first != key:
                    if state is not None:
                        yield pa.RecordBatch.from_pydict({"ends": [key], "ends_sha256": [state.hexdigest()]})
                    key, state = first, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state is not None:
            yield pa.RecordBatch.from_pydict({"ends": [key], "ends_sha256": [state.hexdigest()]})

    large = texts.where(~small).repartition("first").sortWithinPartitions("first", "chunk").select("first", "text")
    large = large.mapInArrow(stream, "ends bigint, ends_sha256 string")
    return texts.where(small).select(F.col("first").alias("ends"), F.sha2(F.col("text").cast("binary"), 256).alias("ends_sha256")).unionByName(large)


def trie(lengths: DataFrame, turns: DataFrame, scratch: Scratch, limit: int = FIRST_LIMIT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of sequences ``conv, length`` with turns ``conv, pos, token,
    chars``: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    kinds, members = distinct_sequences(lengths, turns, scratch)
    spread = kinds.withColumn("chunk", F.explode(chunks(F.col("length"))))
    own = turns.withColumnRenamed("conv", "first").withColumn("chunk", chunk("pos"))
    own = scratch.keep(own.join(spread, ["first", "chunk"]).drop("chunk"), "own")
    limits = parting_limits(kinds, own, scratch, limit)
    # One turn more than a shared beginning can have, so that each row differs.
    held = (F.coalesce("limit", F.lit(limit)) + 1).cast("bigint")
    kinds = scratch.keep(kinds.join(limits, "first", "left").select("first", "length", "n", held.alias("held")), "held")
    heads = kinds.withColumn("chunk", F.explode(chunks(F.col("length")))).select("first", "chunk", "held")
    own = own.withColumn("chunk", chunk("pos")).join(heads, ["first", "chunk"]).drop("chunk")
    columns = ["depth", "conv", "parent", *MEASURES, "ends"]
    nodes = shared_nodes(kinds, own, scratch, block_rows).unionByName(tail_nodes(own).select(columns))
    nodes = scratch.keep(nodes, "nodes")
    # Only nodes at which something ends are looked up; the others would all
    # meet under one null key.
    ended = nodes.where(F.col("ends").isNotNull()).join(digests_of_ids(members, scratch), "ends")
    others = nodes.where(F.col("ends").isNull()).withColumn("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return ended.unionByName(others).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def branched_trie(
    conversations: DataFrame,
    group: int = 100,
    kinds: int = 6,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    limit: int = FIRST_LIMIT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The trie of conversations that begin like the first one of their group
    of ``group`` ids, for ``crc32(id) % kinds`` turns."""
    scratch = Scratch(conversations.sparkSession)
    turns = digested(conversations, conv_col, turn_col, role_col, text_col)
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % kinds
    anchor = F.col("conv") - F.col("conv") % group
    return trie(*rebuilt(turns, anchor, heads, kinds - 1, scratch), scratch, limit, block_rows)
