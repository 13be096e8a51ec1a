"""The prefix trie against one built from dictionaries, and its SQL."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from tallyroad.llm import prefixtrie, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def token(turn):
    return hashlib.md5(f"{len(turn[0].encode())}:{turn[0]}{turn[1]}".encode()).hexdigest()


def brute(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turn = (role or "", text or "")
            by[c].append((t is not None, t or 0, token(turn), turn))
    for c in by:
        by[c] = [x[-1] for x in sorted(by[c])]
    whole = {}
    for c in by:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(by.get(c - int(math.fmod(c, 100)), [])[:h] + by[c][h:])
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(
        (
            (
                min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest(),
            )
            for p, m in members.items()
        ),
        key=lambda r: r[:2],
    )


def collected(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def talk(rng):
    """Conversations that branch and repeat, from few different turns."""
    rows = []
    for c in [*range(95, 135), 200, 250, 251, -3, 0, 10**12 + 1]:
        n = rng.choice([0, 1, 2, 4, 9, 9, 12])
        rows += [(c, t, rng.choice("ua"), rng.choice(["", "x", "é😀"])) for t in range(n)]
    return rows


@pytest.mark.parametrize("limit,block_rows,seed", [(1, 1, 0), (2, 3, 1), (64, 512, 2), (3, 7, 3)])
def test_nodes_equal_brute_force(spark, limit, block_rows, seed):
    rows = talk(random.Random(seed))
    # Long copies, and long ones that part late.
    long = [("u", f"{i % 3}") for i in range(40)]
    for c, cut in ((300, 40), (306, 40), (307, 33), (308, 40)):
        rows += [(c, t, *x) for t, x in enumerate(long[:cut])] + ([(c, 99, "u", "end")] if c == 308 else [])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert collected(prefixtrie.branched_trie(df, limit=limit, block_rows=block_rows)) == brute(rows)


def test_nulls_ties_repeats_long_texts_and_further_columns(spark):
    rows = [(None, 1, "u", "lost"), (5, None, None, None), (5, None, "u", "b"), (5, 1, "u", "a"), (5, 1, "u", "a")]
    rows += [(6, None, "", ""), (6, 2, "u", "w" * 2_000_000), (7, 3, "z", "only"), (105, 1, "u", "a")]
    df = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], SCHEMA + ", pos int, token string, first int")
    assert collected(prefixtrie.branched_trie(df, limit=2, block_rows=2)) == brute(rows)
    assert prefixtrie.branched_trie(df.limit(0)).collect() == []


def test_only_the_root_where_no_turn_is_left(spark):
    # Their heads cover all their turns, and nobody begins their group.
    ids = [c for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6 >= 2][:9]
    rows = [(c, 1, "u", "x") for c in ids]
    assert collected(prefixtrie.branched_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(brute(rows)) == 1


def test_a_conversation_that_holds_most_turns_and_many_copies(spark):
    rows = [(1, t, "u", f"{t}") for t in range(9000)] + [(2, t, "u", f"{t}") for t in range(6)]
    copies = [(c, t, "a", "same" * t) for c in range(1000, 6000) for t in (1, 2)]
    copies = [r for r in copies if r[0] % 100]
    got = prefixtrie.branched_trie(spark.createDataFrame(rows + copies, SCHEMA), limit=4, block_rows=8)
    assert collected(got) == brute(rows + copies)


def test_extents_and_minima():
    rng = np.random.default_rng(2)
    for m in (1, 2, 3, 17, 64):
        lcp = rng.integers(0, 4, m)
        rows = np.repeat(np.arange(m), 5)
        depths = np.tile(np.arange(5), m)
        left, right = prefixtrie.extents(lcp, rows, depths)
        for i, d, lo, hi in zip(rows, depths, left, right):
            a = b = i
            while a > 0 and lcp[a] >= d:
                a -= 1
            while b + 1 < m and lcp[b + 1] >= d:
                b += 1
            assert (a, b) == (lo, hi)
        values = rng.integers(0, 100, m)
        assert list(prefixtrie.least_between(values, left, right)) == [values[a : b + 1].min() for a, b in zip(left, right)]


def test_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    result = duck.execute(queries.oracle_sql()["op13_prefix_trie"])
    assert [c[0] for c in result.description] == COLUMNS
    got = queries.op13_prefix_trie(spark, SF)
    assert all(t == "bigint" for n, t in got.dtypes if n != "ends_sha256")
    assert collected(got) == sorted(result.fetchall(), key=lambda r: r[:2])
    assert collected(got) == brute([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
