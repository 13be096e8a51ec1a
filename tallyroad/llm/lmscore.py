"""Documents scored by the cross-entropy difference of two language models.

The target model is counted on the documents that labels call good, the
background model on all documents. Both are bigram models over one vocabulary,
all words of the corpus, with the same smoothing; background counts are scaled to the target's number of tokens, so
that smoothing weighs the same in both. A document's score is the mean over its
tokens of the target's loss minus the background's, in nats: the lower, the
more it reads like the target.

    p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU)
    p(w) = (c(w) + 1) / (N + size of the vocabulary)

Nothing the corpus gives has a fixed size. Documents are put together in chunks
of about ``CHUNK`` tokens. A chunk hands in how often its words and bigrams come,
and gets back how often they come in all chunks. Keys are 64-bit hashes, and
the keys of a chunk are sorted, cut into ranges and handed in as one packed row
per range: differences of neighbours and counts, by byte planes, compressed. A
task merges the blocks of one range and answers each with a packed block.

A range has as many chunks as there are ranges, so what a task merges is as
large as one chunk, and a frequent word is one entry per block. Beyond ``FAN``
chunks there are several levels: teams of ``FAN`` merge their blocks first, and
teams of teams those, cut into finer ranges; answers come back level by level.
Hashes leave no range larger than others.

Words are split at ASCII white space and lower-cased in ASCII. A null or empty
text has no tokens and the score 0. Where no document is labelled good, the
target is the whole corpus, and every score is 0. An id labelled both ways is
not good; repeated ids are separate rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyroad.llm.common import stored, word_blocks

MU = 20.0
# Tokens of a chunk, every document being one more; a longer document is a chunk of its own.
CHUNK = 1 << 20
# Chunks whose blocks are merged at once.
FAN = 512
# Words whose hashes a task remembers.
HELD_WORDS = 500_000
# What is counted of a key: how often it comes, and of a word how often it ends
# a document; each in all and in good documents.
N, N_GOOD, LAST, LAST_GOOD = range(4)

BLOCK = "team bigint, part bigint, unit bigint, keys binary, counts binary"
ANSWER = "unit bigint, part bigint, totals binary, words bigint"


def good_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    rows = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    worst = rows.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return worst.where("quality = 1 AND coalesce(toxic, 0) = 0").select("id")


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 as compressed byte planes, in the fewest bytes that hold
    the largest."""
    most = int(values.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if most >> 8 * s == 0)
    planes = np.ascontiguousarray(values, dtype=f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()
    return struct.pack("<QB", len(values), size) + pa.Codec("zstd").compress(planes, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, size = struct.unpack_from("<QB", data)
    if not n:
        return np.zeros(0, np.uint64)
    planes = pa.Codec("zstd").decompress(data[9:], decompressed_size=n * size, asbytes=True)
    rows = np.frombuffer(planes, np.uint8).reshape(size, n).T
    return np.ascontiguousarray(rows).view(f"<u{size}").ravel().astype(np.uint64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def unpacked_counts(data: bytes) -> np.ndarray:
    return unpacked(data).reshape(4, -1)


def encode(docs: DataFrame, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """One row per chunk: its ``ids`` and lengths, the hashes of its distinct
    words, frequent ones first, and the tokens as places among those."""
    key = docs.schema[id_col].dataType
    schema = f"chunk bigint, ids array<{key.simpleString()}>, lengths array<bigint>, words binary, at binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        known: dict[bytes, int] = {}
        number = TaskContext.get().partitionId() << 32
        ids, lengths, parts, held = [], [], [], 0

        def codes(block: list[bytes]) -> np.ndarray:
            if len(known) >= HELD_WORDS:
                known.clear()
            known.update((w, digest(w)) for w in set(block) if w not in known)
            return np.fromiter(map(known.__getitem__, block), dtype=np.uint64, count=len(block))

        def chunk() -> pa.RecordBatch:
            distinct, at, n = np.unique(
                np.concatenate([*parts, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True
            )
            order = np.argsort(-n, kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            row = {
                "chunk": pa.array([number], pa.int64()),
                "ids": pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "words": pa.array([packed(distinct[order])], pa.binary()),
                "at": pa.array([packed(place[at])], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch.column(1)[i].as_py() or "").encode().lower()
                blocks = [codes(block) for block in word_blocks(data)]
                n = sum(map(len, blocks))
                if ids and held + n >= chunk_tokens:
                    yield chunk()
                    number += 1
                    ids, lengths, parts, held = [], [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                lengths.append(n)
                parts += blocks
                held += n + 1
        if ids:
            yield chunk()

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pair_hashes(before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    mixed = before * np.uint64(0x9E3779B97F4A7C15) + codes
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


class Chunk:
    """A chunk's tokens as places among its distinct words and bigrams. Keys of
    words are even, those of bigrams odd."""

    def __init__(self, lengths: np.ndarray, words: bytes, at: bytes):
        hashes, tokens = unpacked(words), unpacked(at).astype(np.int64)
        codes = hashes[tokens]
        before = np.concatenate([np.zeros(1, np.uint64), codes[:-1]])[: len(codes)]
        ends = np.cumsum(lengths)
        used = lengths > 0
        self.lengths, self.starts, self.ends = lengths, (ends - lengths)[used], ends[used] - 1
        # A document's first word follows 0.
        before[self.starts] = 0
        word_keys, places = np.unique(hashes & ~np.uint64(1), return_inverse=True)
        self.word = places[tokens]
        pair_keys, self.pair = np.unique(pair_hashes(before, codes) | np.uint64(1), return_inverse=True)
        self.n_words = len(word_keys)
        both = np.concatenate([word_keys, pair_keys])
        self.order = np.argsort(both)
        self.keys = both[self.order]

    def counts(self, good: np.ndarray) -> np.ndarray:
        """Four rows, one column per key."""
        marked = np.repeat(good, self.lengths).astype(float)
        size = len(self.keys)
        rows = np.zeros((4, size))
        for places, shift in ((self.word, 0), (self.pair, self.n_words)):
            rows[N] += np.bincount(places + shift, minlength=size)
            rows[N_GOOD] += np.bincount(places + shift, marked, minlength=size)
        last = self.word[self.ends]
        rows[LAST] = np.bincount(last, minlength=size)
        rows[LAST_GOOD] = np.bincount(last, marked[self.ends], minlength=size)
        return rows[:, self.order].astype(np.uint64)

    def by_kind(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns in the order of ``keys`` as those of words and of bigrams."""
        rows = np.empty(totals.shape)
        rows[:, self.order] = totals
        return rows[:, : self.n_words], rows[:, self.n_words :]


def flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False)


def chunk_of(row: pa.RecordBatch | pa.Table) -> tuple[Chunk, np.ndarray]:
    """A chunk, and which of its documents are good."""
    lengths = flat(row["lengths"])
    good = np.zeros(len(lengths), dtype=bool)
    good[flat(row["good"])] = True
    return Chunk(lengths, row["words"][0].as_py(), row["at"][0].as_py()), good


def cut(unit: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """A unit's keys as one block per range, named by their first bits."""
    parts = keys >> np.uint64(64 - bits) if bits else np.zeros_like(keys)
    names, starts = np.unique(parts, return_index=True)
    for name, a, b in zip(names.tolist(), starts, [*starts[1:], len(keys)]):
        block = [0, name, unit, packed_keys(keys[a:b]), packed(counts[:, a:b].ravel())]
        yield pa.RecordBatch.from_pylist([dict(zip(("team", "part", "unit", "keys", "counts"), block))])


def handed_in(chunks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                chunk, good = chunk_of(row)
                yield from cut(row["chunk"][0].as_py(), chunk.keys, chunk.counts(good), bits)

    return chunks.mapInArrow(run, BLOCK)


def finer(blocks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from cut(row["unit"], unpacked_keys(row["keys"]), unpacked_counts(row["counts"]), bits)

    return blocks.mapInArrow(run, BLOCK)


def merged(blocks: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All keys of some blocks, their added counts, and for each block the
    places of its keys."""
    found = [unpacked_keys(k.as_py()) for k in blocks["keys"]]
    keys, places = np.unique(np.concatenate(found), return_inverse=True)
    counts = np.concatenate([unpacked_counts(c.as_py()) for c in blocks["counts"]], axis=1).astype(float)
    sums = [np.bincount(places, row, len(keys)) for row in counts]
    return keys, np.array(sums).astype(np.uint64), np.split(places, np.cumsum([len(f) for f in found])[:-1])


def replies(blocks: pa.Table, totals: np.ndarray, places: list[np.ndarray], words: int) -> pa.Table:
    """An answer to each block. The number of words is given once."""
    rows = [packed(totals[:, p].ravel()) for p in places]
    counted = [words] + [0] * (len(rows) - 1)
    return pa.table({"unit": blocks["unit"], "part": blocks["part"], "totals": pa.array(rows, pa.binary()), "words": pa.array(counted, pa.int64())})


def joined(answers: pa.Table) -> np.ndarray:
    """The answers to one unit in the order of its keys."""
    rows = answers.sort_by("part")["totals"]
    return np.concatenate([np.zeros((4, 0), np.uint64), *[unpacked_counts(t.as_py()) for t in rows]], axis=1)


def bits_of(n: int) -> int:
    return max(n - 1, 0).bit_length()


def answered(blocks: DataFrame, units: int, fan: int, bits: int) -> DataFrame:
    """``ANSWER`` to the blocks of ``units`` units, which are cut by ``bits``
    bits and have their ``team``."""
    keys = ("team", "part")
    teams = -(-units // fan)
    if teams <= 1:

        def merge(group: pa.Table) -> pa.Table:
            found, sums, places = merged(group)
            return replies(group, sums, places, int((found & np.uint64(1) == 0).sum()))

        return blocks.groupBy(*keys).applyInArrow(merge, ANSWER)

    def add(group: pa.Table) -> pa.Table:
        found, sums, _ = merged(group)
        team, part = group["team"][0].as_py(), group["part"][0].as_py()
        return pa.Table.from_pylist([{"team": team, "part": part, "unit": team, "keys": packed_keys(found), "counts": packed(sums.ravel())}])

    blocks = stored(blocks, "blocks")
    added = stored(blocks.groupBy(*keys).applyInArrow(add, BLOCK), "added")
    more = bits_of(min(teams, fan))
    cut_again = finer(added, bits + more).withColumn("team", F.expr(f"unit div {fan}"))
    above = answered(cut_again, teams, fan, bits + more)
    above = above.select(F.col("unit").alias("team"), F.shiftright("part", more).alias("whole"), "part", "totals", "words")

    def give(group: pa.Table, answers: pa.Table) -> pa.Table:
        places = merged(group)[2]
        return replies(group, joined(answers), places, sum(answers["words"].to_pylist()))

    return blocks.groupBy(*keys).cogroup(above.groupBy("team", "whole")).applyInArrow(give, ANSWER)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mu: float = MU,
    chunk_tokens: int = CHUNK,
    fan: int = FAN,
) -> DataFrame:
    """``id_col, n_tokens, target_loss, background_loss, score``: mean losses
    per token, and their difference."""
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    encoded = stored(encode(plain, "id", "text", chunk_tokens), "encoded")
    # Labels meet ids, never texts; a chunk gets the places of its good documents.
    places = encoded.select("chunk", F.posexplode("ids").alias("place", "id"))
    good = places.join(good_ids(labels), "id").groupBy("chunk").agg(F.collect_list("place").alias("good"))
    chunks = encoded.join(good, "chunk", "left").withColumn("good", F.coalesce("good", F.array().cast("array<int>")))

    def total(numbers: str) -> F.Column:
        return F.sum(F.expr(f"aggregate({numbers}, 0L, (x, y) -> x + y)"))

    own = "transform(good, g -> get(lengths, g))"
    used = "size(filter({}, n -> n > 0))"
    n_chunks, *sums = chunks.agg(
        F.count("*"), total("lengths"), total(own), F.sum(F.expr(used.format("lengths"))), F.sum(F.expr(used.format(own)))
    ).first()
    whole, target, n_docs, n_good = (n or 0 for n in sums)

    bits = bits_of(min(n_chunks, fan))
    blocks = handed_in(chunks, bits)
    teams = max(1, -(-n_chunks // fan))
    blocks = blocks.withColumn("team", F.pmod(F.xxhash64("unit"), F.lit(teams)))
    answers = stored(answered(blocks, n_chunks, fan, bits), "answers")
    # One more for words that are not in the vocabulary.
    types = 1 + (answers.agg(F.sum("words")).first()[0] or 0)
    key = encoded.schema["ids"].dataType.elementType.simpleString()
    schema = f"id {key}, n_tokens bigint, target double, background double"

    def run(row: pa.Table, totals: pa.Table) -> pa.Table:
        chunk = Chunk(flat(row["lengths"]), row["words"][0].as_py(), row["at"][0].as_py())
        words, pairs = chunk.by_kind(joined(totals))

        def means(n: int, last: int, all_tokens: int, all_docs: int, factor: float) -> np.ndarray:
            single = (words[n] * factor + 1) / (all_tokens * factor + types)
            # A word comes before another wherever it does not end a document.
            before = np.empty(len(chunk.word))
            before[1:] = (words[n] - words[last])[chunk.word[:-1]]
            before[chunk.starts] = all_docs
            top = pairs[n][chunk.pair] * factor + mu * single[chunk.word]
            losses = np.log((before * factor + mu) / top)
            sums = np.zeros(len(chunk.lengths))
            if len(chunk.starts):
                sums[chunk.lengths > 0] = np.add.reduceat(losses, chunk.starts)
            return sums / np.maximum(chunk.lengths, 1)

        background = means(N, LAST, whole, n_docs, target / whole if target else 1.0)
        aimed = means(N_GOOD, LAST_GOOD, target, n_good, 1.0) if target else background
        ids = row["ids"].combine_chunks().flatten()
        return pa.table({"id": ids, "n_tokens": chunk.lengths, "target": aimed, "background": background})

    scored = encoded.groupBy("chunk").cogroup(answers.groupBy("unit")).applyInArrow(run, schema)
    return scored.select(
        F.col("id").alias(id_col),
        "n_tokens",
        F.col("target").alias("target_loss"),
        F.col("background").alias("background_loss"),
        (F.col("target") - F.col("background")).alias("score"),
    )
