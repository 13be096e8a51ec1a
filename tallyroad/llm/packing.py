"""Packing token streams into sequences of fixed length.

Documents keep their order. The stream of a partition is cut into windows of
at most ``length`` tokens; cuts are only considered at the end of a document,
at the end of a sentence, and, for sentences longer than ``GRID`` tokens, every
``GRID`` tokens inside them. A dynamic programme picks the cuts with the least
cost, which is the padding of all windows plus a penalty for a cut inside a
document and a larger one inside a sentence. With f(j) the least cost up to cut
j at token p(j),

    f(j) = penalty(j) + length - p(j) + min over p(j) - p(i) <= length of (f(i) + p(i))

so the minimum is over a window that only moves forward, and a monotone queue
gives it in constant time. No document is copied, shuffled or sorted; each
partition is packed on its own and in blocks of ``BLOCK`` tokens, the last open
window of a block being taken on to the next, so memory is bounded.

A null or empty text is the end token alone.
"""

from __future__ import annotations

import re
import sys
import types
from collections import ChainMap, deque
from collections.abc import Callable, Iterator, Sequence
from operator import ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 1024
GRID = 16
SENTENCE_PENALTY = 1
INNER_PENALTY = 6
BLOCK = 1 << 18
END_ID = 0
# Words whose ids are remembered in each of two generations, and words encoded
# in one call.
CACHE_WORDS = 600_000
CALL_WORDS = 2_000
# Characters of the texts whose words are looked up together. Longer texts are
# looked up alone.
TEXT_BLOCK = 1 << 21

COLUMNS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Token ids of whole texts with a byte-level BPE vocabulary.

    Such a vocabulary never merges over a space between two visible
    characters, the space belonging to the word after it. So a text is cut
    there, and a word that was seen before needs no second encoding.
    """

    def __init__(self, path: str, cache_words: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        # Tokens that can end a sentence: by its mark or by a line break.
        self.closes = np.zeros(len(self.opens), dtype=bool)
        for token, i in vocabulary.items():
            self.opens[i] = token.startswith("Ġ")
            self.closes[i] = token.endswith((".", "!", "?")) or "Ċ" in token
        # Words of the full generation before move back when they are seen again.
        self.cache_words = CACHE_WORDS if cache_words is None else cache_words
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def ids(self, text: str) -> np.ndarray:
        words = text.split(" ")
        if len(self.seen) > self.cache_words:
            self.seen, self.older = {}, self.seen
        new = self.unseen(words[1:])
        own: dict[str, bytes] = {}
        # A space next to other white space is no safe place. It leaves a word
        # that is empty or can be stripped; such words are never remembered.
        listed = list(new)
        # Most sets of words pass as a whole.
        plain = " ".join(listed).split() == listed
        if words[0] != words[0].rstrip() or not plain and any(not w or w != w.strip() for w in new):
            words = re.split(r"(?<=\S) (?=\S)", text)
            new = self.unseen(words[1:])
            own = {w: self.plain(" " + w).tobytes() for w in new if w.split() != [w]}
            new = new.difference(own)
        new = list(new)
        for at in range(0, len(new), CALL_WORDS):
            self.learn(new[at : at + CALL_WORDS])
        known = ChainMap(own, self.seen) if own else self.seen
        rest = b"".join(map(known.__getitem__, words[1:]))
        return np.concatenate([self.plain(words[0]), np.frombuffer(rest, dtype="<u4")])

    def many(self, texts: list[str], last: Sequence[int] = ()) -> Iterator[np.ndarray]:
        """``ids`` of each text, and ``last``. The words of all texts are looked
        up together, each once; meant for texts of ``TEXT_BLOCK`` characters in all."""
        if len(self.seen) > self.cache_words:
            self.seen, self.older = {}, self.seen
        end = np.array(last, dtype="<u4")
        parts = [text.partition(" ") for text in texts]
        lists = pc.split_pattern(pa.array([rest if space else None for _, space, rest in parts], pa.string()), " ")
        edges = np.asarray(lists.offsets)
        coded = lists.values.dictionary_encode()
        words = joined(coded.dictionary)
        # The same unsafe places as in ``ids``, where such a text goes.
        unsafe = np.fromiter(map(ne, map(str.strip, words), words), dtype=bool, count=len(words))
        if "" in words:
            unsafe[words.index("")] = True
        alone = {i for i, (first, _, _) in enumerate(parts) if first != first.rstrip()}
        if unsafe.any():
            at = np.flatnonzero(unsafe[np.asarray(coded.indices)])
            alone.update((np.searchsorted(edges, at, side="right") - 1).tolist())
        found = list(map(self.seen.get, words))
        lost = [k for k, ids in enumerate(found) if ids is None]
        if unsafe.any():
            lost = [k for k in lost if not unsafe[k]]
        if self.older:
            back = [k for k in lost if words[k] in self.older]
            for k in back:
                found[k] = self.seen[words[k]] = self.older[words[k]]
            if back:
                lost = [k for k in lost if found[k] is None]
        for at in range(0, len(lost), CALL_WORDS):
            these = lost[at : at + CALL_WORDS]
            for k, ids in zip(these, self.learn([words[k] for k in these])):
                found[k] = ids
        # A word without ids belongs to texts that are looked up alone.
        rows = pa.array(found, pa.binary()).take(coded.indices)
        _, ends, data = rows.buffers()
        ids = np.frombuffer(data, dtype="<u4") if data else end[:0]
        edges = np.frombuffer(ends, dtype=np.int32)[edges] // 4 if len(rows) else edges
        for i, (first, _, _) in enumerate(parts):
            if i in alone:
                yield np.concatenate([self.ids(texts[i]), end])
            else:
                yield np.concatenate([self.plain(first), ids[edges[i] : edges[i + 1]], end])

    def unseen(self, words: list[str]) -> set[str]:
        new = set(words).difference(self.seen)
        back = [w for w in new if w in self.older] if self.older else []
        for word in back:
            self.seen[word] = self.older[word]
        return new.difference(back)

    def learn(self, words: list[str]) -> list[bytes]:
        ids = self.plain(" " + " ".join(words))
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) == len(words):
            edges = [*(starts * ids.itemsize).tolist(), ids.nbytes]
            data = ids.tobytes()
            found = [data[a:b] for a, b in zip(edges, edges[1:])]
        else:  # a word with inner white space
            found = [self.plain(" " + word).tobytes() for word in words]
        self.seen.update(zip(words, found))
        return found


def joined(words: pa.StringArray) -> list[str]:
    """The words, which hold no space, as Python strings (``to_pylist`` takes
    several times as long)."""
    if not len(words):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py().split(" ")


def worker_encoder(path: str, cache_words: int | None = None) -> Encoder:
    """The encoder of this Python worker. A worker runs many tasks one after
    another; kept on a module that stays loaded, the encoder and the words it
    has seen serve them all."""
    kept = sys.modules.setdefault("_tallyroad_worker", types.ModuleType("_tallyroad_worker"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if (path, cache_words) not in encoders:
        encoders[path, cache_words] = Encoder(path, cache_words)
    return encoders[path, cache_words]


def cut_points(ids: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of these ids may be cut (tokens before the cut, its
    whole length last), and the penalties."""
    n = len(ids)
    ends = np.flatnonzero(closes[ids[:-1]]) + 1 if n > 1 else np.zeros(0, dtype=np.int64)
    edges = np.concatenate([[0], ends, [n]])
    gaps = np.diff(edges)
    # Steps of GRID inside each gap; the sentence end itself closes it.
    inner = np.maximum((gaps - 1) // GRID, 0)
    base = np.repeat(edges[:-1], inner)
    step = np.arange(inner.sum()) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    points = np.concatenate([ends, base + step * GRID, [n]])
    costs = np.concatenate([np.full(len(ends), SENTENCE_PENALTY), np.full(len(base), INNER_PENALTY), [0]])
    order = np.argsort(points, kind="stable")
    points, costs = points[order], costs[order]
    # A document end right after a sentence end, or an empty gap, is one point.
    keep = np.append(points[1:] != points[:-1], True)
    return points[keep], costs[keep]


def best_cuts(points: list[int], costs: list[int], length: int, closed: bool) -> list[int]:
    """Chosen cuts out of ``points`` (ascending, gaps at most ``length``),
    starting from token 0. ``closed``: the last point has to be a cut, and its
    window is padded; else what is after the last full stretch stays open and
    ends are compared as if nothing were padded there."""
    at = [0, *points]
    penalty = [0, *costs]
    n = len(at)
    best = [0] * n  # f(j) + p(j)
    came = [0] * n
    queue = deque([0])
    for j in range(1, n):
        p = at[j]
        low = p - length
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        came[j] = i
        value = best[i] + penalty[j] + length  # f(j) + p(j) = penalty + length - p(j) + (f(i) + p(i)) + p(j)
        best[j] = value
        while queue and best[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    j = n - 1
    if not closed:
        # The open window starts at the cheapest point that reaches the end.
        j = min((k for k in queue if at[k] >= at[-1] - length), key=lambda k: (best[k], k))
        if j == 0:
            return []
    chosen = []
    while j:
        chosen.append(at[j])
        j = came[j]
    return chosen[::-1]


class Packer:
    """Turns documents, one by one, into pieces of sequences."""

    def __init__(self, closes: np.ndarray, length: int, first_sequence: int):
        self.closes, self.length, self.sequence = closes, length, first_sequence
        self.open: list[tuple[object, np.ndarray, int]] = []  # id, ids, tokens already out
        self.points: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.tokens = 0

    def add(self, doc_id: object, ids: np.ndarray) -> Iterator[tuple]:
        points, costs = cut_points(ids, self.closes)
        self.open.append((doc_id, ids, 0))
        low = 0
        for high in [*range(BLOCK, len(ids), BLOCK), len(ids)]:
            a, b = np.searchsorted(points, [low, high], side="right")
            self.points.append(points[a:b] - low + self.tokens)
            self.costs.append(costs[a:b])
            self.tokens += high - low
            low = high
            if self.tokens >= BLOCK:
                yield from self.flush(False)

    def flush(self, closed: bool) -> Iterator[tuple]:
        if not self.open:
            return
        points, costs = np.concatenate(self.points), np.concatenate(self.costs)
        cuts = best_cuts(points.tolist(), costs.tolist(), self.length, closed)
        done, at, index = 0, 0, 0  # tokens out, start of the document at hand, its index
        for cut in cuts:
            offset = 0
            while done < cut:
                doc_id, ids, out = self.open[index]
                end = at + len(ids) - out
                take = min(cut, end) - done
                start = out + done - at
                yield doc_id, start, ids[start : start + take], len(ids), self.sequence, offset
                offset += take
                done += take
                if done == end:
                    at, index = end, index + 1
            self.sequence += 1
        rest = self.open[index:]
        if rest:
            doc_id, ids, out = rest[0]
            rest[0] = (doc_id, ids, out + done - at)
        left = points > done
        self.open, self.tokens = rest, self.tokens - done
        self.points, self.costs = [points[left] - done], [costs[left]]


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    encoder: Callable[[str], Encoder] = worker_encoder,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids`` (little-endian
    unsigned 32-bit numbers), ``doc_tokens, sequence_id, offset``.

    ``vocabulary`` is the path of a tokenizer file on the executors. Sequence
    numbers are unique; those of a partition follow each other."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        packer = Packer(coder.closes, length, TaskContext.get().partitionId() << 40)
        id_type: list[pa.DataType] = []

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, tokens, sequence, offset = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, id_type[0]),
                    pa.array(start, pa.int64()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.tobytes() for i in ids], pa.binary()),
                    pa.array(tokens, pa.int64()),
                    pa.array(sequence, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def blocks() -> Iterator[tuple[list, list[str]]]:
            keys, texts, size = [], [], 0
            for batch in batches:
                id_type[:] = [batch.column(0).type]
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    text = text.as_py() or ""
                    if texts and size + len(text) > TEXT_BLOCK:
                        yield keys, texts
                        keys, texts, size = [], [], 0
                    keys.append(doc_id.as_py())
                    texts.append(text)
                    size += len(text)
            if texts:
                yield keys, texts

        def encoded() -> Iterator[tuple[object, np.ndarray]]:
            for keys, texts in blocks():
                if len(texts) > 1:
                    yield from zip(keys, coder.many(texts, [END_ID]))
                else:
                    yield keys[0], np.append(coder.ids(texts[0]), np.array([END_ID], dtype="<u4"))

        pieces: list[tuple] = []
        for doc_id, ids in encoded():
            for piece in packer.add(doc_id, ids):
                pieces.append(piece)
                if len(pieces) >= 4096:
                    yield table(pieces)
                    pieces = []
        pieces += packer.flush(True)
        if pieces:
            yield table(pieces)

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {key}, {COLUMNS}")
