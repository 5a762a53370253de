"""Order-preserving packing of token streams by dynamic programming.

The documents of an input partition, in its order, are one stream of ids. Windows of
at most ``window`` ids are cut from it, each at a document's end, at a sentence's end
or, where neither comes for long, at a fixed step. The cuts minimise

    sum over windows of padding + penalty of the cut that ends the window,

where a window that is exactly a power of two long needs no padding. With p the cut
positions, padding is ``window - (p_j - p_i)``, so

    best(j) = window - p_j + penalty(j) + min over p_j - window <= p_i of best(i) + p_i,

a sliding-window minimum kept in a monotone queue: every cut enters and leaves it
once. Exact powers of two are a few more transitions to known positions.

The stream is solved in blocks of about a million ids so that memory is bounded; a
block ends at its cheapest window end and the rest goes to the next block. Only the
last window of each partition has no choice. There is no shuffle.

Nulls: a null text is empty (only the end id); a null doc_id is kept. Repeated rows are
separate documents. Very long texts are whole in memory as ids, nothing more. An empty
table gives no pieces. Further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import prepare
from quire.llm.tokens import CACHE_WORDS, tokenizer

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 20
SENTENCE_PENALTY = 8.0     # for a window that ends inside a document, after a sentence
TRUNCATE_PENALTY = 64.0    # for one that ends inside a sentence
LONG_GAP = 256             # ids without a boundary after which steps may be cut
STEP = 32
SMALLEST_EXACT = 256       # shortest power of two that is used as a window of its own

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def cut_positions(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray,
                  window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, ascending, and the penalty of each."""
    sentences = np.flatnonzero(sentence_end[ids]) + 1
    at = np.union1d(sentences, doc_ends)
    penalty = np.full(len(at), SENTENCE_PENALTY)
    penalty[np.searchsorted(at, doc_ends)] = 0.0
    gaps = np.diff(at, prepend=0)
    step = min(STEP, window)
    steps = [np.arange(at[i] - gaps[i] + step, at[i], step)
             for i in np.flatnonzero(gaps > min(LONG_GAP, window))]
    if steps:
        extra = np.concatenate(steps)
        at = np.concatenate([at, extra])
        penalty = np.concatenate([penalty, np.full(len(extra), TRUNCATE_PENALTY)])
        order = np.argsort(at, kind="stable")
        at, penalty = at[order], penalty[order]
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int, to_end: bool) -> list[int]:
    """Window ends of least cost. ``to_end``: the last window must end at the last
    position; else it ends where the cost is least within one window of it."""
    p = np.concatenate([[0], at])
    exact: dict[int, list[int]] = {}
    size = window // 2
    while size >= min(SMALLEST_EXACT, window // 2) and size:
        i = np.searchsorted(p, p - size)
        for j in np.flatnonzero((p >= size) & (p[i] == p - size)).tolist():
            exact.setdefault(j, []).append(int(i[j]))
        size //= 2
    pos, pen = p.tolist(), [0.0, *penalty.tolist()]
    cost, back, reach = [0.0] * len(pos), [0] * len(pos), [0.0] * len(pos)
    queue: deque[int] = deque([0])
    for j in range(1, len(pos)):
        here = pos[j]
        while here - pos[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        least = reach[i] + window - here
        for k in exact.get(j, ()):
            if cost[k] < least:
                least, i = cost[k], k
        cost[j], back[j] = least + pen[j], i
        reach[j] = r = cost[j] + here
        while queue and reach[queue[-1]] >= r:
            queue.pop()
        queue.append(j)
    j = len(pos) - 1
    if not to_end:
        near = [k for k in range(1, len(pos)) if pos[-1] - pos[k] <= window]
        j = min(near, key=lambda k: (cost[k], -k))
    ends = []
    while j:
        ends.append(pos[j])
        j = back[j]
    return ends[::-1]


class Packer:
    """Cuts one partition's stream; ``add`` and ``finish`` return columns of pieces."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW,
                 block_tokens: int = BLOCK_TOKENS):
        self.sentence_end, self.window, self.block_tokens = sentence_end, window, block_tokens
        self.sequence = first_sequence
        self.docs: list[list] = []      # doc_id, ids left, ids before them, ids of the document
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append([doc_id, ids, 0, len(ids)])
        self.held += len(ids)
        return self._solve(False) if self.held >= self.block_tokens else []

    def finish(self) -> list[tuple]:
        return self._solve(True) if self.held else []

    def _solve(self, last: bool) -> list[tuple]:
        ids = np.concatenate([d[1] for d in self.docs])
        doc_ends = np.cumsum([len(d[1]) for d in self.docs])
        doc_starts = doc_ends - np.array([len(d[1]) for d in self.docs])
        ends = np.array(best_cuts(*cut_positions(ids, doc_ends, self.sentence_end, self.window),
                                  self.window, last), dtype=np.int64)
        done = int(ends[-1])
        starts = np.union1d(doc_starts[doc_starts < done], np.concatenate([[0], ends[:-1]]))
        stops = np.append(starts[1:], done)
        doc_of = np.searchsorted(doc_starts, starts, side="right") - 1
        window_of = np.searchsorted(ends, starts, side="right")
        opened = np.concatenate([[0], ends[:-1]])[window_of]
        raw = np.ascontiguousarray(ids, dtype="<u4")
        out = []
        for a, b, d, w, o in zip(starts.tolist(), stops.tolist(), doc_of.tolist(),
                                 window_of.tolist(), opened.tolist()):
            doc = self.docs[d]
            out.append((doc[0], doc[2] + a - int(doc_starts[d]), b - a, zlib.crc32(raw[a:b]),
                        doc[3], self.sequence + w, a - o, raw[a:b]))
        self.sequence += len(ends)
        left = []
        for d, s, e in zip(self.docs, doc_starts.tolist(), doc_ends.tolist()):
            if e > done:
                used = max(0, done - s)
                left.append([d[0], d[1][used:], d[2] + used, d[3]])
        self.docs, self.held = left, len(ids) - done
        return out


@functools.cache
def sentence_end_table(vocabulary: str, cache_words: int = CACHE_WORDS) -> np.ndarray:
    """For each id, whether its text ends a sentence or a line; once a worker."""
    tok = tokenizer(vocabulary, cache_words).tok
    table = np.zeros(max(tok.get_vocab_size(), END_ID + 1), dtype=bool)
    for i in range(tok.get_vocab_size()):
        text = tok.decode([i], skip_special_tokens=False)
        table[i] = text.rstrip(" \"')").endswith((".", "!", "?", "\n"))
    return table


def pack_documents(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID,
                   with_ids: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces of all documents: which ids of which document lie where in which
    sequence; ``with_ids`` adds the ids themselves. A worker keeps the ids of at most
    ``cache_words`` words; the result does not depend on it."""
    prepare(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")] + (["ids"] if with_ids else [])
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int32())] if with_ids else [])

    def batch(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces))[:len(names)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        words = tokenizer(vocabulary, cache_words)
        packer = Packer(sentence_end_table(vocabulary, cache_words), TaskContext.get().partitionId() << 32, window)
        tail = np.array([end_id], np.uint32)
        for b in batches:
            keys = b.column(0).to_pylist()
            for i in range(0, len(keys), 256):
                texts = b.column(1).slice(i, 256).to_pylist()
                for key, ids in zip(keys[i:i + 256], words.encode_many(texts)):
                    if pieces := packer.add(key, np.concatenate([ids, tail])):
                        yield batch(pieces)
        if pieces := packer.finish():
            yield batch(pieces)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
