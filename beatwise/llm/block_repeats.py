"""Substring dedup with fixed-block anchors.

Every text is cut into non-overlapping blocks of ``window // 2`` words, the
reference blocks; every rolling window of that length of every document probes
them.  A repeated ``window`` holds a whole reference block of either text at
any shift, so it lies around a hit.  Hits are extended to every window that
holds one, and windows that are equal word by word (a 96-bit key of the word
sequence) are compared by the smallest document id that has them: joined
windows are the maximal exact repeats.

Defined results:

* null or empty text: no words, empty kept text;
* texts shorter than the window lose nothing;
* repeated rows (the same id) do not count as earlier for each other; a null
  id is neither smaller nor larger than another, so such rows lose nothing
  and take nothing from others;
* repeats inside one document stay, unless an earlier document has them;
* windows are judged on the input, so order and partitions do not matter.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .chunks import (ASK_TYPE, BASES, BYTE_VALUES, NO_ID, Rolling, Texts, answer, asked, bits_of, bucket_cuts, deal,
                     groups_of, mix)

WINDOW = 50
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


class WordChunk:
    """Words of a chunk's texts with hashes, and the keys both steps ask about."""

    def __init__(self, table: pa.Table, window: int):
        self.texts, self.window, self.block = Texts(table), window, window // 2
        t = self.texts
        filled = ~_SPACE[t.data]
        edge = np.zeros(len(t.data) + 1, bool)
        edge[t.first] = edge[t.last] = True
        before = np.concatenate(([False], filled[:-1])) if len(filled) else filled
        after = np.concatenate((filled[1:], [False])) if len(filled) else filled
        self.start = np.flatnonzero(filled & (~before | edge[:-1]))
        self.end = np.flatnonzero(filled & (~after | edge[1:])) + 1
        self.doc = t.owner(self.start)
        self.count = np.bincount(self.doc, minlength=len(t.rank)) if len(t.rank) else np.zeros(0, np.int64)
        self.first_word = np.cumsum(self.count) - self.count
        hashed = Rolling(BYTE_VALUES[t.data], BASES[0])
        size = self.end - self.start
        word = mix(hashed.raw(self.start, size) + size.astype(np.uint64) * np.uint64(BASES[1]))
        self.rolling, self.second = Rolling(word, BASES[0]), word
        keys = self.rolling.windows(self.block)
        inside = self.doc[: len(keys)] == self.doc[self.block - 1:][: len(keys)]
        self.spot = np.flatnonzero(inside)
        keys = keys[self.spot]
        order = np.argsort(keys, kind="stable")
        self.order, keys = order, keys[order]
        self.runs = groups_of(keys)
        self.keys = keys[self.runs]

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct probe: held by two ids here, and a reference block here."""
        if not len(self.keys):
            return np.zeros(0, bool), np.zeros(0, bool)
        spot = self.spot[self.order]
        rank = self.texts.rank[self.doc[spot]]
        several = np.minimum.reduceat(rank, self.runs) != np.maximum.reduceat(rank, self.runs)
        block = (spot - self.first_word[self.doc[spot]]) % self.block == 0
        return several, np.logical_or.reduceat(block, self.runs)

    def extended(self, shared: np.ndarray) -> None:
        """Keys of every window that holds a hit, with the smallest id that has each here."""
        hit = np.zeros(len(self.start) + 1, np.int64)
        hit[self.spot[self.order] + 1] = np.repeat(shared, np.diff(np.append(self.runs, len(self.order))))
        sums = np.cumsum(hit)
        n = max(0, len(self.start) - self.window + 1)
        at = np.arange(n)
        inside = self.doc[:n] == self.doc[self.window - 1:][:n]
        holds = sums[at + self.window - self.block + 1] > sums[at]
        self.at = np.flatnonzero(inside & holds)
        key = mix(self.rolling.raw(self.at, self.window))
        other = mix(Rolling(self.second, BASES[1]).raw(self.at, self.window)).astype(np.uint32)
        order = np.lexsort((other, key))
        both = np.rec.fromarrays([key[order], other[order]])
        self.w_order, self.w_runs = order, groups_of(both)
        self.w_key, self.w_other = key[order][self.w_runs], other[order][self.w_runs]
        rank = self.texts.rank[self.doc[self.at[order]]]
        self.w_least = np.minimum.reduceat(rank, self.w_runs) if len(rank) else rank

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """Words covered by a window that an earlier document has."""
        size = np.diff(np.append(self.w_runs, len(self.w_order)))
        at = self.at[self.w_order]
        rank = self.texts.rank[self.doc[at]]
        gone = (np.repeat(earlier, size) | (np.repeat(self.w_least, size) < rank)) & (rank != NO_ID)
        step = np.zeros(len(self.start) + 1, np.int64)
        np.add.at(step, at[gone], 1)
        np.add.at(step, at[gone] + self.window, -1)
        return np.cumsum(step)[:-1] > 0


def _send_probes(chunk: int, words: WordChunk, n_buckets: int) -> pa.Table:
    several, block = words.probes()
    low = words.keys.astype("<u4")
    high = ((words.keys >> np.uint64(32)).astype(np.uint8) & 63) | several.astype(np.uint8) << 6 | block.astype(np.uint8) << 7
    return asked(bucket_cuts(words.keys, n_buckets), chunk,
                 lambda a, b: low[a:b].tobytes() + high[a:b].tobytes())


def _match_blocks(bodies: list[bytes]) -> list[np.ndarray]:
    """Probes that hit a reference block and are held by two documents."""
    sizes = [len(b) // 5 for b in bodies]
    low = np.concatenate([np.frombuffer(b, "<u4", n) for b, n in zip(bodies, sizes, strict=True)]).astype(np.int64)
    high = np.concatenate([np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(bodies, sizes, strict=True)])
    key = low | (high & 63).astype(np.int64) << 32
    order = np.argsort(key, kind="stable")
    runs = groups_of(key[order])
    count = np.diff(np.append(runs, len(key)))
    flags = np.bitwise_or.reduceat(high[order], runs)
    good = ((count > 1) | (flags & 64 > 0)) & (flags & 128 > 0)
    bits = np.zeros(len(key), bool)
    bits[order] = np.repeat(good, count)
    return np.split(bits, np.cumsum(sizes)[:-1])


def _send_windows(chunk: int, words: WordChunk, n_buckets: int) -> pa.Table:
    key, other = words.w_key.astype("<u8"), words.w_other.astype("<u4")

    def body(a: int, b: int) -> bytes:
        ids, index = np.unique(words.w_least[a:b], return_inverse=True)
        index = index.astype("<u2" if len(ids) < 1 << 16 else "<u4")
        return struct.pack("<III", b - a, len(ids), index.itemsize) + b"".join(
            x.tobytes() for x in (ids.astype("<i8"), key[a:b], other[a:b], index))

    return asked(bucket_cuts(words.w_key, n_buckets), chunk, body)


def _least_ids(bodies: list[bytes]) -> list[np.ndarray]:
    """Windows that a smaller id of another chunk has."""
    keys, others, ranks = [], [], []
    for b in bodies:
        n, m, width = struct.unpack_from("<III", b)
        at = 12
        ids = np.frombuffer(b, "<i8", m, at)
        keys.append(np.frombuffer(b, "<u8", n, at + 8 * m))
        others.append(np.frombuffer(b, "<u4", n, at + 8 * m + 8 * n))
        ranks.append(ids[np.frombuffer(b, f"<u{width}", n, at + 8 * m + 12 * n)])
    key, other, rank = map(np.concatenate, (keys, others, ranks))
    order = np.lexsort((other, key))
    runs = groups_of(np.rec.fromarrays([key[order], other[order]]))
    least = np.minimum.reduceat(rank[order], runs)
    bits = np.zeros(len(key), bool)
    bits[order] = np.repeat(least, np.diff(np.append(runs, len(key)))) < rank[order]
    return np.split(bits, np.cumsum([len(k) for k in keys])[:-1])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``n_words``, ``spans`` of removed words and ``kept`` text.

    Kept words are joined by one space.  One lazy plan: the texts are
    shuffled once and read three times.
    """
    if window % 2 or window < 4:
        raise ValueError("window must be an even number of words, four at least")
    row_type = df.select(F.struct(*keep or ["*"]).alias("row")).schema["row"].dataType
    chunks, n = deal(df, F.struct(*keep or ["*"]), F.col(id_col), F.col(text), text)
    by_chunk = chunks.groupBy("chunk")

    def probe(table: pa.Table) -> pa.Table:
        return _send_probes(table["chunk"][0].as_py(), WordChunk(table, window), n)

    def hits(table: pa.Table, replies: pa.Table) -> WordChunk:
        words = WordChunk(table, window)
        words.extended(bits_of(replies, 1, bucket_cuts(words.keys, n)))
        return words

    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _send_windows(table["chunk"][0].as_py(), hits(table, replies), n)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        words = hits(table, replies)
        gone = words.removed(bits_of(replies, 2, bucket_cuts(words.w_key, n)))
        spans, kept = [], []
        data = words.texts.data.tobytes()
        for first, count in zip(words.first_word.tolist(), words.count.tolist(), strict=True):
            own = gone[first:first + count]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))).reshape(-1, 2)
            spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
            stay = np.flatnonzero(~own) + first
            kept.append(b" ".join([data[a:b] for a, b in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)]))
        rows = table["row"].combine_chunks().take(pa.array(words.texts.rows, pa.int64()))
        return pa.table({"row": rows, "n_words": pa.array(words.count, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         "kept": pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())})

    result = StructType([StructField("row", row_type), *StructType.fromDDL(
        "n_words bigint, spans array<struct<start:int,end:int>>, kept string").fields])
    first = answer(by_chunk.applyInArrow(probe, ASK_TYPE), 1, _match_blocks)
    second = answer(by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(extend, ASK_TYPE), 2, _least_ids)
    return by_chunk.cogroup(first.union(second).groupBy("chunk")).applyInArrow(cut, result)
