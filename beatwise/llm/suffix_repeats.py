"""Suffix-array dedup of bytes with a hash-compared suffix sort.

A byte goes if a string of ``length`` bytes that covers it also starts in an
earlier document.  Every such string belongs to one anchor, the smallest
hashed ``GRAM``-byte substring in it, which follows from the string alone.

1. Each chunk asks which of its anchors another document also holds.
2. For shared anchors it sends the anchor's context: the bytes of all strings
   that belong to it, once per distinct context.  The anchor's bucket sorts
   the suffixes at which those strings start: a mergesort whose comparisons
   find the common extension of two suffixes by binary search over prefix
   polynomial hashes and then compare one byte.  Neighbours whose common
   extension reaches ``length`` are verified byte by byte.  Each class of equal
   strings gets its smallest document id, each string one answer bit.
3. The chunk reads the bits off and cuts.

A context that all holders of an anchor share needs no sort.  Strings can only
be equal if their anchor lies at the same offset, so the sort runs within
(anchor, offset) and its runs stay short.

Defined results: null and empty text have no bytes; texts shorter than
``length`` lose nothing; repeated rows (the same id) do not count as earlier
for each other; a null id is neither smaller nor larger than another, so such
rows lose nothing and take nothing from others; strings never cross documents
and are judged on the input.
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

LENGTH, GRAM = 50, 24


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach:]) if width > reach else x


class ByteChunk:
    """Anchors of a chunk's texts: runs of window starts that share one anchor."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        self.texts, self.length = Texts(table), length
        t = self.texts
        none = np.zeros(0, np.int64)
        self.start, self.stop, self.anchor, self.key = none, none, none, np.zeros(0, np.uint64)
        self.rolling = Rolling(BYTE_VALUES[t.data], BASES[0])
        if len(t.data) >= length:
            grams = self.rolling.windows(gram)
            # the upper hash half decides, of equal ones the leftmost
            packed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            least = sliding_minimum(packed, length - gram + 1).astype(np.uint32)
            del packed
            inside = np.ones(len(least), bool)  # windows that do not cross into the next text
            for a, b in zip(np.maximum(t.last - length + 1, t.first).tolist(), t.last.tolist(), strict=True):
                inside[a:b] = False
            at = np.flatnonzero(inside)
            if len(at):
                anchor = least[at].astype(np.int64)
                del least, inside
                new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)))
                first = np.flatnonzero(new)
                self.start, self.anchor = at[first], anchor[first]
                self.stop = np.append(at[first[1:] - 1], at[-1]) + 1  # one behind the last window start
                # minima are small by choice: mixed again, they spread over the buckets
                self.key = mix(grams[self.anchor] ^ np.uint64(BASES[1]))
        self.doc = t.owner(self.start)
        self.rank = t.rank[self.doc] if len(self.start) else none
        self.order = np.argsort(self.key, kind="stable")
        sorted_keys = self.key[self.order]
        self.runs = groups_of(sorted_keys)
        self.keys = sorted_keys[self.runs]

    def several(self) -> np.ndarray:
        """Anchors that two ids hold here."""
        if not len(self.runs):
            return np.zeros(0, bool)
        rank = self.rank[self.order]
        return np.minimum.reduceat(rank, self.runs) != np.maximum.reduceat(rank, self.runs)

    def contexts(self, shared: np.ndarray) -> None:
        """Distinct contexts of shared anchors, in key order, with the smallest id that has each here."""
        picked = self.order[np.repeat(shared, np.diff(np.append(self.runs, len(self.order))))]
        size = self.stop[picked] - self.start[picked] + self.length - 1
        whole = mix(self.rolling.raw(self.start[picked], size) + size.astype(np.uint64))
        second = Rolling(BYTE_VALUES[self.texts.data], BASES[1])
        other = mix(second.raw(self.start[picked], size) + (self.anchor[picked] - self.start[picked]).astype(np.uint64))
        order = np.lexsort((other, whole, self.key[picked]))
        self.picked = picked[order]
        self.c_runs = groups_of(np.rec.fromarrays([self.key[picked][order], whole[order], other[order]]))
        own = self.picked[self.c_runs]
        self.c_own, self.c_key = own, self.key[own]
        self.c_windows = self.stop[own] - self.start[own]
        self.c_least = np.minimum.reduceat(self.rank[self.picked], self.c_runs) if len(own) else self.rank[own]

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """Bytes covered by a string that an earlier document has; ``earlier`` has a bit per window of each context."""
        size = np.diff(np.append(self.c_runs, len(self.picked)))
        context = np.repeat(np.arange(len(self.c_own)), size)
        count = self.c_windows[context]
        behind = np.cumsum(count) - count
        inner = np.arange(count.sum()) - np.repeat(behind, count)
        bit_from = (np.cumsum(self.c_windows) - self.c_windows)[context]
        rank = self.rank[self.picked]
        gone = earlier[np.repeat(bit_from, count) + inner] | np.repeat(self.c_least[context] < rank, count)
        gone &= np.repeat(rank != NO_ID, count)
        at = (np.repeat(self.start[self.picked], count) + inner)[gone]
        step = np.bincount(at, minlength=len(self.texts.data) + 1)[: len(self.texts.data) + 1].astype(np.int64)
        step -= np.bincount(at + self.length, minlength=len(self.texts.data) + 1)[: len(self.texts.data) + 1]
        return np.cumsum(step)[:-1] > 0


def _send_anchors(chunk: int, part: ByteChunk, n_buckets: int) -> pa.Table:
    low = part.keys.astype("<u4")
    high = ((part.keys >> np.uint64(32)).astype(np.uint8) & 127) | part.several().astype(np.uint8) << 7
    return asked(bucket_cuts(part.keys, n_buckets), chunk, lambda a, b: low[a:b].tobytes() + high[a:b].tobytes())


def _match_anchors(bodies: list[bytes]) -> list[np.ndarray]:
    """Anchors that two documents hold."""
    sizes = [len(b) // 5 for b in bodies]
    low = np.concatenate([np.frombuffer(b, "<u4", n) for b, n in zip(bodies, sizes, strict=True)]).astype(np.int64)
    high = np.concatenate([np.frombuffer(b, np.uint8, n, 4 * n) for b, n in zip(bodies, sizes, strict=True)])
    key = low | (high & 127).astype(np.int64) << 32
    order = np.argsort(key, kind="stable")
    runs = groups_of(key[order])
    count = np.diff(np.append(runs, len(key)))
    good = (count > 1) | (np.bitwise_or.reduceat(high[order], runs) & 128 > 0)
    bits = np.zeros(len(key), bool)
    bits[order] = np.repeat(good, count)
    return np.split(bits, np.cumsum(sizes)[:-1])


def _send_contexts(chunk: int, part: ByteChunk, n_buckets: int) -> pa.Table:
    size = part.c_windows + part.length - 1
    key, least = part.c_key.astype("<u8"), part.c_least.astype("<i8")
    offset = (part.anchor[part.c_own] - part.start[part.c_own]).astype(np.uint8)
    begin, data = part.start[part.c_own], part.texts.data

    def body(a: int, b: int) -> bytes:
        n = size[a:b]
        spots = np.repeat(begin[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())
        ids, index = np.unique(least[a:b], return_inverse=True)
        return struct.pack("<II", b - a, len(ids)) + b"".join(x.tobytes() for x in (
            ids, key[a:b], index.astype("<u4"), n.astype(np.uint8), offset[a:b], data[spots]))

    return asked(bucket_cuts(part.c_key, n_buckets), chunk, body)


class SuffixOrder:
    """Suffixes of ``data`` compared on their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        rolling = Rolling(BYTE_VALUES[data], BASES[1])
        self.sums, self.back = rolling.sums, rolling.back

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common bytes of suffixes x and y, up to ``length``: binary search over substring hashes."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        sx, sy, bx, by = self.sums[x], self.sums[y], self.back[x], self.back[y]
        for _ in range(int(self.length).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[x + middle] - sx) * bx == (self.sums[y + middle] - sy) * by
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
            high = np.maximum(low, high)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before y (or is equal, where ``or_equal``)."""
        common = self.extension(x, y)
        inside = np.minimum(common, self.length - 1)
        a, b = self.data[x + inside], self.data[y + inside]
        return np.where(common >= self.length, or_equal, a < b)

    def sort(self, spots: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of ``spots`` by (group, suffix); ``group`` is sorted.  Bottom-up mergesort, all groups at once.

        In a merge every suffix finds its place by binary search in the
        sibling run, so all comparisons of a step are array operations.
        """
        order = np.arange(len(spots))
        first = groups_of(group)
        size = np.diff(np.append(first, len(group)))
        begin, room = np.repeat(first, size), np.repeat(size, size)
        place = np.arange(len(spots)) - begin
        width = 1
        while width < (size.max() if len(size) else 0):
            live = np.flatnonzero(room > width)
            run = place[live] // width
            own = run * width
            sibling = np.minimum((run ^ 1) * width, room[live])
            low = begin[live] + sibling
            bottom, high = low.copy(), begin[live] + np.minimum(sibling + width, room[live])
            left = run % 2 == 0
            mine = spots[order[live]]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                # left runs go before equal suffixes of right ones, so the merge is stable
                other_first = self.before(spots[order[middle]], mine[open_], ~left[open_])
                low[open_] = np.where(other_first, middle + 1, low[open_])
                high[open_] = np.where(other_first, high[open_], middle)
            target = begin[live] + np.minimum(own, sibling) + (place[live] - own) + (low - bottom)
            merged = order.copy()
            merged[target] = order[live]
            order = merged
            width *= 2
        return order

    def equal_neighbours(self, spots: np.ndarray) -> np.ndarray:
        """Whether each spot's string equals the one before: by hash, then verified byte by byte."""
        same = np.zeros(len(spots), bool)
        if len(spots) > 1:
            near = np.flatnonzero(self.extension(spots[1:], spots[:-1]) >= self.length) + 1
            for at in range(0, len(near), 1 << 16):
                part = near[at:at + (1 << 16)]
                span = np.arange(self.length)
                same[part] = (self.data[spots[part][:, None] + span] == self.data[spots[part - 1][:, None] + span]).all(axis=1)
        return same


def _unpack(bodies: list[bytes]) -> tuple[np.ndarray, ...]:
    keys, ranks, sizes, offsets, data, counts = [], [], [], [], [], []
    for b in bodies:
        n, m = struct.unpack_from("<II", b)
        at = 8
        ids = np.frombuffer(b, "<i8", m, at)
        at += 8 * m
        keys.append(np.frombuffer(b, "<u8", n, at))
        ranks.append(ids[np.frombuffer(b, "<u4", n, at + 8 * n)])
        sizes.append(np.frombuffer(b, np.uint8, n, at + 12 * n))
        offsets.append(np.frombuffer(b, np.uint8, n, at + 13 * n))
        data.append(np.frombuffer(b, np.uint8, offset=at + 14 * n))
        counts.append(n)
    key, rank, size, offset, flat = map(np.concatenate, (keys, ranks, sizes, offsets, data))
    return key, rank, size.astype(np.int64), offset.astype(np.int64), flat, np.array(counts)


def _least_strings(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For every window of every context: whether a smaller id of another chunk has that string."""
    key, rank, size, offset, data, counts = _unpack(bodies)
    begin = np.cumsum(size) - size
    hashed = Rolling(BYTE_VALUES[data], BASES[0])
    whole = hashed.raw(begin, size)
    order = np.lexsort((whole, size, offset, key))
    # equal contexts: same key, offset, size and hash as the one before, verified byte by byte
    a, b = order[1:], order[:-1]
    alike = (key[a] == key[b]) & (offset[a] == offset[b]) & (size[a] == size[b]) & (whole[a] == whole[b])
    near = np.flatnonzero(alike)
    for at in range(0, len(near), 1 << 15):
        part = near[at:at + (1 << 15)]
        n = size[a[part]]
        span = np.arange(n.max() if len(n) else 0)
        clip = np.minimum(span, n[:, None] - 1)
        alike[part] = (data[begin[a[part]][:, None] + clip] == data[begin[b[part]][:, None] + clip]).all(axis=1)
    runs = np.flatnonzero(np.concatenate(([True], ~alike)))
    member = np.empty(len(order), np.int64)
    member[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(order))))
    own = order[runs]  # one entry of each distinct context
    least = np.minimum.reduceat(rank[order], runs)
    windows = size[own] - length + 1
    at_window = np.cumsum(windows) - windows
    best = np.repeat(least, windows)
    # anchors with several contexts: sort the suffixes at which their strings start
    _, back, held = np.unique(key[own], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(held[back] > 1)
    if len(mixed):
        n = windows[mixed]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        spots = np.repeat(begin[own[mixed]], n) + inner
        window = np.repeat(at_window[mixed], n) + inner
        # a string's anchor lies at (offset in the context) - (start in the context)
        shift = np.repeat(offset[own[mixed]], n) - inner
        group = np.repeat(back[mixed], n) * 256 + shift
        first = np.argsort(group, kind="stable")
        spots, window, group = spots[first], window[first], group[first]
        suffixes = SuffixOrder(data, length)
        sort = suffixes.sort(spots, group)
        spots, window = spots[sort], window[sort]
        same = suffixes.equal_neighbours(spots) & np.concatenate(([False], group[1:] == group[:-1]))
        classes = np.flatnonzero(~same)
        best[window] = np.repeat(np.minimum.reduceat(best[window], classes), np.diff(np.append(classes, len(spots))))
    # back to the entries, in the order they were sent
    n = windows[member]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    bits = best[np.repeat(at_window[member], n) + inner] < np.repeat(rank, n)
    per_body = np.add.reduceat(n, np.cumsum(counts) - counts)
    return np.split(bits, np.cumsum(per_body)[:-1])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``n_bytes``, ``spans`` of removed bytes and ``kept`` (binary).

    One lazy plan: the texts are shuffled once and read three times.
    """
    if not 1 <= gram <= length or 2 * length - gram > 255:
        raise ValueError("need 1 <= gram <= length and contexts of at most 255 bytes")
    row_type = df.select(F.struct(*keep or ["*"]).alias("row")).schema["row"].dataType
    chunks, n = deal(df, F.struct(*keep or ["*"]), F.col(id_col), F.col(text), text)
    by_chunk = chunks.groupBy("chunk")

    def probe(table: pa.Table) -> pa.Table:
        return _send_anchors(table["chunk"][0].as_py(), ByteChunk(table, length, gram), n)

    def shared(table: pa.Table, replies: pa.Table) -> ByteChunk:
        part = ByteChunk(table, length, gram)
        part.contexts(bits_of(replies, 1, bucket_cuts(part.keys, n)))
        return part

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _send_contexts(table["chunk"][0].as_py(), shared(table, replies), n)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        part = shared(table, replies)
        cuts = bucket_cuts(part.c_key, n)
        sizes = np.add.reduceat(part.c_windows, cuts[1][:-1]) if len(cuts[0]) else None
        gone = part.removed(bits_of(replies, 2, cuts, sizes))
        t = part.texts
        spans, kept = [], []
        for a, b in zip(t.first.tolist(), t.last.tolist(), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:b].view(np.int8), [0])))).reshape(-1, 2)
            spans.append([{"start": x, "end": y} for x, y in edges.tolist()])
            kept.append(t.data[a:b][~gone[a:b]].tobytes())
        rows = table["row"].combine_chunks().take(pa.array(t.rows, pa.int64()))
        return pa.table({"row": rows, "n_bytes": pa.array(t.last - t.first, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                         "kept": pa.array(kept, pa.binary())})

    result = StructType([StructField("row", row_type), *StructType.fromDDL(
        "n_bytes bigint, spans array<struct<start:int,end:int>>, kept binary").fields])
    first = answer(by_chunk.applyInArrow(probe, ASK_TYPE), 1, _match_anchors)
    second = answer(by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(send, ASK_TYPE), 2,
                    lambda bodies: _least_strings(bodies, length))
    return by_chunk.cogroup(first.union(second).groupBy("chunk")).applyInArrow(cut, result)
