"""Chunks of documents that ask hash buckets about their keys.

Documents are dealt to chunks of bounded bytes by a hash of id and text.  A
chunk sends each bucket the sorted distinct keys that fall to it, packed in one
row; the bucket sees the keys of all chunks and answers with one bit per key,
in the order they were sent.  The chunk works the same keys out again (they
follow from its texts alone) and reads the bits off.  So only packed keys and
bits travel besides the texts, a key that a third of all documents hold comes
once from each chunk, and every step is a plain shuffle that Spark can redo.

Hashes: prefix sums of byte (or word) values times powers of an odd base,
modulo 2^64, then a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, text_bytes

#: Text bytes a chunk holds, and those whose keys a bucket holds, on average (arrays take up to 100 times a chunk's bytes).
CHUNK_BYTES, BUCKET_BYTES = 1 << 20, 4 << 20
#: Powers are worked out for multiples of this many positions.
POWER_STEP = 1 << 18
ASK_TYPE = "bucket int, chunk int, body binary"
REPLY_TYPE = "chunk int, step int, bucket int, bits binary"
_REPLY = pa.schema([("chunk", pa.int32()), ("step", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
_ASK = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("body", pa.binary())])
#: Rank of rows without an id: it is never the smaller one, and the operators leave such rows whole.
NO_ID = np.iinfo(np.int64).max
#: Two odd bases and the mixer's constants.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixer of 64-bit values, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(31)
    return x


_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base modulo 2^64; a worker keeps the longest run it needed."""
    run = _kept_powers.get(base)
    if run is None or len(run) < n:
        run = np.full(-(-n // POWER_STEP) * POWER_STEP, base, np.uint64)
        run[0] = 1
        _kept_powers[base] = np.cumprod(run, out=run)
    return run[:n]


class Rolling:
    """Hash of any substring of ``values`` (uint64) in constant time."""

    def __init__(self, values: np.ndarray, base: int):
        self.back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.multiply(values, _powers(base, len(values) + 1)[:-1], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)

    def raw(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]

    def windows(self, length: int) -> np.ndarray:
        """Mixed hashes of all substrings of ``length`` values."""
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n]) if n else np.zeros(0, np.uint64)


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0])) | np.uint64(1)


class Texts:
    """Texts of a chunk laid end to end: ``data`` bytes, ``first`` and ``last`` of each row, its ``rank``."""

    def __init__(self, table: pa.Table):
        parts = [x or b"" for x in table["text"].to_pylist()]
        ids = table["id"].to_pylist()
        order = sorted(range(len(parts)), key=lambda i: (ids[i] is None, ids[i] or 0, parts[i]))
        self.rows = order
        parts = [parts[i] for i in order]
        size = np.array([len(p) for p in parts], np.int64)
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.last = np.cumsum(size)
        self.first = self.last - size
        self.rank = np.array([NO_ID if ids[i] is None else ids[i] for i in order], np.int64)

    def owner(self, spots: np.ndarray) -> np.ndarray:
        """Row of each byte position."""
        return np.searchsorted(self.first, spots, "right") - 1


def bucket_cuts(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets present and their slices in sorted 64-bit keys: buckets split the key range evenly."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return bucket[starts].astype(np.int64), np.append(starts, len(keys))


def groups_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def deal(df: DataFrame, row: Column, id_col: Column, text: Column, text_name: str) -> tuple[DataFrame, int]:
    """``(chunk, id, text, row)`` of every row, and the number of buckets, which follows the input's bytes."""
    size = text_bytes(df, text_name)
    n_chunks, n_buckets = (parts_for(df.sparkSession, size, x) for x in (CHUNK_BYTES, BUCKET_BYTES))
    body = F.coalesce(text, F.lit("")).cast("binary")
    ids = id_col.cast("long")
    return df.select(F.pmod(F.xxhash64(ids, body), F.lit(n_chunks)).cast("int").alias("chunk"),
                     ids.alias("id"), body.alias("text"), row.alias("row")), n_buckets


def asked(cuts: tuple[np.ndarray, np.ndarray], chunk: int, body: Callable[[int, int], bytes]) -> pa.Table:
    """One row per bucket, ``body(a, b)`` packing keys a to b."""
    buckets, at = cuts
    return pa.table([pa.array(buckets, pa.int32()), pa.array([chunk] * len(buckets), pa.int32()),
                     pa.array([body(a, b) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], schema=_ASK)


def bits_of(replies: pa.Table, step: int, cuts: tuple[np.ndarray, np.ndarray], sizes: np.ndarray | None = None) -> np.ndarray:
    """Answer bits of a step in key order; ``sizes`` are the bits of each bucket where keys have several."""
    buckets, at = cuts
    got = {}
    for s, b, bits in zip(*(replies[c].to_pylist() for c in ("step", "bucket", "bits")), strict=True):
        if s == step:
            got[b] = bits
    if set(got) != set(buckets.tolist()):  # every bucket answers; else an upstream step went wrong
        raise RuntimeError(f"step {step}: answers from {len(got)} of {len(buckets)} buckets")
    sizes = np.diff(at) if sizes is None else sizes
    found = [np.unpackbits(np.frombuffer(got[b], np.uint8), count=int(n)) for b, n in zip(buckets.tolist(), sizes, strict=True)]
    return np.concatenate(found).astype(bool) if found else np.zeros(0, bool)


def replied(table: pa.Table, step: int, bits: list[np.ndarray]) -> pa.Table:
    return pa.table([table["chunk"].cast(pa.int32()).combine_chunks(), pa.array([step] * table.num_rows, pa.int32()),
                     table["bucket"].cast(pa.int32()).combine_chunks(),
                     pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())], schema=_REPLY)


def answer(asks: DataFrame, step: int, decide: Callable[[list[bytes]], list[np.ndarray]]) -> DataFrame:
    """Each bucket's bits for the rows it got."""

    def run(table: pa.Table) -> pa.Table:
        # one order whatever the shuffle's: equal inputs give equal answers
        table = table.sort_by("chunk")
        return replied(table, step, decide(table["body"].to_pylist()))

    return asks.groupBy("bucket").applyInArrow(run, REPLY_TYPE)
