"""One feature collection of any size, read by many tasks.

A JSON document is one record to Spark's readers, so one task.  Here the file
is scanned as text records that end in ``}``, which Spark deals out by byte
ranges, whatever store the file is in.  A range does not know whether it starts
inside a string, nor in which arrays and objects.  So the file is read twice:

1. every range says, for both cases (starting outside or inside a string),
   whether it ends inside one, how many open containers it closes and which it
   opens; put together in file order these give the state at each start;
2. every range cuts out its features with that state; a feature that crosses
   ranges leaves a part in each, and the parts are joined.

A feature is an object that is an element of the array ``features`` of a root
object.  Braces, brackets and quotes inside strings and after backslashes do
not count; several documents in one file, one after the other, are fine;
elements that are no objects are left out.  A text with broken quoting or
nesting gives undefined features, but no failure.
"""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatwise.session import write_staged
from beatwise.sources.ranges import BEGINS, FOUND, GOES_ON, WHOLE, by_range, found_batch, ranged_records, same_ranges, start_of, stitched

#: The array whose elements are features.
ARRAY = "features"
#: What stands before a container: its key, if it has one.
_KEY = re.compile(rb'("(?:[^"\\]|\\.)*")[ \t\r\n]*:[ \t\r\n]*$')
#: Bytes before a container in which its key is looked for.
_KEY_BYTES = 256
#: An open container is an object, an array called ``features``, or another array.
OBJECT, FEATURES, OTHER = 0, 1, 2
Stack = tuple[int, ...]


class Piece:
    """Structure of some bytes, given whether they start inside a string."""

    def __init__(self, data: bytes, inside: bool):
        a = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(a == ord('"'))
        slashes = np.flatnonzero(a == ord("\\"))
        if len(slashes):  # a run of odd length escapes what follows it
            ends = np.flatnonzero(np.diff(slashes, append=len(a) + 1) > 1)
            odd = np.diff(ends, prepend=-1) % 2 == 1
            quotes = np.setdiff1d(quotes, slashes[ends[odd]] + 1, assume_unique=True)
        self.inside = bool((inside + len(quotes)) % 2)
        at = np.flatnonzero((a == ord("{")) | (a == ord("}")) | (a == ord("[")) | (a == ord("]")))
        self.at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
        kind = a[self.at]
        self.object = (kind == ord("{")) | (kind == ord("}"))
        self.opens = (kind == ord("{")) | (kind == ord("["))
        #: Depth after each bracket, from 0 at the start.
        self.depth = np.cumsum(np.where(self.opens, 1, -1))
        self.data = data

    def container(self, k: int) -> int:
        """What the bracket ``k`` opens."""
        if self.object[k]:
            return OBJECT
        at = int(self.at[k])
        if key := _KEY.search(self.data[max(0, at - _KEY_BYTES):at]):
            with contextlib.suppress(ValueError):
                return FEATURES if json.loads(key[1]) == ARRAY else OTHER
        return OTHER

    def effect(self) -> tuple[int, Stack]:
        """Containers closed that were open before, and those left open, outermost first."""
        if not len(self.depth):
            return 0, ()
        low = min(0, int(self.depth.min()))
        still = []
        for level in range(low + 1, int(self.depth[-1]) + 1):
            still.append(self.container(int(np.flatnonzero(self.opens & (self.depth == level))[-1])))
        return -low, tuple(still)


def after(stack: Stack, effect: tuple[int, Stack]) -> Stack:
    """Open containers after an effect."""
    closed, opened = effect
    return stack[:max(0, len(stack) - closed)] + opened


def joined(first: tuple[int, Stack], second: tuple[int, Stack]) -> tuple[int, Stack]:
    """One effect after another."""
    kept = first[1][:max(0, len(first[1]) - second[0])]
    return first[0] + max(0, second[0] - len(first[1])), kept + second[1]


class Cutter:
    """Cuts features out of a range, piece by piece, from the state at its start."""

    def __init__(self, inside: bool, stack: Stack):
        self.inside, self.stack = inside, stack
        #: Bytes of the feature that is open, and whether it began in this range.
        self.open: list[bytes] | None = [] if self._within() else None
        self.own = False

    def _within(self) -> bool:
        return self.stack[1:3] == (FEATURES, OBJECT)

    def feed(self, data: bytes) -> Iterator[tuple[bytes, bool]]:
        """``(bytes, began here)`` of every feature that ends in ``data``."""
        piece = Piece(data, self.inside)
        depth = piece.depth + len(self.stack)
        level_two = np.flatnonzero(piece.opens & (depth == 2))
        known = np.array([self.stack[1:2] == (FEATURES,), *(piece.container(int(k)) == FEATURES for k in level_two)])
        border = np.flatnonzero(piece.object & np.where(piece.opens, depth == 3, depth == 2))
        border = border[known[np.searchsorted(level_two, border, side="right")]]
        begin = 0
        for k, opens in zip(piece.at[border].tolist(), piece.opens[border].tolist(), strict=True):
            if opens:
                self.open, self.own, begin = [], True, k
            elif self.open is not None:
                yield b"".join(self.open) + data[begin:k + 1], self.own
                self.open = None
        if self.open is not None:
            self.open.append(data[begin:])
        self.stack = after(self.stack, piece.effect())
        self.inside = piece.inside


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bytes]]:
    """``((file, block), bytes)`` in file order; a record's closing brace is put back."""
    for key, values in by_range(batches):
        yield key, b"}".join(values.cast(pa.binary()).to_pylist()) + b"}"


_EFFECT = "file bigint, block bigint, inside0 boolean, closed0 int, opened0 array<int>, inside1 boolean, closed1 int, opened1 array<int>"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: what it does to either state."""
    kept: dict[tuple[int, int], list] = {}
    for key, data in _pieces(batches):
        state = kept.setdefault(key, [[False, (0, ())], [True, (0, ())]])
        for case in state:
            piece = Piece(data, case[0])
            case[0], case[1] = piece.inside, joined(case[1], piece.effect())
    rows = [(*key, *(x for inside, (closed, opened) in cases for x in (inside, closed, list(opened))))
            for key, cases in kept.items()]
    if rows:
        names = [c.split()[0] for c in _EFFECT.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.bool_(), pa.int32(), pa.list_(pa.int32())] * 2]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def starts(effects: list[tuple]) -> dict[tuple[int, int], tuple[bool, Stack]]:
    """State at the start of every range, from the effects of all (one small row per range)."""
    found, file, inside, stack = {}, None, False, ()
    for row in sorted(effects, key=lambda r: (r[0], r[1])):
        if row[0] != file:
            file, inside, stack = row[0], False, ()
        found[row[0], row[1]] = inside, stack
        inside, closed, opened = row[5:8] if inside else row[2:5]
        stack = after(stack, (closed, tuple(opened)))
    return found


def split_features(spark: SparkSession, path: str) -> DataFrame:
    """``feature``: the JSON text of every feature of the collections at ``path``, in a staged table.

    ``path`` is anything Spark's text reader takes; files that are compressed
    as a whole are one range each.
    """
    records = ranged_records(spark, path, "}")
    with same_ranges(spark):
        state = spark.sparkContext.broadcast(starts([tuple(r) for r in records.mapInArrow(_effects, _EFFECT).collect()]))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cutters: dict[tuple[int, int], Cutter] = {}
            for key, data in _pieces(batches):
                if key not in cutters:
                    cutters[key] = Cutter(*start_of(state.value, key))
                if found := list(cutters[key].feed(data)):
                    yield found_batch(key, [WHOLE if own else GOES_ON for _, own in found], [text for text, _ in found])
            for key, cutter in cutters.items():  # a feature that goes on in the next range
                if cutter.open is not None:
                    yield found_batch(key, [BEGINS if cutter.own else GOES_ON], [b"".join(cutter.open)])

        found = write_staged(records.mapInArrow(cut, FOUND), "features")
    return stitched(found, "feature")


def read_features(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Features of the collections at ``path`` as columns, parsed with ``schema`` (of a feature) by as many tasks as read them."""
    return split_features(spark, path).select(F.from_json("feature", schema).alias("f")).select("f.*")
