"""CSV records with quoted line breaks, from a text scan by many tasks.

A line may lie inside a quoted field that an earlier line opened, maybe in
another byte range.  A range starts at a line, so either at a record or inside
a quoted field; it says where it ends for both cases, these are put together in
file order, and a second scan joins lines to records (``ranges``).  Fields are
then parsed by Spark's own CSV functions.

The quoting rules are those of Spark's CSV reader: a field is quoted if the
quote is its first character; inside, the escape character takes the next one
along (as the quote itself, ``escape='"'``, a doubled quote); what follows a
closing quote up to the separator is part of the field.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatwise.session import write_staged
from beatwise.sources.ranges import (
    BEGINS, FOUND, GOES_ON, WHOLE, by_range, found_batch, ranged_records, same_ranges, start_of, stitched,
)


class Quoting:
    """Whether a line ends inside a quoted field."""

    def __init__(self, sep: str = ",", quote: str = '"', escape: str = "\\"):
        s, q, e = (re.escape(c.encode()) for c in (sep, quote, escape))
        inner = b"(?:[^%b]|%b%b)*+" % (q, q, q) if quote == escape else b"(?:[^%b%b]|%b.)*+" % (q, e, e)
        rest = b"%b[^%b]*+" % (q, s)  # from the closing quote to the separator
        field = b"(?:%b%b%b|(?!%b)[^%b]*+)" % (q, inner, rest, q, s)
        self._from_start = re.compile(b"%b(?:%b%b)*+" % (field, s, field), re.DOTALL)
        self._from_inside = re.compile(b"%b%b(?:%b%b)*+" % (inner, rest, s, field), re.DOTALL)
        self.quote = quote

    def open_after(self, line: bytes, inside: bool) -> bool:
        return (self._from_inside if inside else self._from_start).fullmatch(line) is None


def changes_in(lines: pa.Array, inside: bool, quoting: Quoting) -> tuple[list[int], bool]:
    """Lines after which it is no longer as before whether a field is open; and whether one is at the end."""
    changes = []
    for i in pc.indices_nonzero(pc.match_substring(lines, quoting.quote)).to_pylist():
        if (now := quoting.open_after(lines[i].as_py().encode(), inside)) != inside:
            changes.append(i)
            inside = now
    return changes, inside


def spans_of(n: int, inside: bool, changes: list[int]) -> tuple[list[tuple[int, int]], bool]:
    """Spans of ``n`` lines that make a record each (the first may go on, the last be open), and whether the last is open."""
    spans, begin, at = [], 0, 0
    for change in changes:
        if inside:  # the field that opened in line begin closes in this one
            spans.append((begin, change + 1))
            at = change + 1
        else:
            spans += [(i, i + 1) for i in range(at, change)]
            begin = at = change
        inside = not inside
    spans += [(begin, n)] if inside else [(i, i + 1) for i in range(at, n)]
    return spans, inside


class Joiner:
    """Joins the lines of a range to records."""

    def __init__(self, quoting: Quoting, inside: bool):
        self.quoting, self.inside = quoting, inside
        #: Lines of the record that is open, and whether it began in this range.
        self.open: list[bytes] = []
        self.own = not inside

    def feed(self, lines: pa.Array) -> tuple[list[int], list[bytes] | pa.Array]:
        """Parts and texts of the records that end in ``lines``."""
        changes, inside = changes_in(lines, self.inside, self.quoting)
        if not changes and not inside:
            return [WHOLE] * len(lines), lines.cast(pa.binary())
        raw, parts, texts = lines.cast(pa.binary()).to_pylist(), [], []
        spans, _ = spans_of(len(raw), self.inside, changes)
        for k, (a, b) in enumerate(spans):
            self.open += raw[a:b]
            if k + 1 < len(spans) or not inside:
                parts.append(WHOLE if self.own else GOES_ON)
                texts.append(b"\n".join(self.open))
                self.open, self.own = [], True
        self.inside = inside
        return parts, texts

    def left(self) -> tuple[list[int], list[bytes]]:
        """The record that goes on in the next range."""
        if not self.inside:
            return [], []
        return [BEGINS if self.own else GOES_ON], [b"\n".join(self.open) + b"\n"]


def split_records(spark: SparkSession, paths: str | Sequence[str], sep: str = ",", quote: str = '"',
                  escape: str = "\\") -> DataFrame:
    """``record``: the text of every record of the CSV files, in a staged table."""
    quoting = Quoting(sep, quote, escape)
    lines = ranged_records(spark, paths, "\n")

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[int, int], list[bool]] = {}
        for key, values in by_range(batches):
            now = ends.setdefault(key, [False, True])
            now[:] = [changes_in(values, inside, quoting)[1] for inside in now]
        if ends:
            yield pa.RecordBatch.from_pydict({"file": [k[0] for k in ends], "block": [k[1] for k in ends],
                                              "start0": [v[0] for v in ends.values()], "start1": [v[1] for v in ends.values()]})

    with same_ranges(spark):
        rows = lines.mapInArrow(effects, "file bigint, block bigint, start0 boolean, start1 boolean").collect()
        states, file, inside = {}, None, False
        for r in sorted(rows):  # one small row per range
            inside = inside and r["file"] == file
            file = r["file"]
            states[file, r["block"]] = inside
            inside = r["start1"] if inside else r["start0"]
        known = spark.sparkContext.broadcast(states)

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            joiners: dict[tuple[int, int], Joiner] = {}
            for key, values in by_range(batches):
                if key not in joiners:
                    joiners[key] = Joiner(quoting, start_of(known.value, key))
                yield found_batch(key, *joiners[key].feed(values))
            for key, joiner in joiners.items():
                yield found_batch(key, *joiner.left())

        found = write_staged(lines.mapInArrow(join, FOUND), "records")
    return stitched(found, "record").select(F.regexp_replace("record", "\r$", "").alias("record"))


def read_csv_records(spark: SparkSession, paths: str | Sequence[str], schema: StructType, sep: str = ",",
                     quote: str = '"', escape: str = "\\", header: bool = True) -> DataFrame:
    """The table that Spark's ``multiLine`` CSV reader gives, but a file is read by many tasks.

    Empty lines are no records; with ``header`` records that are the column
    names are dropped.
    """
    options = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true"}
    ddl = lambda kind: ", ".join(f"`{x.name}` {kind or x.dataType.simpleString()}" for x in schema.fields)
    records = split_records(spark, paths, sep, quote, escape).filter("record <> ''")
    if header:
        names = F.struct(*[F.lit(n).alias(n) for n in schema.fieldNames()])
        records = records.filter(~F.from_csv("record", F.lit(ddl("string")), options).eqNullSafe(names))
    return records.select(F.from_csv("record", F.lit(ddl("")), options).alias("r")).select("r.*")
