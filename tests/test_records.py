"""CSV records over several lines, against Spark's multi-line reader."""

import csv
import io
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StringType, StructField, StructType

from beatwise.sources import records as r
from tests.test_features import small_ranges  # noqa: F401

SCHEMA = StructType([StructField("id", LongType()), StructField("note", StringType()), StructField("TIME OCC", StringType())])
PIECES = ["plain", "two\nlines", "a, b", "\n", "\n\n", 'say "hi"\nand go', "tab\t", "é\nü", "x,\ny", ""]


def table(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(PIECES) + rng.choice(PIECES), rng.choice(["0600", "13\n00", "z"])) for i in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text('a",\n', max_size=5), min_size=1, max_size=3), min_size=1, max_size=6),
       st.lists(st.integers(0, 40), max_size=4))
def test_records_cut_anywhere(rows, cuts):
    """Doubled quotes: the standard library's writer and reader are the model."""
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    lines = out.getvalue().split("\n")[:-1]
    quoting, inside, found, carried = r.Quoting(escape='"'), False, [], b""
    edges = [0, *sorted(c % (len(lines) + 1) for c in cuts), len(lines)]
    for a, b in zip(edges, edges[1:], strict=False):
        if a == b:
            continue
        joiner = r.Joiner(quoting, inside)
        for k in range(a, b, 2):
            for part, text in zip(*joiner.feed(pa.array(lines[k:min(k + 2, b)])), strict=True):
                text = text if isinstance(text, bytes) else text.as_py()
                found.append(carried + text if part == r.GOES_ON else text)
                carried = b"" if part == r.GOES_ON else carried
        for part, text in zip(*joiner.left(), strict=True):
            carried = carried + text if part == r.GOES_ON else text
        ends = [r.changes_in(pa.array(lines[a:b]), start, quoting)[1] for start in (False, True)]
        assert ends[inside] == joiner.inside
        inside = joiner.inside
    assert not inside
    assert [next(csv.reader(io.StringIO(x.decode(), newline=""))) for x in found] == [list(x) for x in rows]


@pytest.mark.parametrize("most", [40, 500, 100_000])
def test_equals_the_multi_line_reader(spark, tmp_dir, small_ranges, most):  # noqa: F811
    for k in range(2):
        rows = spark.createDataFrame(table(60, k), SCHEMA)
        rows.coalesce(1).write.option("header", True).csv(f"{tmp_dir}/{k}")
    paths = [f"{tmp_dir}/0", f"{tmp_dir}/1"]
    want = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).csv(paths).collect()
    with small_ranges(most):
        assert most > 1000 or spark.read.text(paths).rdd.getNumPartitions() > 4
        found = r.read_csv_records(spark, paths, SCHEMA)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want)) and len(want) == 120


@pytest.mark.parametrize("escape", ["\\", '"'])
def test_odd_quoting_equals_the_multi_line_reader(spark, tmp_dir, small_ranges, escape):  # noqa: F811
    text = ('id,note,TIME OCC\n1,5" pipe,a\n2,"5\\" pipe\n, b",c\n\n3,"x"tail,d\n4," ""q"" \n ",e\n5, "no\n6,"",\n7,"a\\\\",b\n8,"\n\n",x\n'
            '"9","l\nm","n\no"\n10,\'a,b\'\n') if escape == "\\" else (
            'id,note,TIME OCC\n1,5" pipe,a\n2,"5"" pipe\n, b",c\n\n4," ""q"" \n ",e\n6,"",\n7,"a\\",b\n8,"\n\n",x\n"9","l\nm","n\no"\n')
    if escape == "\\":
        text = text.replace('4," ""q"" \n ",e\n', "")
    with open(f"{tmp_dir}/odd.csv", "w") as out:
        out.write(text)
    want = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", escape).csv(f"{tmp_dir}/odd.csv").collect()
    for most in (9, 10_000):
        with small_ranges(most):
            found = r.read_csv_records(spark, f"{tmp_dir}/odd.csv", SCHEMA, escape=escape)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want))


def test_carriage_returns_and_empty_files(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w", newline="") as out:
        out.write('id,note,TIME OCC\r\n1,"x\r\ny",0600\r\n2,z,1300\r\n')
    open(f"{tmp_dir}/b.csv", "w").close()
    want = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).csv(tmp_dir).collect()
    got = r.read_csv_records(spark, tmp_dir, SCHEMA).collect()
    assert [x["id"] for x in sorted(got)] == [1, 2] and sorted(x["TIME OCC"] for x in got) == sorted(x["TIME OCC"] for x in want)
    assert sorted(x["note"].replace("\r", "") for x in got) == sorted(x["note"].replace("\r", "") for x in want)
