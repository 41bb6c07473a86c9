"""Feature collections cut up by byte ranges, against a JSON parser and the multi-line reader."""

import contextlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from beatwise.sources import features as f
from beatwise.sources import read_feature_docs

SCHEMA = StructType([StructField("type", StringType()), StructField("properties", StructType([
    StructField("ZCTA20", StringType()), StructField("POP20", LongType()), StructField("NOTE", StringType())]))])
NASTY = ['plain', '{', '}', '}{"features":[{', '\\', '\\\\"}', 'é}ü{', '"features": [{"type": 1}]', '\\"', ']}', '']


def collection(n, seed, indent=None):
    rng = random.Random(seed)
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "}{", "features": [{"no": 1}]}},
           "other": [{"not": "a feature"}, [1, {"x": []}]], "features": [], "bbox": [1, [2, 3]], "more": {"features": [{"no": 2}]}}
    for i in range(n):
        doc["features"].append({"type": rng.choice(NASTY), "geometry": {"type": "Polygon", "coordinates": [[[i, 1], [2, {"a": 3}]]]},
                                "properties": {"ZCTA20": str(i), "POP20": i, "NOTE": rng.choice(NASTY) + rng.choice(NASTY)}})
    if seed % 2:
        doc["features"][1:1] = [None, 7, "}", [{"in": "an array"}], []]
    return json.dumps(doc, ensure_ascii=seed % 3 == 0, indent=indent)


def cut(text, ranges):
    """Features of a text whose records (between closing braces) are dealt into ranges, each in batches of at most 3."""
    records = text.encode().split(b"}")
    records = records if records[-1] else records[:-1]
    edges = [0, *sorted(ranges), len(records)]
    blocks = {}
    for b, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
        blocks[b] = [b"}".join(records[k:min(k + 3, j)]) + b"}" for k in range(i, j, 3)]
    effects = []
    for b, pieces in blocks.items():
        row = [0, b]
        for inside in (False, True):
            effect = (0, ())
            for data in pieces:
                piece = f.Piece(data, inside)
                inside, effect = piece.inside, f.joined(effect, piece.effect())
            row += [inside, effect[0], list(effect[1])]
        effects.append(tuple(row))
    state, out, carried = f.starts(effects), [], b""
    for b, pieces in blocks.items():
        cutter = f.Cutter(*state[0, b])
        for data in pieces:
            for found, own in cutter.feed(data):
                out.append(found if own else carried + found)
                carried = b"" if not own else carried
        if cutter.open is not None:
            carried = (b"" if cutter.own else carried) + b"".join(cutter.open)
    return [json.loads(x) for x in out]


def objects(text):
    return [x for x in json.loads(text)["features"] if isinstance(x, dict)]


@pytest.mark.parametrize("seed", range(4))
def test_one_border_anywhere(seed):
    text = collection(6, seed, indent=[None, 1][seed % 2])
    for at in range(text.count("}") + 1):
        assert cut(text, [at]) == objects(text)


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text('a{}[]"\\é'), lambda x: st.lists(x, max_size=3) | st.dictionaries(
    st.text('f{}"') | st.just("features"), x, max_size=3), max_leaves=12), st.lists(st.integers(0, 60), max_size=6), st.booleans())
def test_any_document_cut_anywhere(value, ranges, pretty):
    doc = {"a": value, "features": [{"v": value}, value, {"features": [value, {}]}], "b": [value]}
    text = json.dumps(doc, ensure_ascii=False, indent=2 if pretty else None)
    n = text.count("}")
    assert cut(text, [r % (n + 1) for r in ranges]) == objects(text)


_SIZES = {"maxPartitionBytes": "{}", "openCostInBytes": "{}", "minPartitionNum": "100000"}


@pytest.fixture
def small_ranges(spark):
    """Scans inside ``with small_ranges(n)`` are dealt out in ranges of ``n`` bytes."""
    @contextlib.contextmanager
    def held(most):
        for name, value in _SIZES.items():
            spark.conf.set(f"spark.sql.files.{name}", value.format(most))
        try:
            yield
        finally:
            for name in _SIZES:
                spark.conf.unset(f"spark.sql.files.{name}")

    return held


@pytest.mark.parametrize("most", [150, 700, 100_000])
def test_equals_the_multi_line_reader(spark, tmp_dir, small_ranges, most):
    for i in range(3):
        with open(f"{tmp_dir}/doc{i}.json", "w") as out:
            out.write(collection(12, 2 * i, indent=[None, 2, 0][i]) + "\n" * i)
    docs = StructType([StructField("features", ArrayType(SCHEMA))])
    want = read_feature_docs(spark, tmp_dir, docs).selectExpr("inline(features)").collect()
    with small_ranges(most):
        found = f.read_features(spark, tmp_dir, SCHEMA)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want)) and len(want) == 36


def test_a_document_is_read_by_many_tasks(spark, tmp_dir, small_ranges):
    with open(f"{tmp_dir}/doc.json", "w") as out:
        out.write(collection(400, 2))
    with small_ranges(4096):
        assert spark.read.option("lineSep", "}").text(tmp_dir).rdd.getNumPartitions() > 10
        found = f.split_features(spark, tmp_dir)
    assert found.count() == 400


def test_documents_without_features(spark, tmp_dir):
    for i, text in enumerate(["", "{}", "[]", '{"features": []}', '{"features": null}', '{"features": {"features": [{}]}}', "not json"]):
        with open(f"{tmp_dir}/{i}.json", "w") as out:
            out.write(text)
    assert f.read_features(spark, tmp_dir, SCHEMA).collect() == []
    with open(f"{tmp_dir}/two.json", "w") as out:
        out.write('{"features": [{"type": "a"}]}\n{"x": 1, "features": [{"type": "b"}, {"type": "c"}]}')
    assert sorted(r["type"] for r in f.read_features(spark, tmp_dir, SCHEMA).collect()) == ["a", "b", "c"]
