"""Centroid clustering, spelling variants and source mixing against plain Python."""

import random
import string
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from beatwise.llm import centroids, mixing, spellings

small = st.integers(-3, 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(small, min_size=5, max_size=5), min_size=1, max_size=12),
       st.lists(st.lists(small, min_size=5, max_size=5), min_size=1, max_size=30), st.sampled_from([1, 1000, 1 << 25]))
def test_outward_search_equals_brute_force(points, vectors, scale):
    points, vectors = np.array(points, np.int64) * scale, np.array(vectors, np.int64) * scale
    number, best = centroids.OutwardSearch(points).nearest(vectors)
    for v, n, b in zip(vectors.tolist(), number, best, strict=True):
        all_ = [sum((x - y) ** 2 for x, y in zip(v, p, strict=True)) for p in points.tolist()]
        assert b == min(all_) and n == all_.index(b)


def test_outward_search_skips_far_centroids():
    rng = np.random.default_rng(1)
    points = rng.integers(-9, 9, (40, 64)) + np.arange(40)[:, None] * 100
    vectors = points[rng.integers(0, 40, 500)] + rng.integers(-3, 3, (500, 64))
    search = centroids.OutwardSearch(points)
    search.nearest(vectors)
    assert search.measured < 2 * len(vectors)


def slow_clusters(vectors, first, rounds):
    now = [list(c) for c in first]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), i) for i, c in enumerate(now))
    for _ in range(rounds):
        members = {}
        for v in vectors:
            members.setdefault(near(v)[1], []).append(v)
        for c, own in members.items():
            now[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return sorted((i, d) for d, i in map(near, vectors))


@pytest.mark.parametrize("parts", [1, 7])
def test_clusters_equal_plain_rounds_in_any_partitioning(spark, parts):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-900, 900) / 256 for _ in range(4)]) for i in range(200)] + [(1, [1.0, 1.0, 1.0, 1.0])] * 150
    df = spark.createDataFrame(rows, "cluster int, v array<double>").repartition(parts)
    got = centroids.cluster(df, id_col="cluster", vector="v", dimensions=4, k=6, rounds=3, keep=["v"])
    assert got.columns == ["v", "cluster"]
    ints = [[int(256 * x // 1) for x in v] for _, v in rows]
    mark = spark.createDataFrame(rows, "id int, v array<double>").select(
        F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)).collect()
    first = [ints[i] for i in sorted(range(len(rows)), key=lambda i: (mark[i][0], ints[i]))[:6]]
    found = got.select("cluster.*").collect()
    assert sorted((r["number"], r["distance"]) for r in found) == slow_clusters(ints, first, 3)
    assert {r["total_inertia"] for r in found} == {sum(r["distance"] for r in found)}


def slow_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=19), min_size=1, max_size=8), st.integers(0, 1), st.randoms())
def test_one_edit(words, longer, rng):
    """Words of one length against words as long, or one longer, made from them and others."""
    size = len(words[0])
    a = [(w * 20)[:size] for w in words]
    b = []
    for w in a:
        at = rng.randrange(size + longer)
        b.append(w[:at] + rng.choice("abé") + w[at + 1 - longer:])
        b.append(("b" + w + "ab")[:size + longer])
        b.append(w[::-1] + "a" * longer)
    code = lambda own: np.frombuffer("".join(own).encode("latin-1"), np.uint8).reshape(len(own), -1)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a)), np.arange(len(b))))
    near = spellings.one_edit(spellings.machine_words(code(a)), i, spellings.machine_words(code(b)), j, bool(longer))
    assert {(x, y) for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True)} == {
        (x, y) for x in range(len(a)) for y in range(len(b)) if slow_near(a[x], b[y])}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 7), min_size=32, max_size=32), min_size=2, max_size=6), st.integers(0, 1), st.integers(0, 1))
def test_boxes_prune_by_summed_counts(rows, fewer, more):
    x = np.array(rows, np.uint8)
    low, high = np.minimum(x[0], x[1])[None], np.maximum(x[0], x[1])[None]
    x = np.concatenate((x, low, np.minimum(high + np.eye(32, dtype=np.uint8)[:3], 7), np.maximum(low, 1) - np.eye(32, dtype=np.uint8)[:3]))
    tree = spellings.BoxTree(spellings.packed_counts(low), spellings.packed_counts(high))
    row, _ = tree.reach(spellings.packed_counts(x), fewer, more)
    wide = x.astype(int)
    want = np.flatnonzero((np.maximum(low - wide, 0).sum(axis=1) <= more) & (np.maximum(wide - high, 0).sum(axis=1) <= fewer))
    assert row.tolist() == want.tolist()


def some_words(seed, n, letters="abcdeé"):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n)}
    return {w: rng.randrange(1, 2000) for w in words | {"q" * 400, "q" * 401, "q" * 399 + "r"}}


@pytest.mark.parametrize("cell_letters", [1 << 20, 300])
def test_near_words_equal_all_pairs_in_one_cell_and_in_many(spark, cell_letters):
    words = some_words(cell_letters, 900)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"])
           for r in spellings.near_words(df, cell_letters=cell_letters, part_words=100).collect()}
    want = {}
    for a in words:
        near = [b for b in words if abs(len(a) - len(b)) < 2 and a != b and slow_near(a, b)]
        if near:
            best = min(near, key=lambda b: (-words[b], b))
            want[a] = (len(near), words[best], best)
    assert got == want


def test_tree_visits_few_leaves_of_a_large_length():
    rng = np.random.default_rng(0)
    letters = rng.integers(97, 123, (20000, 12)).astype(np.uint8)
    counts = spellings.letter_counts(letters)
    _, first, boxes = spellings.word_tree(counts)
    row, _ = boxes.reach(spellings.packed_counts(counts[:200]), 1, 1)
    assert len(row) / 200 < 0.25 * (len(first) - 1)


def test_letters_forms_and_roots(spark):
    docs = ([(1, "Colour")] * 200 + [(2, "colouR colur")] * 15 + [(3, "coluur, ÀBCDEF àBCDEF")] * 2 + [(None, None), (4, "")]
            + [(5, "hapen " * 3 + "happen " * 9), (6, "Coluur")])
    df = spark.createDataFrame(docs, "doc_id int, text string")
    rows = {r["word"]: r for r in spellings.spelling_variants(df, min_length=5, min_count=2).collect()}
    assert set(rows) == {"colour", "colur", "coluur", "Àbcdef", "àbcdef", "hapen", "happen"}
    assert (rows["colour"]["n"], rows["colour"]["form"], rows["colour"]["n_near"]) == (215, None, 2)
    assert [rows[w]["form"] for w in ("colur", "coluur")] == ["colour", "colour"]
    assert rows["coluur"]["root"] == "colour" and rows["coluur"]["form_n"] == 215
    assert rows["hapen"]["form"] is None and rows["hapen"]["n_near"] == 1 and rows["hapen"]["root"] == "hapen"
    assert rows["Àbcdef"]["n_near"] == 1


def test_roots_follow_long_chains(spark):
    n = 40
    chain = [(f"w{i:02d}", f"w{i + 1:02d}" if i < n else None) for i in range(n + 1)]
    assert {r["root"] for r in spellings.follow(spark.createDataFrame(chain, "word string, form string")).collect()} == {"w40"}


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Exact targets by rounds: cap whoever is above, share the rest anew."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest, shared = total - sum(cap * sizes[s] for s in full), sum(w[s] for s in order if s not in full)
        above = {s for s in order if s not in full and Fraction(rest * w[s], shared) > cap * sizes[s]}
        if not above:
            return {s: Fraction(cap * sizes[s]) if s in full else Fraction(rest * w[s], shared) for s in order}
        full |= above


def test_targets_in_rounds(spark):
    rng = random.Random(2)
    for _ in range(3):
        sizes = {f"s{i}": rng.choice([0, 1, 7, 100, 10_000, 123_456]) for i in range(12)} | {None: 50, "Z": 3}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        assert got == {s: float(t) for s, t in water_fill(sizes).items()}
    assert mixing.source_targets(spark.createDataFrame([("a", 0)], "source string, source_size bigint")).first()["target"] == 0.0


def corpus(spark):
    rng = random.Random(4)
    rows = [(i, "w " * min(3000, int(rng.paretovariate(0.8))), rng.choice(["a", "b", "b", "b", "c", "d", None])) for i in range(1500)]
    rows += [(7, "same text again", "b")] * 900 + [(None, None, "e"), (None, "", "a"), (3, "x", "f")]
    return spark.createDataFrame(rows, "doc_id int, text string, mix string")


def test_mix_comes_near_its_targets_and_repeats(spark, monkeypatch):
    df = corpus(spark)
    whole = mixing.mix_sources(df, source="mix", keep=["doc_id"]).collect()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 100)  # many ranges
    again = mixing.mix_sources(df.repartition(9), source="mix", keep=["doc_id"]).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, again))
    assert len(whole) == df.count()
    sources = {}
    for r in whole:
        assert r["mix"]["taken"] == r["mix"]["copies"] * r["mix"]["size"] and 0 <= r["mix"]["copies"] <= 3
        sources.setdefault((r["mix"]["source_size"], r["mix"]["target"]), []).append(r["mix"])
    for (size, target), own in sources.items():
        assert sum(m["size"] for m in own) == size
        rate = target / size if size else 0
        assert all(int(rate) <= m["copies"] <= -int(-rate // 1) for m in own)
        assert abs(sum(m["taken"] for m in own) - target) <= max(m["size"] for m in own) + 1e-6
    assert abs(sum(t for _, t in sources) - sum(s for s, _ in sources)) < 1e-6


def test_emitted_rows(spark):
    df = corpus(spark).withColumn("copy", F.lit("mine"))
    mixed = mixing.mix_sources(df.withColumnRenamed("mix", "source"))
    out = mixing.emit(mixed)
    assert out.columns == ["doc_id", "text", "source", "copy"]
    assert out.count() == mixed.agg(F.sum("mix.copies")).first()[0]
    assert dict(out.groupBy("copy").count().collect()).keys() <= {0, 1, 2}


def test_running_sums_cross_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    rows = [(g, i, i % 5) for g in ("x", None, string.ascii_lowercase) for i in range(130)]
    df = spark.createDataFrame(rows, "g string, i int, n bigint")
    for r in mixing.running_sums(df, "g", [F.col("i")], "n", len(rows)).collect():
        assert r["upto"] == sum(i % 5 for i in range(r["i"] + 1))
