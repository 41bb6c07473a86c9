"""Substring dedup by words and by bytes against brute force on texts that repeat a lot."""

import random

import numpy as np
import pytest

from beatwise.llm import block_repeats, suffix_repeats
from beatwise.llm.suffix_repeats import SuffixOrder, sliding_minimum


def brute(rows, split, window):
    """Removed positions of each row by comparing every window with every other."""
    parts = [split(t or "") for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for i, p in zip(ids, parts, strict=True):
        for k in range(len(p) - window + 1):
            gram = tuple(p[k:k + window])
            first[gram] = min(first.get(gram, float("inf")), i)
    found = []
    for i, p in zip(ids, parts, strict=True):
        gone = set()
        for k in range(len(p) - window + 1):
            if first[tuple(p[k:k + window])] < i < float("inf"):
                gone.update(range(k, k + window))
        found.append(gone)
    return parts, found


def texts(seed, words, n, length):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = [rng.choice(words) for _ in range(rng.randrange(length))]
        if rows and rng.random() < 0.7:
            other = rng.choice(rows)[1].split(" ")
            a = rng.randrange(len(other) + 1)
            t[len(t) // 2:len(t) // 2] = other[a:a + rng.randrange(40)]
        rows.append((rng.choice([i, i, i, None, 3]), " ".join(t)))
    return rows


def spans_of(gone):
    return sorted((a, b) for a in gone if a - 1 not in gone
                  for b in [next(x for x in range(a, a + len(gone) + 2) if x not in gone)])


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = texts(seed, ["a", "b", "c", "dd"], 60, 80)
    got = block_repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), window=10)
    parts, gone = brute(rows, lambda t: [w for w in t.split(" ") if w], 10)
    want = sorted(repr((i, len(p), spans_of(g), " ".join(w for k, w in enumerate(p) if k not in g)))
                  for (i, _), p, g in zip(rows, parts, gone, strict=True))
    assert any(gone)
    assert want == sorted(repr((r["row"]["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["kept"])) for r in got.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = texts(seed, ["é", "b", "cc"], 60, 60)
    got = suffix_repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), length=12, gram=5)
    parts, gone = brute(rows, lambda t: list(t.encode()), 12)
    want = sorted(repr((i, len(p), spans_of(g), bytes(b for k, b in enumerate(p) if k not in g)))
                  for (i, _), p, g in zip(rows, parts, gone, strict=True))
    assert any(gone)
    assert want == sorted(repr((r["row"]["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))) for r in got.collect())


def test_equal_texts_by_one_id_stay(spark):
    df = spark.createDataFrame([(1, "x " * 200), (1, "x " * 200)], "doc_id bigint, text string")
    assert [r["spans"] for r in block_repeats.remove_repeats(df).collect()] == [[], []]
    assert [r["spans"] for r in suffix_repeats.remove_repeats(df).collect()] == [[], []]


def test_suffix_sort_is_a_sort_within_groups():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    spots = rng.permutation(3900)[:1500]
    group = np.sort(rng.integers(0, 40, 1500))
    order = SuffixOrder(data, 50).sort(spots, group)
    key = [(int(group[i]), data[spots[i]:spots[i] + 50].tobytes()) for i in order]
    assert sorted(order.tolist()) == list(range(1500)) and key == sorted(key)


def test_sliding_minimum():
    x = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 2, 3, 27, 50):
        assert sliding_minimum(x, width).tolist() == [x[i:i + width].min() for i in range(200 - width + 1)]


def test_bad_parameters(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError):
        block_repeats.remove_repeats(df, window=7)
    with pytest.raises(ValueError):
        suffix_repeats.remove_repeats(df, length=10, gram=11)
