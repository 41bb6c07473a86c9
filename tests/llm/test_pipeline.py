"""The pipeline, stage by stage and as a whole, against plain Python."""

import hashlib

import pytest

import corpus_pipeline
from beatwise.llm.oracles import ORACLES
from beatwise.llm.queries import QUERIES

from .conftest import SF
from .test_brute_force import LIBRARY, slow_fingerprint, slow_leaks


def read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def counted(rows):
    found = {}
    for r in rows:
        found[repr(r)] = found.get(repr(r), 0) + 1
    return found


@pytest.mark.parametrize("kind", ["messy", "sf"])
def test_stages(spark, duck, request, kind):
    folder = request.getfixturevalue("messy") if kind == "messy" else SF
    docs = read(spark, folder)
    con = duck(folder)
    # quality rules: a multiset of ids, as ids may repeat or be null
    kept = corpus_pipeline.quality_rules(spark, docs, folder)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    want = con.sql(f"SELECT doc_id FROM ({ORACLES['op5_host_quality']}) WHERE kept").fetchall()
    assert sorted(map(repr, [(r["doc_id"],) for r in kept.select("doc_id").collect()])) == sorted(map(repr, want))
    # near-duplicates: one row per component, with its smallest id
    rows = kept.select("doc_id", "text").collect()
    first = corpus_pipeline.simhash_dedup(spark, kept, folder)
    assert first.columns == docs.columns
    one_of_each(rows, first.select("doc_id", "text").collect())
    # benchmark
    clean = corpus_pipeline.benchmark_decontamination(spark, first, folder)
    rows = [(r["doc_id"], r["text"]) for r in first.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {x[0] for x in slow_leaks([x for x in rows if len(x[1] or "") < 60000], items)}
    assert leaked
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(repr(i) for i, _ in rows if i not in leaked)
    # secrets: rows and columns stay, only texts with secrets change
    masked = corpus_pipeline.secret_scans(spark, clean, folder)
    assert masked.columns == docs.columns
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    after = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert set(before) == set(after) and masked.count() == clean.count()
    for i, text in before.items():
        assert text == after[i] or "[SECRET]" in after[i]
        assert 'token = "' not in (after[i] or "") or 'token = "[SECRET]"' in after[i]
    # pieces
    for r in corpus_pipeline.sentencepiece(spark, masked, folder).collect():
        assert list(r["ids"]) == LIBRARY.encode(after[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])


def one_of_each(rows, left):
    """``left`` has one of ``rows`` for each component over all pairs of texts, with the component's smallest id."""
    prints = [slow_fingerprint(r["text"]) for r in rows]
    distinct = sorted(set(prints))
    root = {fp: fp for fp in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    own, ids = {}, {}
    for r, fp in zip(rows, prints, strict=True):
        own.setdefault(find(fp), []).append((r["doc_id"], r["text"]))
        ids.setdefault(find(fp), []).append(r["doc_id"])
    kept = [(find(slow_fingerprint(r["text"])), r["doc_id"], r["text"]) for r in left]
    assert sorted(k for k, _, _ in kept) == sorted(own)
    for k, i, text in kept:
        assert (i, text) in own[k] and i == min((x for x in ids[k] if x is not None), default=None)


def test_one_row_of_each_component_stays(spark):
    """Ids that repeat with other texts, groups without ids, and many equal rows."""
    a, b, c, d = ("alpha beta gamma delta " * 9, "one two three four five " * 9, "red green blue black " * 9, "x y z w v u " * 9)
    rows = [(2, a, 1), (2, b, 1), (5, b, 1), (7, c, 1), (None, d, 1), (None, d, 2), (None, d + " ", 1), (3, c, 1), (None, c, 1), (8, None, 1),
            (None, "", 1)] + [(9, a + "tail of another kind of text " * 9, 1)] * 300
    docs = spark.createDataFrame([(i, t, n, "x") for i, t, n in rows], "doc_id bigint, text string, n int, root string").repartition(5)
    left = corpus_pipeline.simhash_dedup(spark, docs, "")
    assert left.columns == docs.columns
    got = left.collect()
    one_of_each([r.asDict() for r in docs.collect()], got)
    assert sorted((r["doc_id"], r["text"][:5]) for r in got if r["text"] and r["doc_id"]) == [(2, "alpha"), (2, "one t"), (3, "red g"), (9, "alpha")]
    assert sum(r["text"] is not None and r["text"].startswith("x y") for r in got) == 1


def test_verdicts_take_no_name_of_a_column(spark):
    docs = spark.createDataFrame([(1, "word " * 5 + "other words of a text that goes on and on with no end in sight for now " * 2, "en", "s", 9, "mine", "too")],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, __verdict string, verdict string")
    assert corpus_pipeline.quality_rules(spark, docs, "").columns == docs.columns


def test_run_equals_its_stages(spark):
    docs = read(spark, SF)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    digest = lambda rows: sorted(hashlib.md5(repr(r).encode()).hexdigest() for r in rows)
    assert digest(corpus_pipeline.run(spark, SF).collect()) == digest(docs.collect())


def test_empty_documents(spark, empty):
    docs = read(spark, empty)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, empty)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"]
    assert {int(k.split("_")[0][2:]) for k in QUERIES} == set(range(1, 14))
