"""Operators that SQL cannot express, against plain Python over all pairs."""

import math
import random
import string

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from beatwise.llm import decontaminate as d
from beatwise.llm.graph import connected_components
from beatwise.llm.pieces import PieceModel
from beatwise.llm.queries import QUERIES
from beatwise.llm.simhash import fingerprint, links

from .conftest import SF, messy_documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = PieceModel(MODEL)


def slow_fingerprint(text, n=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word] if word else words), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, max_bits=2):
    """(id, fingerprint) rows to the smallest id reachable, over all pairs."""
    root = {fp: fp for _, fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for i, fp in prints:
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return [(i, f"{fp:016x}", least.get(find(fp))) for i, fp in prints]


@pytest.mark.parametrize("folder", ["messy", SF])
def test_simhash_query(spark, request, folder):
    folder = request.getfixturevalue("messy") if folder == "messy" else folder
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = slow_components([(r["doc_id"], slow_fingerprint(r["text"])) for r in rows])
    got = [tuple(r[c] for c in ("doc_id", "fingerprint", "component_id")) for r in QUERIES["op7_simhash"](spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_fingerprint_of_many_shingles():
    text = " ".join(f"W{i * i % 977}" for i in range(1500))
    assert fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
def test_links_connect_as_all_pairs_do(spark, max_bits):
    rng = random.Random(max_bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(6):
            prints.add(x)
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = links(spark.createDataFrame(signed, "fp bigint"), max_bits)
    assert all((r["a"] ^ r["b"]) % (1 << 64) != 0 and ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= max_bits for r in edges.collect())
    roots = {r["node"] % (1 << 64): r["root"] for r in connected_components(edges).collect()}
    groups = {}
    for i, (p, _, c) in enumerate(slow_components([(k, p) for k, p in enumerate(sorted(prints))], max_bits)):
        groups.setdefault(c, set()).add(sorted(prints)[i])
    got = {}
    for p in prints:
        got.setdefault(roots.get(p, ("alone", p)), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def slow_leaks(docs, items):
    """Every passage against every item, scored term by term."""
    listed = [(i, d.tokens(t), t) for i, t in items if d.tokens(t)]
    mean = sum(len(w) for _, w, _ in listed) / max(1, len(listed))
    df = {}
    for _, w, _ in listed:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    stride = max(d.STRIDE, -(-max([len(w) for _, w, _ in listed], default=1) // d.STRIDE) * d.STRIDE)
    found = []
    for doc_id, text in docs:
        words = d.tokens(text)
        for item_id, item, item_text in listed:
            impact = {x: math.log(1 + (len(listed) - df[x] + .5) / (df[x] + .5)) * item.count(x) * (d.K1 + 1)
                      / (item.count(x) + d.K1 * (1 - d.B + d.B * len(item) / mean)) for x in set(item)}
            best = None
            for at in range(0, len(words), stride):
                score = sum(impact.get(x, 0) for x in set(words[at:at + 2 * stride])) / sum(impact.values())
                near = words[max(0, at - stride):at + 3 * stride]
                shares = []
                for part in d.question_answer(item_text):
                    own = d.grams(part)
                    size = len(next(iter(own))) if own else 1
                    shares.append(len(own & d.grams(near, size)) / len(own) if own else 1.0)
                if score >= d.THRESHOLD and min(shares) >= d.OVERLAP and (best is None or score > best + 1e-9):
                    best = score
            if best is not None:
                found.append((doc_id, item_id, round(best, 6)))
    return found


@pytest.mark.parametrize("folder", ["messy", SF])
def test_decontamination_query(spark, request, folder):
    folder = request.getfixturevalue("messy") if folder == "messy" else folder
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [x for x in docs if len(x[1] or "") < 60000]
    want = slow_leaks(docs, items)
    assert want
    small = {x for x in docs}
    got = [(r["doc_id"], r["item_id"], round(r["score"], 6)) for r in QUERIES["op4_decontaminate"](spark, folder).collect()]
    ids = {x[0] for x in small}
    assert sorted(map(repr, (x for x in got if x[0] in ids))) == sorted(map(repr, want))


def test_item_longer_than_a_passage_of_short_ones(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(6))
    item = " ".join(word() for _ in range(500)) + ". " + word() + " " + word() + "."
    items = spark.createDataFrame([(1, item), (2, " ".join(word() for _ in range(15)))], "item_id bigint, text string")
    noise = [" ".join(word() for _ in range(700)) for _ in range(3)]
    docs = spark.createDataFrame([(1, noise[0] + " " + item + " " + noise[1]), (2, noise[2]), (3, item.replace(" ", "$$$ ").upper())],
                                 "doc_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect()) == [(1, 1), (3, 1)]
    assert [r["doc_id"] for r in d.remove_leaked(docs, items).collect()] == [2]


def test_several_index_blocks_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda: sorted(map(repr, d.find_leaks(docs, items).collect()))
    whole = rows()
    monkeypatch.setattr(d, "INDEX_BYTES", 2000)
    monkeypatch.setattr(d, "ITEMS_PER_GROUP", 5)
    parts = d.find_leaks(docs, items)
    assert sorted((r["doc_id"], r["item_id"]) for r in parts.collect()) == sorted(
        (r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, items).collect())
    assert len(whole) == parts.count()


def test_encoding_equals_the_library(messy):
    rng = random.Random(1)
    alphabet = list("abcTheing  \n\t▁▁é梦\U0001F600<0x>\u0000​12#")
    texts = [r[1] for r in messy_documents()] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += [" " * k + x for k in range(70) for x in ("", "a", "梦", "\n", "the ", " the  x")]
    for t in texts:
        ids = PIECES.encode(t)
        assert ids.tolist() == LIBRARY.encode(t or "")
        assert PIECES.decode(ids) == LIBRARY.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encoding_of_any_text(text):
    ids = PIECES.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert PIECES.decode(ids) == LIBRARY.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=20))
def test_decoding_of_any_ids(ids):
    assert PIECES.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids)


def test_decoding_behind_control_pieces():
    """The mark of the first piece with a text is dropped, also behind control pieces."""
    for first in ([], [1], [2], [1, 1, 2], [0], [1, 0], [259], [1, 259], [1, 13], [1, 35], [1, 229], [378, 1]):
        for ids in (first, first + [378], first + [378, 378], first + [259, 378]):
            assert PIECES.decode(np.array(ids, np.int32)) == LIBRARY.decode(ids), ids


def test_full_caches_change_nothing(monkeypatch):
    from beatwise.llm import pieces

    monkeypatch.setattr(pieces, "CACHE_WORDS", 5)
    monkeypatch.setattr(pieces, "CACHE_PAIRS", 5)
    model = PieceModel(MODEL)
    for _, text, *_ in messy_documents()[:15]:
        assert model.encode(text).tolist() == LIBRARY.encode(text or "")


def test_sentencepiece_query(spark, messy):
    import hashlib

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in messy_documents():
        ids = LIBRARY.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    got = [tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
           for r in QUERIES["op6_sentencepiece"](spark, messy).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
