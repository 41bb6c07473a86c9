"""Benchmark decontamination: a dense block-max filter over a BM25 index of test items.

The filter stands in for WAND: no cursors, pivots or skips, each passage sums
its terms' bounds for all blocks.  Its results are complete.

Test items are the indexed side, training passages the queries.  An impact is
a term's BM25 share of its item's full score, so one threshold fits items of
any length.  A passage first sums, for every block of eight items, the largest
impact each of its terms has in that block; only blocks whose sum reaches the
threshold are scored exactly through the postings, and every item at or above
the threshold is then verified: enough of the question's and of the answer's
word n-grams must stand in the passage.  Nothing is cut to a top k.

The benchmark is read in blocks of bounded bytes, each a broadcast index; all
documents meet all blocks in one scan and without a shuffle.

Passages are twice the stride long and the stride is at least an item's
length, so an item copied anywhere lies whole in one passage.

Defined results:

* null or empty document or item text: no words, no leak;
* repeated documents are searched each, repeated items are each reported;
* an item of one sentence is split in halves into question and answer; a part
  without words counts as found;
* an empty benchmark finds nothing; words are lower-cased, ASCII punctuation
  separates them.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: BM25 constants, threshold (share of an item's own score) and overlap shares.
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM = 0.5, 0.5, 3
ITEMS_PER_BLOCK, ITEMS_PER_GROUP, STRIDE = 8, 512, 32
#: Bytes of item text in one broadcast index.
INDEX_BYTES = 16 << 20
#: Characters of documents searched in one step.
SEARCH_CHARS = 1 << 20

_PUNCTUATION = bytes(32 if chr(i) in string.punctuation or i < 32 else i for i in range(256))
LEAK_TYPE = ("array<struct<item_id:bigint,passage_start:int,score:double,"
             "question_overlap:double,answer_overlap:double>>")
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("passage_start", pa.int32()), ("score", pa.float64()),
                             ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; ASCII punctuation and white space separate."""
    return text.lower().encode("utf-8", "replace").translate(_PUNCTUATION).split() if text else []


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question (all sentences but the last) and of the answer (the last)."""
    parts = [w for w in map(tokens, re.split(r"(?<=[.?!])\s+", text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    return words[: len(words) // 2], words[len(words) // 2:]


def grams(ids: list[int], n: int = GRAM) -> set[tuple[int, ...]]:
    """Word n-grams; a shorter sequence is its own single gram."""
    return {tuple(ids[i:i + n]) for i in range(max(1, len(ids) - n + 1))} if ids else set()


@dataclass
class Group:
    """Inverted index of up to ``ITEMS_PER_GROUP`` items of similar length."""

    items: list[int]
    stride: int
    local: np.ndarray  # vocabulary id -> row of this group, or -1
    bounds: np.ndarray  # term row x block: largest impact
    start: np.ndarray  # postings of term row t: start[t]:start[t + 1]
    posting_item: np.ndarray
    posting_impact: np.ndarray
    parts: list[tuple[set, set]]


@dataclass
class Index:
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    groups: list[Group] = field(default_factory=list)


def build_index(items: list[tuple[int, str]], frequency: dict[bytes, int], total: int, mean_length: float) -> Index:
    """Index of one bounded block of items; ``frequency`` counts items per term over the whole benchmark."""
    index, listed = Index(), []
    for item_id, text in items:
        words = tokens(text)
        if words:
            ids = [index.vocabulary.setdefault(w, len(index.vocabulary)) for w in words]
            listed.append((len(ids), item_id, ids, question_answer(text)))
    listed.sort(key=lambda x: x[:2])
    idf = np.array([math.log(1 + (total - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w in index.vocabulary])
    for at in range(0, len(listed), ITEMS_PER_GROUP):
        chunk = listed[at:at + ITEMS_PER_GROUP]
        terms, owner, impact = [], [], []
        for k, (length, _, ids, _) in enumerate(chunk):
            term, tf = np.unique(np.array(ids), return_counts=True)
            score = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
            terms.append(term)
            owner.append(np.full(len(term), k))
            impact.append(score / score.sum())
        term, owner, impact = map(np.concatenate, (terms, owner, impact))
        rows, term = np.unique(term, return_inverse=True)
        local = np.full(len(index.vocabulary), -1, np.int32)
        local[rows] = np.arange(len(rows))
        order = np.lexsort((owner, term))
        bounds = np.zeros((len(rows), -(-len(chunk) // ITEMS_PER_BLOCK)), np.float32)
        np.maximum.at(bounds, (term, owner // ITEMS_PER_BLOCK), impact.astype(np.float32) * np.float32(1 + 1e-5))
        index.groups.append(Group(
            [x[1] for x in chunk], max(STRIDE, -(-chunk[-1][0] // STRIDE) * STRIDE), local, bounds,
            np.searchsorted(term[order], np.arange(len(rows) + 1)), owner[order], impact[order],
            [tuple(grams([index.vocabulary[w] for w in part]) for part in x[3]) for x in chunk]))
    return index


def retrieve(group: Group, known: np.ndarray, at: np.ndarray, base: np.ndarray,
             threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) at or above ``threshold``.

    ``known`` are term rows, ``at`` their word positions in their document and
    ``base`` the number of their document's first passage.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    n_terms, n_items = len(group.start) - 1, len(group.items)
    number = base + at // group.stride
    earlier = at >= group.stride  # a word also lies in the passage that began a stride before
    keys = np.unique(np.concatenate((number * n_terms + known, (number[earlier] - 1) * n_terms + known[earlier])))
    if not len(keys):
        return none
    passage, term = keys // n_terms, keys % n_terms
    first = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    hopeful = np.add.reduceat(group.bounds[term], first, axis=0) >= threshold  # passage x block
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    live = hopeful.any(axis=1)[row]
    row, term = row[live], term[live]
    if not len(row):
        return none
    count = group.start[term + 1] - group.start[term]
    where = np.repeat(group.start[term] - np.cumsum(count) + count, count) + np.arange(count.sum())
    row, item = np.repeat(row, count), group.posting_item[where]
    in_block = hopeful[row, item // ITEMS_PER_BLOCK]
    pair, slot = np.unique(row[in_block] * n_items + item[in_block], return_inverse=True)
    score = np.bincount(slot, group.posting_impact[where][in_block], len(pair))
    good = score >= threshold
    pair = pair[good]
    return passage[first][pair // n_items], pair % n_items, score[good]


def search(index: Index, texts: list[str | None], threshold: float = THRESHOLD,
           overlap: float = OVERLAP) -> list[list[dict]]:
    """Verified leaks of each text: per item the passage of highest score."""
    get = index.vocabulary.get
    ids = [np.array([get(w, -1) for w in tokens(t)], np.int64) for t in texts]
    length = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    starts = np.cumsum(length) - length
    found: list[dict[int, dict]] = [{} for _ in texts]
    for group in index.groups:
        passages = length // group.stride + 1
        base = np.cumsum(passages) - passages
        rows = np.where(flat >= 0, group.local[flat], -1)
        spot = np.flatnonzero(rows >= 0)
        doc = np.searchsorted(starts, spot, "right") - 1
        hits = retrieve(group, rows[spot], spot - starts[doc], base[doc], threshold)
        for passage, item, score in zip(*(x.tolist() for x in hits), strict=True):
            d = int(np.searchsorted(base, passage, "right")) - 1
            begin = (passage - int(base[d])) * group.stride
            near = ids[d][max(0, begin - group.stride):begin + 3 * group.stride].tolist()
            shares = [len(part & grams(near, len(next(iter(part))))) / len(part) if part else 1.0
                      for part in group.parts[item]]
            if min(shares) >= overlap:
                old = found[d].get((group.items[item], item))
                if old is None or score > old["score"]:
                    found[d][group.items[item], item] = {
                        "item_id": group.items[item], "passage_start": begin, "score": score,
                        "question_overlap": shares[0], "answer_overlap": shares[1]}
    return [[x[k] for k in sorted(x, key=lambda k: (k[0] is None, k))] for x in found]


def _blocks(items: DataFrame, item_id: str, text: str):
    """Bounded blocks of items with whole-benchmark statistics, one at a time."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x00-\x20!-/:-@\[-`{-~]+"), lambda w: w != "")
    items = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(text).alias("text"), words.alias("words"))
    items = items.filter(F.size("words") > 0)
    sums = items.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"),
                     F.sum(F.octet_length("text")).alias("bytes")).first()
    if not sums["n"]:
        return
    n_blocks = -(-sums["bytes"] // INDEX_BYTES)
    blocked = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)))
    terms = blocked.select("block", "id", F.explode(F.array_distinct("words")).alias("word"))
    frequency = terms.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    for block in range(n_blocks):
        own = blocked.filter(F.col("block") == block)
        rows = [(r["id"], r["text"]) for r in own.select("id", "text").collect()]
        here = own.select(F.explode("words").alias("word")).distinct() if n_blocks > 1 else None
        counted = frequency if here is None else frequency.join(here, "word")
        yield rows, {r["word"].encode(): r["n"] for r in counted.collect()}, sums["n"], sums["mean"]


def _search_udf(index, threshold: float, overlap: float):
    @F.arrow_udf(LEAK_TYPE)
    def find(texts: pa.Array) -> pa.Array:
        found, part, size = [], [], 0
        for text in texts:  # a batch may hold thousands of texts: arrays of a bounded part at a time
            part.append(text.as_py())
            size += len(part[-1] or "")
            if size >= SEARCH_CHARS:
                found += search(index.value, part, threshold, overlap)
                part, size = [], 0
        return pa.array(found + search(index.value, part, threshold, overlap), _ARROW)

    return find


def leaks(items: DataFrame, text: Column, item_id: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Column:
    """Column of all verified leaks of each document text, an array of ``LEAK_TYPE``."""
    context = items.sparkSession.sparkContext
    columns = [_search_udf(context.broadcast(build_index(*block)), threshold, overlap)(text)
               for block in _blocks(items, item_id, item_text)]
    return F.concat(*columns) if columns else F.array().cast(LEAK_TYPE)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document row and leaked item: ids, passage start (in words), score and overlaps."""
    found = docs.select(F.col(id_col).alias("id"), leaks(items, F.col(text), **options).alias("leaks"))
    return found.select("id", F.explode("leaks").alias("leak")).select(F.col("id").alias("doc_id"), "leak.*")


def remove_leaked(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without any leaked item, all columns as they are; no shuffle."""
    return docs.filter(F.size(leaks(items, F.col(text), **options)) == 0)
