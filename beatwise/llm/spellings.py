"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

One inserted, deleted or replaced letter moves the vector of a word's letter
counts by an L1 distance of at most two: a replacement takes one letter away
and adds one, an insertion only adds one.  Words of one length are an index
cell: a k-d tree with the bounding box of every node.  Each word searches the
tree of its own length and the tree of the next; boxes too far away are pruned,
and of the words in the leaves that are reached the letters are compared in
order.

Letters are counted in 32 classes (code point modulo 32), each up to 7; merging
classes and stopping at 7 only shorten distances, so no word is missed.  The
counts of a word are then 32 numbers of four bits, two machine words, and boxes
and letters are compared as machine words too.

Lengths with more words than a cell holds are cut by the top of a k-d tree,
fitted to a bounded sample of the words (``SAMPLE`` per length); every word is
indexed, a word asks each cell its reach touches, and a cell that comes out
larger than planned only takes longer.  A cell's tree is built once and
travels as one packed row to the parts its askers are dealt into.  Only sums
and the best neighbour per word leave a part, not pairs.

Defined results: a null text has no words; a null id is the empty string in
the hash of an occurrence; repeated rows count again; ties of frequency go to
the word smaller in code-point order; no words: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts_for

#: Fixed value: what words are made of; all letters have one byte in Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
CLASSES, MOST = 32, 7
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: An occurrence whose hash this divides loses a letter.
LOSES_LETTER = 199
#: Letters of a cell, about; words of a leaf; words sampled for the top of a length's tree.
CELL_LETTERS = 1 << 20
LEAF = 32
SAMPLE = 4096
#: Words that ask one part of a cell, searched together, and pairs compared at once.
PART_WORDS, AT_ONCE, COMPARE = 16_384, 256, 1 << 20

_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def occurrences(df: DataFrame, id_col: str, text: str, min_length: int, loses_letter: int | None) -> DataFrame:
    """``word`` of every run of letters of at least ``min_length``, A-Z lower-cased."""
    run = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), f"[^{LETTERS}]+"))
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.filter(F.length("run") >= min_length)
    ascii_only = F.octet_length("run") == F.length("run")
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", upper, lower)).alias("run"))
    if loses_letter is None:
        return runs.select(F.col("run").alias("word"))
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", mark.alias("mark"))
    at = (F.col("mark") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("mark") % loses_letter == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= min_length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Counts of letter classes for words of one length, one row of Latin-1 bytes each; at most 7."""
    n = len(letters)
    place = (np.arange(n, dtype=np.int64)[:, None] * CLASSES + (letters & (CLASSES - 1))).ravel()
    counts = np.bincount(place, minlength=n * CLASSES).reshape(n, CLASSES)
    return np.minimum(counts, MOST).astype(np.uint8)


def packed_counts(counts: np.ndarray) -> np.ndarray:
    """Rows of counts as two machine words each, four bits a count: shape (2, rows)."""
    halves = counts[:, 0::2] | (counts[:, 1::2] << 4)
    return np.ascontiguousarray(np.ascontiguousarray(halves).view("<u8").T)


#: In every four bits: the spare bit, and what makes a count more than one.
_SPARE, _MANY = np.uint64(0x8888888888888888), np.uint64(0x6666666666666666)


def _above(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each count, what ``a`` is above ``b``, or 0."""
    gap = (a | _SPARE) - b
    wide = gap & _SPARE
    return gap & (wide - (wide >> np.uint64(3)))


def _at_most(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], room: int) -> np.ndarray:
    """Whether the counts of ``a`` are above those of ``b`` by ``room`` (0 or 1) at most, summed over all."""
    x, y = _above(a[0], b[0]), _above(a[1], b[1])
    if not room:
        return (x | y) == 0
    return (np.bitwise_count(x) + np.bitwise_count(y) <= 1) & ((x | y) & _MANY == 0)


class BoxTree:
    """A complete binary tree of boxes in a heap: node i has the children 2i + 1 and 2i + 2.

    ``low`` and ``high`` are packed counts, shape (2, nodes).
    """

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.depth = int(math.log2(low.shape[1] + 1)) - 1

    def reach(self, counts: np.ndarray, fewer: int, more: int) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` for leaves that may hold a vector with at most ``fewer`` counts taken away and ``more`` added."""
        row, node = np.arange(counts.shape[1]), np.zeros(counts.shape[1], np.int64)
        for level in range(self.depth + 1):
            for room, over in ((more, False), (fewer, True)):
                box = self.high if over else self.low
                x, edge = (counts[0][row], counts[1][row]), (box[0][node], box[1][node])
                near = _at_most(x, edge, room) if over else _at_most(edge, x, room)
                row, node = row[near], node[near]
            if level < self.depth:
                row = np.repeat(row, 2)
                node = np.stack((2 * node + 1, 2 * node + 2), axis=1).ravel()
        return row, node - (2 ** self.depth - 1)


def word_tree(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, BoxTree]:
    """Order of the rows by leaf, first row of every leaf (and the end), and the boxes."""
    n = len(counts)
    depth = max(0, math.ceil(math.log2(n / LEAF)))
    first_leaf = 2 ** depth - 1
    order, start = np.arange(n), np.zeros(2 * first_leaf + 1, np.int64)
    end = np.zeros(2 * first_leaf + 1, np.int64)
    low, high = np.full((2 * first_leaf + 1, CLASSES), MOST, np.uint8), np.zeros((2 * first_leaf + 1, CLASSES), np.uint8)
    end[0] = n
    for node in range(2 * first_leaf + 1):
        a, b = start[node], end[node]
        own = counts[order[a:b]]
        if b > a:
            low[node], high[node] = own.min(axis=0), own.max(axis=0)
        if node < first_leaf:
            if b > a:
                axis = int(own.var(axis=0, dtype=np.float32).argmax())
                order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
            start[2 * node + 1], end[2 * node + 1] = a, (a + b) // 2
            start[2 * node + 2], end[2 * node + 2] = (a + b) // 2, b
    return order, np.append(start[first_leaf:], n), BoxTree(packed_counts(low), packed_counts(high))


class LengthSplits:
    """Top of the k-d tree of one length: splits fitted to a sample, boxes without data."""

    def __init__(self, counts: np.ndarray, depth: int):
        nodes = 2 ** depth - 1
        self.depth, self.axis, self.most = depth, np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        low, high = np.zeros((2 * nodes + 1, CLASSES), np.uint8), np.full((2 * nodes + 1, CLASSES), MOST, np.uint8)
        own = {0: counts}
        for node in range(nodes):
            part = own.pop(node)
            if len(part):  # the axis and count that halve the sample best
                share = (part[:, :, None] <= np.arange(MOST)).mean(axis=0)
                self.axis[node], self.most[node] = np.unravel_index(np.abs(share - 0.5).argmin(), share.shape)
            left = part[:, self.axis[node]] <= self.most[node]
            own[2 * node + 1], own[2 * node + 2] = part[left], part[~left]
            for child in (2 * node + 1, 2 * node + 2):
                low[child], high[child] = low[node], high[node]
            at = self.axis[node]
            high[2 * node + 1, at] = min(high[node, at], self.most[node])
            low[2 * node + 2, at] = max(low[node, at], min(MOST, self.most[node] + 1))
        self.boxes = BoxTree(packed_counts(low), packed_counts(high))

    def cell(self, counts: np.ndarray) -> np.ndarray:
        node = np.zeros(len(counts), np.int64)
        for _ in range(self.depth):
            right = counts[np.arange(len(counts)), self.axis[node]] > self.most[node]
            node = 2 * node + 1 + right
        return node - (2 ** self.depth - 1)


def _letters(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _names(letters: np.ndarray) -> np.ndarray:
    """Words of one length as fixed-size strings, whose order is that of their code points."""
    return np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel()


def _by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, places, letters)`` of the words of a batch."""
    coded = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.fromiter(map(len, coded), np.int64, len(coded))
    for length in np.unique(size):
        own = np.flatnonzero(size == length)
        yield int(length), own, _letters([coded[i] for i in own])


def machine_words(letters: np.ndarray) -> np.ndarray:
    """Letters of words of one length as machine words, the first letter lowest: shape (words, rows)."""
    n, length = letters.shape
    padded = np.zeros((n, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = letters
    return np.ascontiguousarray(padded.view("<u8").T)


_LOW7, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _differ(x: np.ndarray) -> np.ndarray:
    """The top bit of every byte of ``x`` that is not zero."""
    return (((x & _LOW7) + _LOW7) | x) & _HIGH


def one_edit(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, longer: bool) -> np.ndarray:
    """Which pairs of columns ``i`` of ``a`` and ``j`` of ``b`` are one replaced letter apart or, if ``longer``, one inserted in ``b``."""
    if not longer:
        left = np.bitwise_count(_differ(a[0][i] ^ b[0][j]))
        place = np.flatnonzero(left <= 1)  # nearly all pairs end at their first eight letters
        left = left[place]
        for k in range(1, len(b)):
            left = left + np.bitwise_count(_differ(a[k][i[place]] ^ b[k][j[place]]))
        return place[left == 1]
    # up to the first difference the words agree; from there on b without that letter must be a
    place, open_ = np.arange(len(i)), np.ones(len(i), bool)
    for k in range(len(b)):
        own, other = (a[k][i[place]] if k < len(a) else np.zeros(len(place), np.uint64)), b[k][j[place]]
        after = other >> np.uint64(8)
        if k + 1 < len(b):
            after = after | (b[k + 1][j[place]] << np.uint64(56))
        first = _differ(own ^ other)
        lowest = first & (~first + np.uint64(1))
        moved = _differ(own ^ after)
        fits = np.where(open_, (first == 0) | (moved < lowest), moved == 0)
        place, open_ = place[fits], (open_ & (first == 0))[fits]
    return place


def _best(own: np.ndarray, n: np.ndarray, rank: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of links ``own`` to neighbours of frequency ``n`` and order ``rank``: who has any, how many, place of the best link."""
    order = np.lexsort((rank, -n, own))
    first = np.flatnonzero(np.diff(own[order], prepend=-1))
    who = own[order[first]]
    return who, np.bincount(own, minlength=size)[who], order[first]


def search(words: np.ndarray, length: int, first: np.ndarray, boxes: BoxTree, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of the letters ``asking``, column of the tree's machine ``words``) one edit apart; askers are as long or one shorter."""
    longer = length - asking.shape[1]
    asked, found = [], []
    for at in range(0, len(asking), AT_ONCE):
        part = asking[at:at + AT_ONCE]
        own = machine_words(part)
        row, leaf = boxes.reach(packed_counts(letter_counts(part)), 1 - longer, 1)
        size = first[leaf + 1] - first[leaf]
        step = max(1, COMPARE // LEAF)
        for k in range(0, len(row), step):
            many = size[k:k + step]
            ask = np.repeat(row[k:k + step], many)
            other = np.repeat(first[leaf[k:k + step]] - np.cumsum(many) + many, many) + np.arange(len(ask))
            near = one_edit(own, ask, words, other, bool(longer))
            asked.append(ask[near] + at)
            found.append(other[near])
    none = np.zeros(0, np.int64)
    return np.concatenate(asked or [none]), np.concatenate(found or [none])


def _pack_tree(table: pa.Table) -> pa.Table:
    """One row: the words of a cell in tree order, with counts, leaf borders and boxes."""
    letters = _letters([w.encode("latin-1") for w in table["word"].to_pylist()])
    order, first, boxes = word_tree(letter_counts(letters))
    n = table["n"].to_numpy()[order].astype(np.int64)
    return pa.table({"cell": table["cell"].slice(0, 1), "letters": pa.array([letters[order].tobytes()], pa.binary()),
                     "n": pa.array([n.tobytes()], pa.binary()), "first": pa.array([first.tobytes()], pa.binary()),
                     "boxes": pa.array([boxes.low.tobytes() + boxes.high.tobytes()], pa.binary())})


def _search_part(asks: pa.Table, trees: pa.Table) -> pa.Table:
    """Links of the words that ask a part of a cell, summed per word for both ends."""
    if not asks.num_rows or not trees.num_rows:
        return _FOUND.empty_table()
    tree = trees.to_pylist()[0]
    n, first = np.frombuffer(tree["n"], np.int64), np.frombuffer(tree["first"], np.int64)
    letters = np.frombuffer(tree["letters"], np.uint8).reshape(len(n), -1)
    box = np.frombuffer(tree["boxes"], np.uint64).reshape(2, 2, -1)
    boxes, packed, out = BoxTree(box[0], box[1]), machine_words(letters), []
    names = _names(letters)
    rank = np.argsort(np.argsort(names, kind="stable"), kind="stable")
    words, counts = asks["word"].combine_chunks(), asks["n"].to_numpy()
    for length, place, asking in _by_length(words):
        own, other = search(packed, letters.shape[1], first, boxes, asking)
        own_n = counts[place]
        who, many, best = _best(own, n[other], rank[other], len(asking))
        text = _names(asking)
        out.append((text[who], many, n[other][best], names[other][best]))
        if length < letters.shape[1]:  # the longer words do not ask for shorter ones themselves
            place_of = np.argsort(np.argsort(text, kind="stable"), kind="stable")
            who, many, best = _best(other, own_n[own], place_of[own], len(letters))
            out.append((names[who], many, own_n[own][best], text[own][best]))
    plain = lambda c: [x.decode("latin-1") for x in c.tolist()] if c.dtype.kind == "S" else c
    tables = [pa.table([pa.array(plain(c), t) for c, t in zip(row, _FOUND.types, strict=True)], schema=_FOUND) for row in out]
    return pa.concat_tables(tables)


def near_words(words: DataFrame, cell_letters: int = CELL_LETTERS, part_words: int = PART_WORDS) -> DataFrame:
    """``(word, n_near, best_n, best)`` of every word of ``(word, n)``, all different, that has a near word."""
    spark = words.sparkSession
    size = F.length("word")
    counts = dict(words.groupBy(size).count().filter(F.col("count") >= 64).collect())
    deep = {k: max(0, math.ceil(math.log2(n * k / cell_letters))) for k, n in counts.items()}
    deep = {k: v for k, v in deep.items() if v}
    splits: dict[int, LengthSplits] = {}
    for length, depth in deep.items():
        drawn = words.filter((size == length) & (F.pmod(F.xxhash64("word"), F.lit(max(1, counts[length] // SAMPLE))) == 0))
        splits[length] = LengthSplits(letter_counts(_letters([r["word"].encode("latin-1") for r in drawn.select("word").collect()]))
                                      if drawn.head(1) else np.zeros((0, CLASSES), np.uint8), depth)
    parts = {k: math.ceil((counts.get(k, 64) + counts.get(k - 1, 64)) / 2 ** deep.get(k, 0) / part_words)
             for k in {*counts, *(k + 1 for k in counts)}}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for length, place, letters in _by_length(batch.column(0)):
                top = splits.get(length)
                cell[place] = (length << 24) + (top.cell(letter_counts(letters)) if top else 0)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", "word", "n"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, place, letters in _by_length(batch.column(0)):
                seen = letter_counts(letters)
                for to in (length, length + 1):
                    top = splits.get(to)
                    row, leaf = top.boxes.reach(packed_counts(seen), length + 1 - to, 1) if top else (np.arange(len(place)), 0)
                    asked = batch.take(pa.array(place[row]))
                    cell = np.full(len(row), to << 24, np.int64) + leaf
                    deal = (row + length) % parts.get(to, 1)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(deal.astype(np.int32)), *asked.columns],
                                                     ["cell", "part", "word", "n"])

    columns = words.select("word", "n")
    cells = columns.mapInArrow(index, "cell bigint, word string, n bigint").groupBy("cell").applyInArrow(
        _pack_tree, "cell bigint, letters binary, n binary, first binary, boxes binary")
    many = F.create_map(*[F.lit(x) for item in (parts or {0: 1}).items() for x in item])
    last = F.coalesce(F.try_element_at(many, F.shiftright("cell", 24).cast("int")), F.lit(1)) - 1
    trees = cells.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    asks = columns.mapInArrow(ask, "cell bigint, part int, word string, n bigint")
    tasks = parts_for(spark, sum(parts.values()) * 2, 1)
    key = ["cell", "part"]
    found = asks.repartition(tasks, *key).groupBy(*key).cogroup(trees.repartition(tasks, *key).groupBy(*key)).applyInArrow(
        _search_part, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``, form null at the end; each round doubles the steps taken."""
    steps = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialize(steps.join(ahead, "root").select("word", F.col("next").alias("root"),
                                                               (F.col("next") != F.col("root")).alias("moved")), "roots")
        if further.filter("moved").isEmpty():
            return further.select("word", "root")
        steps = further.select("word", "root")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, loses_letter: int | None = None,
                      cell_letters: int = CELL_LETTERS, part_words: int = PART_WORDS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every frequent word.

    ``form`` is the near word of largest ``n`` if that is at least ``ratio``
    times the word's own; ``root`` follows forms to the last.  Since ``n``
    grows at each step for a ratio above 1, forms have no circles.
    ``loses_letter`` deletes a letter of the occurrences whose hash it divides.
    """
    if ratio < 2 or min_length < 1 or min_count < 1:
        raise ValueError("ratio must be at least 2, min_length and min_count positive")
    runs = occurrences(df, id_col, text, min_length, loses_letter)
    counted = runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    words = materialize(counted, "words")
    near = words.join(near_words(words, cell_letters, part_words), "word", "left")
    related = F.col("best_n") >= F.col("n") * ratio
    formed = materialize(near.select("word", F.when(related, F.col("best")).alias("form"), "n",
                                     F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(related, F.col("best_n")).alias("form_n")), "forms")
    return formed.join(follow(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
