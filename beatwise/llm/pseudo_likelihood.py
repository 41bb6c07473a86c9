"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts every token from the tokens on both of its sides; a
document's score is the sum of the log-probabilities of its tokens.  A token's
code has two digits; the first is predicted from the context, the second from
the context and the first, so a probability costs two short softmaxes.

Training is numpy in Spark tasks: the corpus is dealt to rounds by a hash; in
each round every task takes the current parameters through all its texts of
that round by minibatch steps, and the results are averaged by token count,
per slice of the parameters and in two levels, so no task and not the driver
sees more than a model's size per group of tasks.  Every text of the corpus is
counted and trained on.

The number of tokens grows with the square root of the number of different
words.  Words without a token of their own share hashed ones.  Inside its token
each of them has its own share: P(word) = P(token | context) x P(word | token),
the latter from the counts of every word of the corpus, smoothed towards a
spelling of uniform bytes with as much weight as the token has distinct words.
An unseen word has only its spelling.

Texts are split and coded once; training and scoring read the codes, a round
only its own part.  Counts stay a table: a run of texts of bounded size asks
once for each of its different rare words, and sums the answers per text.

Defined results: null and empty text: no tokens, score 0; beyond a text's ends
stands a padding token; repeated rows are scored each; an empty corpus leaves
the initial network; a model of two parts, without shares, scores tokens only;
a text without tokens has a null ``per_token``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialize, pack

#: Digits of a token code at least (a code has two), context on each side, hidden units.
DIGIT, REACH, HIDDEN = 32, 2, 24
#: Training: rounds of averaging, tokens of a step, step size.
ROUNDS, BATCH, RATE, SEED = 3, 4096, 0.08, 42
#: Slices the parameters are averaged in, and tasks that meet on each level.
SLICES, GROUP = 32, 64
OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]
#: Bytes of text whose rare words are asked for together.
RUN_BYTES = 16 << 20


class Vocabulary(NamedTuple):
    """Tokens of frequent words, and the number of digits of a token code; the other tokens are shared."""

    own: dict[bytes, int]
    digit: int = DIGIT

    @property
    def tokens(self) -> int:
        """Number of tokens, and the token of what is beyond a text's ends."""
        return self.digit * self.digit


def split(text: str | None) -> list[bytes]:
    """Words of a whole text, in lower case."""
    return words_in(pa.array([text], pa.string()))[0].cast(pa.binary()).to_pylist()


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts one after the other, in lower case, and how many each has; ASCII white space separates."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    flat, edges = lists.values, lists.offsets.to_numpy()
    there = pc.not_equal(flat, "")  # none at either end of a text
    seen = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    return flat.filter(there), seen[edges[1:]] - seen[edges[:-1]]


def runs_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``RUN_BYTES``."""
    size = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin, done = 0, 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(size, done + RUN_BYTES, "right")))
        yield begin, end
        begin, done = end, size[end - 1]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every word of all texts and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in runs_of(batch["text"]):
                found = words_in(batch["text"].slice(a, b - a))[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()).cast(pa.binary()), found.field("counts")],
                                                 ["word", "count"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, count bigint")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The most frequent words (ties by word) for three quarters of the tokens, which are as many as the square root of all words."""
    digit = max(DIGIT, math.ceil(counted.count() ** 0.25))
    rows = counted.orderBy(F.desc("count"), "word").limit(3 * digit * digit // 4).collect()
    return Vocabulary({bytes(r["word"]): i for i, r in enumerate(rows)}, digit)


def encode(text: str | None, words: Vocabulary) -> np.ndarray:
    """Token of every word of a whole text."""
    return _encode(split(text), words)


def _encode(found: list[bytes], words: Vocabulary) -> np.ndarray:
    first, own = len(words.own), words.own
    room, digest = words.tokens - first, xxhash.xxh64_intdigest
    return np.array([first + digest(w) % room if (token := own.get(w)) is None else token for w in found], np.int64)


#: Shares are added as whole numbers of this unit, so that sums do not depend on the order.
UNIT = 1e-9
#: Uniform spelling: one of 256 bytes or the end of the word.
SPELL = math.log(257)


class Shares(NamedTuple):
    """P(word | shared token): ``floor`` is the log of an unseen word's share for each token, less ``SPELL``
    a byte; ``gains`` (hash of the word, gain in ``UNIT``) is what each counted word has above that."""

    floor: np.ndarray
    gains: DataFrame


def _signed(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def word_shares(counted: DataFrame, words: Vocabulary) -> Shares:
    """Shares of all words outside the vocabulary; two numbers a token reach the driver."""
    first = len(words.own)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, distinct = np.zeros(words.tokens, np.int64), np.zeros(words.tokens, np.int64)
        for batch in batches:
            tokens = _encode(batch["word"].to_pylist(), words)
            np.add.at(running, tokens, batch["count"].to_numpy())
            np.add.at(distinct, tokens, 1)
        at = np.flatnonzero(distinct[first:]) + first
        yield pa.RecordBatch.from_pydict({"token": at, "running": running[at], "distinct": distinct[at]})

    found = counted.mapInArrow(totals, "token bigint, running bigint, distinct bigint").groupBy("token").agg(
        F.sum("running").alias("running"), F.sum("distinct").alias("distinct")).collect()
    weight, running = np.ones(words.tokens), np.zeros(words.tokens)
    for r in found:
        weight[r["token"]] += r["distinct"]
        running[r["token"]] = r["running"]
    prior = np.log(weight) + math.log(words.tokens - first) - SPELL
    floor = prior - np.log(running + weight)

    def gain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["word"].to_pylist()
            tokens, size = _encode(found, words), np.fromiter(map(len, found), np.int64, len(found))
            above = np.logaddexp(0, np.log(batch["count"].to_numpy()) - prior[tokens] + SPELL * size)
            tail = np.flatnonzero(tokens >= first)
            yield pa.RecordBatch.from_pydict({"mark": np.fromiter((_signed(found[i]) for i in tail), np.int64, len(tail)),
                                              "gain": np.rint(above[tail] / UNIT).astype(np.int64)})

    return Shares(floor, materialize(counted.mapInArrow(gain, "mark bigint, gain bigint"), "shares"))


class WindowNet:
    """Tables for each context place, tanh, and a softmax head for each digit; all float32 in one vector."""

    def __init__(self, digit: int = DIGIT, vector: np.ndarray | None = None):
        self.digit, self.shapes = digit, {
            "tables": (len(OFFSETS), digit * digit + 1, HIDDEN), "bias": (HIDDEN,), "first": (HIDDEN, digit),
            "first_bias": (digit,), "second": (HIDDEN, digit), "second_bias": (digit, digit)}
        size = sum(math.prod(s) for s in self.shapes.values())
        if vector is None:
            vector = np.random.default_rng(SEED).normal(0, 0.1, size).astype(np.float32)
        self.vector, at = np.array(vector, np.float32), 0
        for name, shape in self.shapes.items():
            n = math.prod(shape)
            setattr(self, name, self.vector[at:at + n].reshape(shape))
            at += n
        self._held: dict[str, np.ndarray] = {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array of no certain content, the same memory in every step: the first touch of new memory costs more than the sums in it."""
        size, held = math.prod(shape), self._held.get(name)
        if held is None or held.size < size:
            held = self._held[name] = np.empty(size, np.float32)
        return held[:size].reshape(shape)

    def contexts(self, tokens: np.ndarray) -> np.ndarray:
        """Tokens around each token of one text: a row per place."""
        beyond = np.full(REACH, self.digit * self.digit)
        padded = np.concatenate((beyond, tokens, beyond))
        return np.stack([padded[REACH + o:REACH + o + len(tokens)] for o in OFFSETS])

    def _rows(self, table: np.ndarray, at: np.ndarray, name: str) -> np.ndarray:
        return table.take(at, axis=0, out=self._room(name, len(at), table.shape[1]), mode="clip")

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden units of each token, good until the next step."""
        total = self._rows(self.tables[0], context[0], "hidden")
        for table, place in zip(self.tables[1:], context[1:], strict=True):
            total += self._rows(table, place, "units")
        total += self.bias
        return np.tanh(total, out=total)

    def _exponents(self, h: np.ndarray, a: np.ndarray, ends: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For both digits the exponentials of the logits, those of a piece of text scaled alike, and their sums by row
        (a product with ones is the fastest sum of short rows)."""
        first = np.matmul(h, self.first, out=self._room("first", len(h), self.digit))
        first += self.first_bias
        second = np.matmul(h, self.second, out=self._room("second", len(h), self.digit))
        second += self._rows(self.second_bias, a, "digits")
        found, ones = [], np.ones(self.digit, np.float32)
        for x in (first, second):
            total, pieces = np.empty(len(x), np.float32), list(zip([0, *ends[:-1]], ends, strict=True))
            for begin, end in pieces:
                x[begin:end] -= x[begin:end].max(initial=0)
            np.exp(x, out=x)
            for begin, end in pieces:
                np.matmul(x[begin:end], ones, out=total[begin:end])
            found.append((x, np.maximum(total, np.float32(1e-30), out=total)))
        return found

    def log_probabilities(self, context: np.ndarray, tokens: np.ndarray, ends: list[int] | None = None) -> np.ndarray:
        """Log-probability of each token given its context; a piece of text, which ends at each of ``ends``, has the same beside any other."""
        h, digits, rows = self.hidden(context), np.divmod(tokens, self.digit), np.arange(len(tokens))
        first, second = (np.log(np.maximum(x[rows, at], np.float32(1e-30)) / total) for (x, total), at in zip(
            self._exponents(h, digits[0], ends or [len(tokens)]), digits, strict=True))
        return first + second

    def train(self, context: np.ndarray, tokens: np.ndarray, seen: WindowNet) -> None:
        """One step of adaptive gradient descent; ``seen`` sums the squared gradients."""
        h, (a, b), n = self.hidden(context), np.divmod(tokens, self.digit), len(tokens)
        rows, scale = np.arange(n), np.float32(1 / n)
        for (x, total), at in zip(found := self._exponents(h, a, [n]), (a, b), strict=True):
            x /= total[:, None]
            x[rows, at] -= 1
        (p, _), (q, _) = found
        back, units = self._room("back", n, HIDDEN), self._room("units", n, HIDDEN)
        np.matmul(p, self.first.T, out=back)
        back += np.matmul(q, self.second.T, out=units)
        back *= np.subtract(1, np.multiply(h, h, out=units), out=units)
        second_bias = np.zeros_like(self.second_bias)
        order, runs = _runs(a)
        second_bias[a[order[runs]]] = np.add.reduceat(self._rows(q, order, "digits"), runs)
        for name, g in (("first", h.T @ p), ("first_bias", p.sum(axis=0)), ("second", h.T @ q),
                        ("second_bias", second_bias), ("bias", back.sum(axis=0))):
            value, squares = getattr(self, name), getattr(seen, name)
            value -= self._change(squares, g * scale)
        for place, ids in enumerate(context):
            order, runs = _runs(ids)
            gradient, at = np.add.reduceat(self._rows(back, order, "units"), runs), ids[order[runs]]
            gradient *= scale
            value, squares = self.tables[place], seen.tables[place].take(at, axis=0)
            value[at] = value.take(at, axis=0) - self._change(squares, gradient)
            seen.tables[place][at] = squares

    @staticmethod
    def _change(squares: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """What a step takes from values whose squared gradients sum to ``squares`` before it."""
        squares += gradient * gradient
        size = np.sqrt(squares)
        size += np.float32(1e-6)
        return np.divide(np.float32(RATE) * gradient, size, out=size)


def _runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    small = ids.astype(np.uint16) if ids.size and ids.max() < 1 << 16 else ids  # sorts by radix
    order = np.argsort(small, kind="stable")
    ordered = small[order]
    return order, np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def _steps(texts: Iterator[np.ndarray], net: WindowNet) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Contexts and tokens of about ``BATCH`` tokens at a time, texts one after the other, and where their pieces end."""
    beyond, held, sizes, size = np.full(REACH, net.digit * net.digit), [], [], 0

    def step() -> tuple[np.ndarray, np.ndarray, list[int]]:
        padded, ends = np.concatenate(held), np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(REACH * np.arange(1, 2 * len(sizes), 2), sizes)
        return np.stack([padded.take(at + o) for o in OFFSETS]), padded.take(at), ends.tolist()

    for tokens in texts:
        padded = np.concatenate((beyond, tokens, beyond))
        for at in range(0, len(tokens), BATCH):
            sizes.append(min(BATCH, len(tokens) - at))
            held.append(padded[at:at + sizes[-1] + 2 * REACH])
            size += sizes[-1]
            if size >= BATCH:
                yield step()
                held, sizes, size = [], [], 0
    if sizes:
        yield step()


def coded(docs: DataFrame, text: str, words: Vocabulary, keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` once split and coded, staged by training round: ``row``, ``id``, ``tokens``, ``run``, ``rare``, ``marks``, ``bytes``.

    Rare words are numbered inside a run of texts of about ``RUN_BYTES``;
    ``rare`` are the numbers of a text's rare words, ``bytes`` their length,
    ``marks`` (with the last text of a run) the hashes of all of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    packed = pack(docs, keep, text=F.col(text), id=F.monotonically_increasing_id(),
                  round=F.coalesce(F.pmod(F.xxhash64(F.col(text)), F.lit(rounds)), F.lit(0)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        width = _width(known)
        first, own, room = len(known.own), known.own, known.tokens - len(known.own)
        kinds = {"tokens": pa.binary(), "run": pa.int64(), "rare": pa.binary(), "marks": pa.binary(), "bytes": pa.int64()}
        for batch in batches:
            out, ids = {k: [] for k in kinds}, batch["id"].to_numpy()
            for begin, end in runs_of(batch["text"]):
                flat, count = words_in(batch["text"].slice(begin, end - begin))
                coded = flat.dictionary_encode()
                distinct, place = coded.dictionary.cast(pa.string()).cast(pa.binary()).to_pylist(), coded.indices.to_numpy()
                # what each different word of the run is: its token, and if it is rare its number, hash and length
                token = np.fromiter((own.get(w, -1) for w in distinct), np.int64, len(distinct))
                rare = np.flatnonzero(token < 0)
                marks = np.fromiter((xxhash.xxh64_intdigest(distinct[i]) for i in rare), np.uint64, len(rare))
                token[rare] = first + (marks % np.uint64(room)).astype(np.int64)
                number, size = np.full(len(distinct), -1, np.int32), np.zeros(len(distinct), np.int64)
                number[rare] = np.arange(len(rare))
                size[rare] = [len(distinct[i]) for i in rare]
                tokens, numbers, sizes = token.astype(width)[place], number[place], np.concatenate(([0], np.cumsum(size[place])))
                edge = np.concatenate(([0], np.cumsum(count)))
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    own_numbers = numbers[a:b]
                    out["tokens"].append(tokens[a:b].tobytes())
                    out["rare"].append(own_numbers[own_numbers >= 0].tobytes())
                    out["bytes"].append(int(sizes[b] - sizes[a]))
                out["run"] += [int(ids[begin])] * (end - begin)
                out["marks"] += [None] * (end - begin - 1) + [marks.tobytes()]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["id"], batch["round"], *[pa.array(out[c], kinds[c]) for c in out]],
                                             ["row", "id", "round", *out])

    schema = StructType([*(packed.schema[c] for c in ("row", "id", "round"))]).add("tokens", "binary").add("run", "long").add(
        "rare", "binary").add("marks", "binary").add("bytes", "long")
    return materialize(packed.select("row", "text", "id", "round").mapInArrow(run, schema), "coded", parts=["round"])


def _width(words: Vocabulary) -> type[np.unsignedinteger]:
    return np.uint16 if words.tokens < 1 << 16 else np.uint32


def _tokens(batches: Iterator[pa.RecordBatch], words: Vocabulary) -> Iterator[np.ndarray]:
    width = _width(words)
    for batch in batches:
        for t in batch["tokens"]:
            yield np.frombuffer(t.as_py(), width).astype(np.int64)


def _weighted_sum(table: pa.Table) -> tuple[int, np.ndarray]:
    """Sum of rows ``(task, tokens, part)`` in task order, so that it does not depend on the shuffle."""
    table = table.sort_by("task")
    total = sum(np.frombuffer(p, np.float64) for p in table["part"].to_pylist())
    return sum(table["tokens"].to_pylist()), total


def train_round(codes: DataFrame, words: Vocabulary, vector: np.ndarray) -> np.ndarray:
    """Parameters after every task has trained on its texts, averaged by tokens."""
    shared = codes.sparkSession.sparkContext.broadcast((words, vector))
    cuts = np.linspace(0, len(vector), SLICES + 1).astype(int)
    kind = "slice int, task int, tokens bigint, part binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, start = shared.value
        net, seen, n = WindowNet(known.digit, start), WindowNet(known.digit, np.zeros(len(start))), 0
        for context, tokens, _ in _steps(_tokens(batches, known), net):
            net.train(context, tokens, seen)
            n += len(tokens)
        if n:
            whole = net.vector.astype(np.float64) * n
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(range(SLICES), pa.int32()), "task": pa.array([task] * SLICES, pa.int32()),
                "tokens": pa.array([n] * SLICES, pa.int64()),
                "part": pa.array([whole[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        n, part = _weighted_sum(table)
        task = min(table["task"].to_pylist()) // GROUP
        return pa.table({"slice": pa.array([table["slice"][0].as_py()], pa.int32()), "task": pa.array([task], pa.int32()),
                         "tokens": pa.array([n], pa.int64()), "part": pa.array([part.tobytes()], pa.binary())})

    level = codes.select("tokens").mapInArrow(run, kind)
    tasks = max(1, len(codes.inputFiles()))  # at least one file a task wrote, so about as many tasks; sets of GROUP at each level
    while tasks > 1:
        level = level.groupBy("slice", F.floor(F.col("task") / GROUP).alias("set")).applyInArrow(add, kind)
        tasks = math.ceil(tasks / GROUP)
    rows = level.groupBy("slice").applyInArrow(add, kind).collect()  # one model's size
    if not rows:
        return vector
    rows.sort(key=lambda r: r["slice"])
    return np.concatenate([np.frombuffer(r["part"], np.float64) / r["tokens"] for r in rows]).astype(np.float32)


def train(codes: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters from all coded texts: each is in exactly one round, which reads no other."""
    vector = WindowNet(words.digit).vector
    for k in range(rounds):
        vector = train_round(codes.filter(F.col("round") == k), words, vector)
    return vector


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and parameters from all texts."""
    words = vocabulary(materialize(word_counts(docs, text), "words"))
    return words, train(coded(docs, text, words, [text], rounds), words, rounds)


def fit_words(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray, Shares]:
    """As ``fit``, with the shares of the words outside the vocabulary."""
    return _fit(docs, text, rounds, [text])[0]


def _fit(docs: DataFrame, text: str, rounds: int, keep: list[str] | None) -> tuple[tuple, DataFrame]:
    """A model of three parts, and the coded texts it was trained on."""
    counted = materialize(word_counts(docs, text), "words")
    words = vocabulary(counted)
    codes = coded(docs, text, words, keep, rounds)
    return (words, train(codes, words, rounds), word_shares(counted, words)), codes


def token_scores(codes: DataFrame, words: Vocabulary, vector: np.ndarray, floor: np.ndarray | None) -> DataFrame:
    """``codes`` with ``n`` and ``log_probability`` of their tokens; with ``floor`` rare words count as unseen inside theirs."""
    shared = codes.sparkSession.sparkContext.broadcast((words, vector, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parameters, unseen = shared.value
        net, inside = WindowNet(known.digit, parameters), np.zeros(known.tokens)
        if unseen is not None:
            inside[len(known.own):] = unseen[len(known.own):]
        for batch in batches:
            counts = pc.divide(pc.binary_length(batch["tokens"]), _width(known)().itemsize).to_numpy(zero_copy_only=False)
            found = []
            for context, tokens, ends in _steps(_tokens([batch], known), net):
                whole, rare = net.log_probabilities(context, tokens, ends), inside.take(tokens)
                found += [float(whole[a:b].sum(dtype=np.float64) + rare[a:b].sum()) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            sums = np.zeros(len(counts))
            np.add.at(sums, np.repeat(np.arange(len(counts)), -(-counts // BATCH)), found)
            if unseen is not None:
                sums -= SPELL * batch["bytes"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["row"], batch["id"], pa.array(counts, pa.int64()), pa.array(sums, pa.float64())],
                                             ["row", "id", "n", "log_probability"])

    schema = StructType([codes.schema["row"], codes.schema["id"]]).add("n", "long").add("log_probability", "double")
    return codes.select("row", "id", "tokens", "bytes").mapInArrow(run, schema)


def rare_gains(codes: DataFrame, gains: DataFrame) -> DataFrame:
    """``(id, gain)`` of every text with rare words: what they have above unseen words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, marks in zip(batch["run"].to_pylist(), batch["marks"].to_pylist(), strict=True):
                found = np.frombuffer(marks, np.int64)
                for at in range(0, len(found), 1 << 16):
                    part = found[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_pydict({"run": np.full(len(part), start), "place": np.arange(at, at + len(part), dtype=np.int32),
                                                      "mark": part})

    def add(texts: pa.Table, answers: pa.Table) -> pa.Table:
        rare = [np.frombuffer(r, np.int32) for r in texts["rare"].to_pylist()]
        gain = np.zeros(max((int(r.max()) + 1 for r in rare if len(r)), default=0), np.int64)
        gain[answers["place"].to_numpy()] = answers["gain"].to_numpy()
        return pa.table({"id": texts["id"].combine_chunks() if texts.num_rows else pa.array([], pa.int64()),
                         "gain": pa.array([int(gain[r].sum()) for r in rare], pa.int64())})

    asked = codes.filter(F.octet_length("marks") > 0).select("run", "marks").mapInArrow(ask, "run bigint, place int, mark bigint")
    answers = asked.join(gains.hint("shuffle_hash"), "mark").select("run", "place", "gain")
    texts = codes.filter(F.octet_length("rare") > 0).select("run", "id", "rare")
    return texts.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(add, "id bigint, gain bigint")


def score_documents(docs: DataFrame, text: str = "text", out: str = "score", model: tuple | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``out`` (replaced if there): ``tokens``, ``log_probability``, ``per_token``.

    ``model`` is what ``fit_words`` returns, or ``fit`` for the score of the
    tokens; without it a model is fitted to all of ``docs``.  A rare word is a
    key of the join once per run of texts that holds it, however often it occurs.
    """
    names = keep or docs.columns
    if model is None:
        model, codes = _fit(docs, text, ROUNDS, keep)
    else:
        codes = coded(docs, text, model[0], keep)
    words, vector, *shares = model
    scored = token_scores(codes, words, vector, shares[0].floor if shares else None)
    total = F.col("log_probability")
    if shares:
        found = rare_gains(codes, shares[0].gains).withColumnRenamed("id", "found")
        scored = scored.join(found, scored["id"] == found["found"], "left")
        total = total + F.coalesce("gain", F.lit(0)) * F.lit(UNIT)
    result = F.struct(F.col("n").alias("tokens"), total.alias("log_probability"), (total / F.nullif("n", F.lit(0))).alias("per_token"))
    return scored.select(*[F.col("row").getField(c).alias(c) for c in names if c != out], result.alias(out))
