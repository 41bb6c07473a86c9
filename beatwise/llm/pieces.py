"""SentencePiece BPE encoding and decoding by a merge-type prefix table.

For every prefix of a text exactly one piece can be the last of the prefix's
encoding.  Walking left to right, the automaton lists the pieces that end at a
character; the one whose left neighbour (the last piece of the prefix before
it) is compatible with it is stored.  Ids are read off backwards.

Two pieces are compatible when merging their concatenation never joins
characters over the border between them.  That is tested on the pieces' own
merge histories, without merging the text.

Exactness rests on properties of the model that the constructor checks: no
piece but runs of the space mark holds that mark behind another character, so
a text falls apart before each mark; runs of the mark merge last, all at one
score, and get a small merge loop of their own.

Defined results: null and empty text have no ids and decode to an empty text;
unknown characters become their UTF-8 bytes; repeated rows are encoded each;
no row is longer or shorter than its whole text.
"""

from __future__ import annotations

import heapq
import sys
from array import array


import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The space mark, and piece types of the model file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words (in each of two generations) and pairs of pieces whose results a Python worker holds.
CACHE_WORDS = 250_000
CACHE_PAIRS = 400_000

ENCODED_TYPE = "struct<ids:array<int>,decoded:string>"


class PieceModel:
    """Encoder and decoder of one SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto  # only reads the file's tables

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix \
                or not model.trainer_spec.byte_fallback:
            raise ValueError("only identity-normalised models with a dummy prefix and byte fallback are supported")
        self.rank: dict[str, float] = {}  # lower merges first
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        self.is_byte = np.zeros(len(model.pieces), bool)
        self.unknown = model.trainer_spec.unk_surface.encode()
        for i, piece in enumerate(model.pieces):
            if piece.type == NORMAL:
                self.ids[piece.piece], self.rank[piece.piece] = i, -piece.score
                if SPACE in piece.piece.lstrip(SPACE):
                    raise ValueError("a piece holds the space mark behind other characters")
                self.surface.append(piece.piece.replace(SPACE, " ").encode())
            elif piece.type == BYTE:
                self.byte_ids[int(piece.piece[3:5], 16)] = i
                self.is_byte[i] = True
                self.surface.append(bytes([int(piece.piece[3:5], 16)]))
            else:
                self.surface.append(self.unknown if piece.type == UNKNOWN else b"")
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.compatible: dict[int, bool] = {}
        self.piece = [p.piece for p in model.pieces]
        self.length = [len(p) for p in self.piece]
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if p.strip(SPACE) == "" and len(p) > 1:
                continue  # runs of the mark are merged by merge_spaces
            if len(p) == 1 or self._split(p):
                self.automaton.add_word(p, (len(p), self.ids[p]))
        self.automaton.make_automaton()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut_lines = not any("\n" in p for p in self.ids)  # no piece holds a line break
        self.runs: dict[int, bytes] = {}

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``, or None if merging its characters does not."""
        if piece not in self.splits:
            parts, rank, last = list(piece), self.rank, None
            while len(parts) > 1:
                best, at = min((rank.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1))
                if best == np.inf:
                    last = None
                    break
                last = (parts[at], parts[at + 1])
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.splits[piece] = last
        return self.splits[piece]

    def _spine(self, piece: str, side: int) -> list[tuple[str, float]]:
        """Pieces at the ``side`` border (1: right, 0: left) of ``piece`` as it grows, with the rank that ends each."""
        known = self.spines[side]
        if piece not in known:
            chain, ends = [piece], [np.inf]
            while len(chain[-1]) > 1:
                ends.append(self.rank[chain[-1]])
                chain.append(self._split(chain[-1])[side])
            known[piece] = list(zip(chain[::-1], ends[::-1], strict=True))
        return known[piece]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the concatenation of two pieces leaves exactly these two."""
        a, b = self._spine(self.piece[left], 1), self._spine(self.piece[right], 0)
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            over = self.rank.get(x + y)
            # of equal ranks the leftmost merges first: left's own, the crossing one, right's own
            if over is not None and over < x_end and over <= y_end:
                return False
            if x_end == y_end == np.inf:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def last_pieces(self, text: str) -> list[int]:
        """Prefix table: at each character the id of its prefix's last piece, -1 at an unknown character."""
        table, known, spot = [-1] * len(text), self.compatible, len(self.piece)
        for end, (size, piece) in self.automaton.iter(text):
            if table[end] >= 0:
                continue
            before = end - size
            left = table[before] if before >= 0 else -1
            if left < 0:  # the text's begin, or an unknown character, which never merges
                table[end] = piece
                continue
            pair = left * spot + piece
            fit = known.get(pair)
            if fit is None:
                if len(known) >= CACHE_PAIRS:
                    known.clear()
                fit = known[pair] = self.fits(left, piece)
            if fit:
                table[end] = piece
        return table

    def _ids_of(self, text: str) -> list[int]:
        """Ids of a text without mark runs, recovered backwards from the prefix table."""
        table, length, at, found = self.last_pieces(text), self.length, len(text) - 1, []
        while at >= 0:
            piece = table[at]
            if piece < 0:
                found.extend([self.byte_ids[b] for b in reversed(text[at].encode("utf-8", "surrogatepass"))])
                at -= 1
            else:
                found.append(piece)
                at -= length[piece]
        found.reverse()
        return found

    def merge_spaces(self, n: int) -> list[int]:
        """Ids of ``n`` marks that merge among themselves only: best score first, then leftmost."""
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(self.rank[SPACE * 2], i, 2) for i in range(n - 1)] if SPACE * 2 in self.rank else []
        heapq.heapify(queue)
        while queue:
            _, i, total = heapq.heappop(queue)
            j = after[i]
            if not size[i] or j >= n or size[i] + size[j] != total:
                continue
            size[i], size[j], after[i] = total, 0, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and SPACE * (size[left] + size[right]) in self.rank:
                    joint = size[left] + size[right]
                    heapq.heappush(queue, (self.rank[SPACE * joint], left, joint))
        return [self.ids[SPACE * s] for s in size if s]

    def _run(self, n: int) -> bytes:
        if n not in self.runs:
            if len(self.runs) > 4096:
                self.runs.clear()
            self.runs[n] = array("i", self.merge_spaces(n)).tobytes()
        return self.runs[n]

    def _word(self, word: str) -> bytes:
        """Packed ids of a mark and a word.  Words seen lately are held, older ones dropped first."""
        ids = self.older.get(word)
        if ids is None:
            found = []
            for k, line in enumerate(word.split("\n") if self.cut_lines else [word]):
                if k:
                    found.append(self.byte_ids[10])
                if line or not k:
                    found += self._ids_of(line if k else SPACE + line)
            ids = array("i", found).tobytes()
        if len(self.words) >= CACHE_WORDS:
            self.older, self.words = self.words, {}
        self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, no begin or end ids."""
        if not text:
            return np.zeros(0, np.int32)
        packed, marks, known, mark = [], 0, self.words.get, self.ids[SPACE]
        for w in text.replace(SPACE, " ").split(" "):
            if w and not marks:
                ids = known(w)
                if ids is None:
                    ids = self._word(w)
                    known = self.words.get  # the generation may have changed
                packed.append(ids)
            elif not w:  # a mark without a word
                marks += 1
            else:
                ids = self._word(w)
                if int.from_bytes(ids[:4], sys.byteorder) == mark:  # the word's mark stayed bare and joins the run
                    marks, ids = marks + 1, ids[4:]
                packed += [self._run(marks), ids]
                marks = 0
        if marks:
            packed.append(self._run(marks))
        return np.frombuffer(b"".join(packed), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: marks become spaces, the first is dropped, byte pieces join to characters; control pieces have no text."""
        surface = self.surface
        pieces = [surface[i] for i in ids.tolist()]
        first = next((i for i, piece in enumerate(pieces) if piece), 0)
        if pieces and pieces[first][:1] == b" " and self.piece[ids[first]] in self.ids:
            pieces[first] = pieces[first][1:]
        try:
            return b"".join(pieces).decode()
        except UnicodeDecodeError:
            return self._decode_invalid(pieces, self.is_byte[ids].tolist())

    @staticmethod
    def _decode_invalid(pieces: list[bytes], is_byte: list[bool]) -> str:
        """As ``decode`` where byte pieces are no valid UTF-8: each stray byte is a replacement character."""
        found, run = [], b""
        for piece, byte in [*zip(pieces, is_byte, strict=True), (b"", False)]:
            if byte:
                run += piece
                continue
            while run:
                for size in range(1, 5):
                    try:
                        found.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    found.append("�")
                run = run[size:]
            found.append(piece.decode())
        return "".join(found)


_models: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """The model of a file, built once per Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_decode(text: Column, path: str) -> Column:
    """Struct ``ids`` and ``decoded`` of each whole text (see the module's defined results)."""

    @F.arrow_udf(ENCODED_TYPE)
    def run(texts: pa.Array) -> pa.Array:
        model = load(path)
        ids = [model.encode(t.as_py()) for t in texts]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
        decoded = pa.array([model.decode(x) for x in ids], pa.string())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends), flat), decoded], ["ids", "decoded"])

    return run(text)
