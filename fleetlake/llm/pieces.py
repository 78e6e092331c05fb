"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model compiles to three transducers: the normaliser (rewrite rules, then white space), the
lexicon (a trie of pieces) and byte fallback (an arc for each character the lexicon lacks). They
are composed with each input, and the shortest path in the tropical semiring is its encoding.

For a unigram model an arc weighs minus its piece's score. For a BPE model the weights stand on
pairs of arcs: two neighbouring pieces weigh 0 if merging their joint text yields just these two,
and infinity otherwise. Merges are ordered by score and position alone, so a merge across a border
would also happen in the two pieces' text on their own: a path of weight 0 is the result of the
merges, it is the only one, and each of its prefixes is one. One state per position is enough.

Where no piece spans two neighbouring characters the path can be cut; the parts between such cuts
(words, mostly) are encoded once and remembered, within a bound, by each Python worker.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of encoded parts that a worker remembers in each of two generations: a full one becomes the
#: older one, and of that only what is met again is taken over.
REMEMBERED = 64 << 20
#: Longer parts are not remembered.
LONGEST_REMEMBERED = 40

# Fixed values of the model format: field numbers and kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        length = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, blob[at : at + length]
        at += length


@dataclass
class Normaliser:
    """Rewrite rules (longest match from the left), then white space."""

    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    def __post_init__(self) -> None:
        self._units, self._texts = (), b""
        if self.charsmap:
            size = struct.unpack_from("<I", self.charsmap)[0]
            self._units = struct.unpack_from(f"<{size // 4}I", self.charsmap, 4)
            self._texts = self.charsmap[4 + size :]

    def _longest(self, data: bytes, start: int) -> tuple[int, int]:
        """Length of the longest rule at ``start`` and where its replacement lies; length 0 if none."""
        units = self._units
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        length = value = 0
        for i in range(start, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                length, value = i + 1 - start, units[node] & 0x7FFFFFFF
        return length, value

    def _rewritten(self, text: str) -> str:
        data, out, at = text.encode(), bytearray(), 0
        while at < len(data):
            length, value = self._longest(data, at)
            if length:
                out += self._texts[value : self._texts.index(b"\0", value)]
            else:
                first = data[at]
                length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                out += data[at : at + length]
            at += length
        return out.decode()

    def __call__(self, text: str) -> str:
        if self._units:
            text = self._rewritten(text)
        if self.remove_extra:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        if self.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.escape else text


@dataclass
class Model:
    """A compiled model. ``pieces``: (text, score, kind), by id."""

    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    normaliser: Normaliser
    memory: dict[str, tuple[int, ...]] = field(default_factory=dict)
    older: dict[str, tuple[int, ...]] = field(default_factory=dict)
    remembered: int = 0

    def __post_init__(self) -> None:
        if any(kind in (USER, UNUSED) for _, _, kind in self.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is not supported")
        self.ids = {text: i for i, (text, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.scores = {text: score for text, score, kind in self.pieces if kind == NORMAL}
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        self.byte_ids = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.worst = min(self.scores.values(), default=0.0) - 10.0
        self.longest = max(map(len, self.ids), default=1)
        self.trie: dict = {}
        for text in self.ids:
            node = self.trie
            for char in text:
                node = node.setdefault(char, {})
            node[""] = text
        self.pairs = {text[i : i + 2] for text in self.ids for i in range(len(text) - 1)}
        joined = {c for pair in self.pairs for c in pair}
        if any(pair[0] != SPACE and pair[1] == SPACE for pair in self.pairs):
            self.parts = None
        else:
            letters = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
            self.parts = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]" if letters else ".", re.DOTALL)
        self.borders: dict[str, dict[str, bool]] = {}
        self.bytes = [b"" if k in (CONTROL, UNKNOWN) else bytes([int(t[3:5], 16)]) if k == BYTE else t.replace(SPACE, " ").encode() for t, _, k in self.pieces]

    def merged(self, text: str) -> list[str]:
        """The BPE merges on a short text: best score first, leftmost among equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = -inf, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merge_path(self, text: str) -> list[str]:
        """The one path of finite weight, searched depth first, longest arcs first.

        Arcs are pieces, and the bare character where the lexicon lacks it. A position can be reached
        by one path only, so one from which the search came back is dead. The empty arc starts the
        path, so that pieces their own merges don't yield are out.
        """
        n, trie, borders = len(text), self.trie, self.borders
        path, left, open_arcs, dead, p = [], "", [], set(), 0
        while p < n:
            arcs = [text[p]]
            node = trie.get(text[p])
            q = p + 1
            while node is not None and q < n:
                node = node.get(text[q])
                q += 1
                if node is not None and "" in node:
                    arcs.append(node[""])
            while True:
                row = borders.get(left)
                if row is None:
                    row = borders[left] = {}
                found = False
                while arcs:
                    piece = arcs.pop()
                    joins = row.get(piece)
                    if joins is None:
                        joins = row[piece] = self.merged(left + piece) == ([left, piece] if left else [piece])
                    if joins and p + len(piece) not in dead:
                        found = True
                        break
                if found:
                    break
                dead.add(p)
                p -= len(path.pop())
                left = path[-1] if path else ""
                arcs = open_arcs.pop()
            path.append(piece)
            open_arcs.append(arcs)
            left = piece
            p += len(piece)
        return path

    def _score_path(self, text: str) -> list[str]:
        """The path of least total weight; of equal ones the one found first from the left."""
        n = len(text)
        cost, last = [0.0] + [inf] * n, [""] * (n + 1)
        for p in range(n):
            node, q = self.trie, p
            if text[p] not in self.ids and cost[p] - self.worst < cost[p + 1]:
                cost[p + 1], last[p + 1] = cost[p] - self.worst, text[p]
            while q < n and (node := node.get(text[q])) is not None:
                q += 1
                piece = node.get("")
                if piece is not None and cost[p] - self.scores[piece] < cost[q]:
                    cost[q], last[q] = cost[p] - self.scores[piece], piece
        path, q = [], n
        while q:
            path.append(last[q])
            q -= len(last[q])
        return path[::-1]

    def _path_ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in self._merge_path(text) if self.kind == BPE else self._score_path(text):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self.byte_fallback:
                ids += [self.byte_ids[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of a part, put together from what lies between the cuts inside it."""
        pairs, memory, n = self.pairs, self.memory, len(part)
        known = self.older.get(part)
        if known is not None:
            self._remember(part, known)
            return known
        cuts = [i for i in range(1, n) if part[i - 1 : i + 1] not in pairs]
        if cuts:
            ids: list[int] = []
            for a, b in zip([0, *cuts], [*cuts, n], strict=True):
                piece = part[a:b]
                known = memory.get(piece) or self.older.get(piece)
                if known is None:
                    known = tuple(self._path_ids(piece))
                    if b - a < LONGEST_REMEMBERED:
                        self._remember(piece, known)
                ids += known
            result = tuple(ids)
        else:
            result = tuple(self._path_ids(part))
        if n < LONGEST_REMEMBERED:
            self._remember(part, result)
        return result

    def _remember(self, part: str, ids: tuple[int, ...]) -> None:
        # A tuple of shared numbers, a text, and their place in the table.
        self.remembered += 230 + 2 * len(part) + 8 * len(ids)
        self.memory[part] = ids
        if self.remembered > REMEMBERED:
            self.older = dict(self.memory)
            self.memory.clear()  # others hold on to it
            self.remembered = 0

    def encode(self, text: str | None) -> np.ndarray:
        normal = self.normaliser(text or "")
        parts = self.parts.findall(normal) if self.parts else [normal] if normal else []
        get, part = self.memory.get, self._part
        ids = np.fromiter(chain.from_iterable([get(p) or part(p) for p in parts]), np.int32)
        if not self.byte_fallback and len(ids):  # neighbouring unknown characters are one piece
            ids = ids[~((ids == self.unknown) & np.r_[False, ids[:-1] == self.unknown])]
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.normaliser.dummy_prefix and text.startswith(" ") else text


def compile_model(blob: bytes) -> Model:
    """A serialized model as transducers. Models with user-defined or unused pieces are refused."""
    pieces, kind, fallback, rules = [], UNIGRAM, False, {1: b"", 2: b"", 3: 1, 4: 1, 5: 1}
    for number, value in _fields(blob):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            trainer = dict(_fields(value))
            kind, fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif number == 3:
            rules |= dict(_fields(value))
    return Model(pieces, kind, fallback, Normaliser(rules[2], bool(rules[3]), bool(rules[4]), bool(rules[5])))


_COMPILED: dict[bytes, Model] = {}


def _compiled(blob: bytes) -> Model:
    """The worker's compiled model, kept between tasks."""
    if blob not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[blob] = compile_model(blob)
    return _COMPILED[blob]


def encode_documents(docs: DataFrame, model_file: str = DEFAULT_MODEL) -> DataFrame:
    """All documents as tokens: ``doc_id``, ``n_chars``, ``n_tokens``, ``token_ids`` and
    ``round_trip`` (decoding gives the text back; the meta symbol for space counts as a space).

    The model file, of bounded size, is read by the driver and sent along with the tasks. Missing
    and empty texts have no tokens and round-trip. Equal rows get equal results, an empty table
    gives an empty one. Texts are encoded whole, where they are scanned.
    """
    with open(model_file, "rb") as file:
        blob = file.read()
    rows = docs.select("doc_id", whole_text().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _compiled(blob)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = batch.column(1).to_pylist()
                encoded = [model.encode(t) for t in texts]
                counts = [len(ids) for ids in encoded]
                same = [model.decode(ids.tolist()) == t.replace(SPACE, " ") for ids, t in zip(encoded, texts, strict=True)]
                offsets = np.zeros(len(texts) + 1, np.int32)
                np.cumsum(counts, out=offsets[1:])
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(encoded)))
                columns = [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), tokens, pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "n_tokens", "token_ids", "round_trip"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_chars long, n_tokens long, token_ids array<int>, round_trip boolean")


def decode_documents(tokens: DataFrame, model_file: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``token_ids``; missing tokens give empty text."""
    with open(model_file, "rb") as file:
        blob = file.read()
    rows = tokens.select("doc_id", F.coalesce("token_ids", F.array().cast("array<int>")).alias("token_ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _compiled(blob)
        for batch in batches:
            texts = pa.array([model.decode(ids) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {id_type}, text string")
