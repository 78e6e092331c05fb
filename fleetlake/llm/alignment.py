"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Each text is encoded by both tokenizers. Offsets where tokens of both end cut it into groups; where two
tokens overlap, they are linked. Most groups are one token of each with equal bytes. For these a table
made once maps an A id to the B id of the same bytes, so such a pair is known by its A id alone: the
documents that hold it are counted in one vector as long as the vocabulary. Only the links of irregular
groups are counted as pairs, by a shuffle of partial counts.

Pairs that are common enough to be at most ``MOST_HOT`` (their counts have a sum, so that is certain)
meet the documents' links by a broadcast; no other pair has more than its share of rows in the join.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import combined, whole_text

FOLDER = "/opt/tokenizers"
TOKENIZER_A = f"{FOLDER}/byte_bpe_50k.json"
TOKENIZER_B = f"{FOLDER}/piece_bpe_32k.model"
#: Pairs looked up by broadcast; each is in at least this part of all (document, pair) rows.
MOST_HOT = 100_000
#: Characters of text encoded at once; a longer text goes alone.
AT_ONCE = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letters of a byte-level vocabulary: visible Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(others)}


def _objects(texts: list[str]) -> np.ndarray:
    made = np.empty(len(texts), object)
    made[:] = texts
    return made


class Vocabulary:
    """Bytes of each id, their lengths, and the ids in decimal with each separator."""

    def __init__(self, entries: list[bytes]) -> None:
        self.bytes = entries
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.comma = _objects([f"{i}," for i in range(len(entries))])


@dataclass
class Aligner:
    """Both tokenizers, and ``same``: for an A id the B id of the same bytes, or -1."""

    encode_a: Callable[[list[str]], list[list[int]]]
    encode_b: Callable[[list[str]], list[list[int]]]
    a: Vocabulary
    b: Vocabulary
    same: np.ndarray

    def __post_init__(self) -> None:
        self.last_a = _objects([f"{i}|" for i in range(len(self.a.bytes))])
        self.last_b = _objects([f"{i};" for i in range(len(self.b.bytes))])

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both; none for texts that are empty or that either does not give back byte by byte."""
        spaced = [f" {t}" for t in texts]
        ids_a, ids_b = self.encode_a(spaced), self.encode_b(texts)
        for i, text in enumerate(spaced):
            whole = text.encode()
            same = len(text) > 1 and all(b"".join([v.bytes[t] for t in ids]) == whole for v, ids in ((self.a, ids_a[i]), (self.b, ids_b[i])))
            if not same:
                ids_a[i], ids_b[i] = [], []
        return ids_a, ids_b


#: Fixed value: how a byte-level tokenizer cuts texts into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these letters, libraries may know different versions of Unicode.
_BEYOND_LATIN = re.compile("[^\\x00-\u024f]")


def ranked(described: dict, ids: dict[bytes, int]):  # noqa: ANN201
    """The same encoder by ranks of tokens in place of a list of merges, which is several times faster.

    Merging the pair whose joint token has the least id is the same as merging the first pair of the list,
    if the list is in order of these ids. None where it isn't, or where words are cut by other rules.
    """
    import tiktoken

    model, cut = described["model"], described["pre_tokenizer"]
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    plain = model["type"] == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    words = cut["type"] == "ByteLevel" and not cut["add_prefix_space"] and cut.get("use_regex", True)
    if not (plain and words and described["normalizer"] is None and min(made) >= 0 and made == sorted(made)):
        return None
    return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ids, special_tokens={})


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    """Both tokenizers, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path_a)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    with open(path_a, encoding="utf-8") as file:
        described = json.load(file)
    added = {entry["id"]: entry["content"].encode() for entry in described["added_tokens"]}
    known = {i: bytes(letters[c] for c in text) for text, i in described["model"]["vocab"].items() if i not in added} | added
    a = [known.get(i, b"") for i in range(max(known) + 1)]
    pieces = SentencePieceProcessor(model_file=path_b)
    texts = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    b = [bytes([int(t[3:5], 16)]) if pieces.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(texts)]
    # Where a byte has a piece of its own and a fallback, the piece is the usual one.
    of_bytes = {e: i for i, e in enumerate(b) if pieces.is_byte(i)}
    of_bytes |= {e: i for i, e in reversed(list(enumerate(b))) if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i))}
    same = np.array([of_bytes.get(e, -1) if e and i not in added else -1 for i, e in enumerate(a)], np.int64)

    def plain_a(spaced: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]

    ranks = ranked(described, {known[i]: i for i in described["model"]["vocab"].values()})

    def encode_a(spaced: list[str]) -> list[list[int]]:
        others = [i for i, t in enumerate(spaced) if ranks is None or _BEYOND_LATIN.search(t)]
        rest = iter(plain_a([spaced[i] for i in others]))
        slow = set(others)
        return [next(rest) if i in slow else ranks.encode_ordinary(t) for i, t in enumerate(spaced)]

    return Aligner(encode_a, lambda texts: pieces.encode(texts, num_threads=1), Vocabulary(a), Vocabulary(b), same)


@dataclass
class Aligned:
    """Of some texts: counts and groups of each, and their distinct links with the number of occurrences."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    doc: np.ndarray
    id_a: np.ndarray
    id_b: np.ndarray
    times: np.ndarray


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


def align(model: Aligner, texts: list[str]) -> Aligned:
    """All texts as one long sequence of bytes: both tokenizers' tokens end together where a text ends."""
    lists_a, lists_b = model.encoded(texts)
    n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (lists_a, lists_b))
    a, b = _flat(lists_a), _flat(lists_b)
    ends_a, ends_b = np.cumsum(model.a.lengths[a]), np.cumsum(model.b.lengths[b])
    # Between two neighbouring ends lies exactly one link: the tokens that cover it.
    ends = np.union1d(ends_a, ends_b)
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    id_a, id_b = a[at_a], b[at_b]
    doc = np.repeat(np.arange(len(texts)), n_a)[at_a]
    shared = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
    cuts = ends[shared]

    # Order of writing: a group's A ids, then its B ids.
    place_a = np.arange(len(a)) + np.append(0, np.searchsorted(ends_b, cuts, "right"))[np.searchsorted(cuts, ends_a)]
    place_b = np.arange(len(b)) + np.searchsorted(ends_a, cuts, "right")[np.searchsorted(cuts, ends_b)]
    written = np.empty(len(a) + len(b), object)
    written[place_a] = np.where(np.isin(ends_a, cuts, assume_unique=True), model.last_a[a], model.a.comma[a])
    written[place_b] = np.where(np.isin(ends_b, cuts, assume_unique=True), model.last_b[b], model.b.comma[b])
    borders = np.append(0, np.cumsum(n_a + n_b))
    groups = ["".join(written[s:e].tolist())[:-1] for s, e in zip(borders[:-1], borders[1:], strict=True)]

    size_a, size_b = len(model.a.bytes), len(model.b.bytes)
    key, times = np.unique((doc * size_a + id_a) * size_b + id_b, return_counts=True)
    return Aligned(
        n_a,
        n_b,
        np.bincount(doc[shared], minlength=len(texts)),
        np.bincount(doc, minlength=len(texts)),
        groups,
        key // (size_a * size_b),
        key // size_b % size_a,
        key % size_b,
        times,
    )


def _portions(texts: list[str | None]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


_PAIRS = "array<struct<a:int,b:int,times:int>>"
_SAME = "array<struct<a:int,times:int>>"


def _lists(doc: np.ndarray, count: int, columns: dict[str, np.ndarray]) -> pa.Array:
    """Rows of ``columns``, gathered by their ascending ``doc``."""
    offsets = pa.array(np.searchsorted(doc, np.arange(count + 1)).astype(np.int32))
    made = [pa.array(c.astype(np.int32)) for c in columns.values()]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(made, list(columns)))


def aligned_documents(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (its text), ``same`` and ``pairs``: a map.

    ``same`` lists a text's distinct links between tokens of the same bytes by their A id, ``pairs`` its
    other distinct links; ``times`` counts occurrences.
    """
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "same", "pairs"]
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(tokenizer_a, tokenizer_b)
        for batch in batches:
            at = 0
            for texts in _portions(batch.column(1).to_pylist()):
                ids = batch.column(0).slice(at, len(texts))
                at += len(texts)
                found = align(model, texts)
                equal = model.same[found.id_a] == found.id_b
                same = _lists(found.doc[equal], len(texts), {"a": found.id_a[equal], "times": found.times[equal]})
                other = ~equal
                pairs = _lists(found.doc[other], len(texts), {"a": found.id_a[other], "b": found.id_b[other], "times": found.times[other]})
                counts = [pa.array(c) for c in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                yield pa.RecordBatch.from_arrays([ids, *counts, pa.array(found.groups, pa.string()), same, pairs], names)

    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.mapInArrow(run, f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, groups string, same {_SAME}, pairs {_PAIRS}")


def _same_counts(aligned: DataFrame, size: int) -> np.ndarray:
    """For each A id, the documents that link it to the B id of the same bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = batch.column(0).flatten().field("a").to_numpy(zero_copy_only=False)
            total += np.bincount(ids, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["total"])

    def merge(parts: list[dict]) -> dict:
        return {"total": np.sum([p["total"] for p in parts], axis=0)}

    whole = combined(aligned.select("same").mapInArrow(run, "total array<long>").withColumn("slot", F.spark_partition_id()), merge)
    return np.array(whole["total"], np.int64) if whole else np.zeros(size, np.int64)


def _best(pairs: DataFrame, size: int) -> np.ndarray:
    """For each A id the highest count among ``pairs``; the vocabulary bounds the rows."""
    rows = pairs.groupBy("a").agg(F.max("docs").alias("best")).toArrow()
    best = np.zeros(size, np.int64)
    best[rows.column("a").to_numpy()] = rows.column("best").to_numpy()
    return best


def align_tokens(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> tuple[DataFrame, DataFrame]:
    """Per document its alignment and what the corpus says of its links; and the counted pairs.

    The first holds ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``, one row for each row of ``docs``; the second ``a``, ``b``, ``docs``, one row per linked
    pair of ids. A text that is missing, empty or not given back by both tokenizers has no tokens: zeros, an
    empty text for the digest. Repeated rows and ids count as documents of their own; a row without a
    ``doc_id`` counts like any other. An empty table gives empty results; other columns are not looked at.
    """
    spark = docs.sparkSession
    model = load(tokenizer_a, tokenizer_b)
    size, same = len(model.a.bytes), model.same
    made = aligned_documents(docs, tokenizer_a, tokenizer_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    counted = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    aligned = stored(made.select(F.monotonically_increasing_id().alias("row"), *counted, digest, "same", "pairs"), "aligned")

    links = aligned.select("row", F.inline("pairs"))
    vector = _same_counts(aligned, size)
    pairs = stored(links.groupBy("a", "b").agg(F.count("*").alias("docs")), "pairs")
    best = np.maximum(vector, _best(pairs, size))
    total = pairs.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]

    # One row per A id.
    highest = spark.createDataFrame(pa.table({"a": pa.array(np.arange(size), pa.int32()), "best": best}))
    judged = pairs.join(F.broadcast(highest), "a").select("a", "b", "docs", (F.col("docs") == F.col("best")).cast("long").alias("is_best"))
    is_hot = F.col("docs") * MOST_HOT >= total
    hot, rare = F.broadcast(judged.where(is_hot)), judged.where(~is_hot)
    judged_links = links.join(hot, ["a", "b"]).unionByName(links.join(hot, ["a", "b"], "left_anti").join(rare, ["a", "b"]))
    sums = judged_links.groupBy("row").agg(
        F.sum(F.col("times") * F.col("is_best")).alias("other_best"), F.sum(F.col("times") * F.col("docs")).alias("other_sum")
    )

    is_best = (vector == best).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat = lists.flatten()
            ids = flat.field("a").to_numpy(zero_copy_only=False)
            times = flat.field("times").to_numpy(zero_copy_only=False).astype(np.int64)
            borders = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            sums = [np.append(0, np.cumsum(times * of_id[ids])) for of_id in (is_best, vector)]
            made = [pa.array(s[borders[1:]] - s[borders[:-1]]) for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "same_best", "same_sum"])

    plain = aligned.select("row", *counted, "groups_sha256", "same")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    regular = plain.mapInArrow(run, f"{schema}, same_best long, same_sum long")
    zero = F.lit(0).cast("long")
    per_document = regular.join(sums, "row", "left").select(
        *counted,
        (F.col("same_best") + F.coalesce("other_best", zero)).alias("n_best"),
        (F.col("same_sum") + F.coalesce("other_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
    regular_pairs = spark.createDataFrame(pa.table({"a": pa.array(np.arange(size), pa.int32()), "b": pa.array(same, pa.int32()), "docs": vector}))
    return per_document, pairs.unionByName(regular_pairs.where("docs > 0"))
