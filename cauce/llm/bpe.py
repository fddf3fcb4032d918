"""Byte-level BPE with a contiguous rank array, for a vocabulary file of the tokenizers library.

A text is cut at its special tokens, then into pieces by the byte-level pattern. A short piece
holds its parts and the ranks of neighbouring pairs in two plain arrays: the least rank is found
by a scan, its boundary deleted, and the ranks on both sides refreshed. Pieces that come again
are answered from a bounded cache.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.registry import query, table
from cauce.llm.words import slices

#: Pieces longer than this are merged by a heap over linked parts instead of the scanned array.
SHORT = 256
#: Entries of each of the two cache generations of a Python worker.
CACHE = 400_000
_NONE = 1 << 60

# The byte-level pattern; white space is Unicode's property, which Python's \s exceeds.
_PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# The same over U+0000 .. U+00FF, spelled out for the quicker engine.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \x85\xa0"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def default_vocabulary() -> str:
    """The public 50k byte-level vocabulary; any file of the same kind can be named instead."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others by code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in set(own) else next(others) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        ids = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.of_byte = [ids[c] for c in byte_letters()]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[a] << 32 | ids[b]] = len(self.made)
            self.made.append(ids[a + b])
        self.special = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("special tokens that take neighbours along are not supported")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        self.size = max(self.bytes_of, default=-1) + 1
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        return self._scan(piece) if len(piece) <= SHORT else self._heap(piece)

    def _scan(self, piece: bytes) -> list[int]:
        part = [self.of_byte[b] for b in piece]
        get, made = self.rank.get, self.made
        rank = [get(a << 32 | b, _NONE) for a, b in zip(part, part[1:])]
        while rank:
            least = min(rank)
            if least == _NONE:
                break
            i = rank.index(least)
            part[i] = made[least]
            del part[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(part[i] << 32 | part[i + 1], _NONE)
            if i:
                rank[i - 1] = get(part[i - 1] << 32 | part[i], _NONE)
        return part

    def _heap(self, piece: bytes) -> list[int]:
        part = [self.of_byte[b] for b in piece]
        n, get = len(part), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(part[i] << 32 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= n or get(part[i] << 32 | part[j]) != r:
                continue
            part[i], part[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (s := get(part[a] << 32 | part[after[a]])) is not None:
                    heapq.heappush(heap, (s, a))
        return [p for p in part if p >= 0]


def pieces_of(text: str) -> list[str]:
    """The pieces of a text without special tokens."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _PATTERN.findall(text)
    return _LATIN.findall(text)


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes.

    ``merge`` turns a piece's bytes into ids; without it the rank array of this module does.
    """

    def __init__(self, path: str, merge: Callable[[bytes], Iterable[int]] | None = None):
        self.vocabulary = Vocabulary(path)
        self.merge = merge or self.vocabulary.merge
        encoder = self

        class Cache(dict):
            old: dict[str, bytes] = {}

            def __missing__(self, piece: str) -> bytes:
                value = self.old.get(piece)
                if value is None:
                    value = array("I", encoder.merge(piece.encode())).tobytes()
                if len(piece) <= 64:
                    if len(self) >= CACHE:
                        self.old = dict(self)
                        self.clear()
                    self[piece] = value
                return value

        self.known = Cache()

    def encode(self, text: str) -> bytes:
        cut = self.vocabulary.cut
        if cut is None or not cut.search(text):
            return b"".join(map(self.known.__getitem__, pieces_of(text)))
        out = []
        for part in cut.split(text):
            special = self.vocabulary.special.get(part)
            if special is not None:
                out.append(array("I", [special]).tobytes())
            else:
                out.extend(map(self.known.__getitem__, pieces_of(part)))
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and file, kept between tasks."""
    return Encoder(path)


def _nested(parts: list[bytes]) -> pa.Array:
    """Packed ids as a list column."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def _with(docs: DataFrame, adds: dict[str, str], need: str, make, limit: int) -> DataFrame:
    kept = [c for c in docs.columns if c not in adds]
    schema = docs.select(*kept, *[F.lit(None).cast(t).alias(c) for c, t in adds.items()]).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, need, limit):
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *make(part.column(need))], [*kept, *adds])

    return docs.select(*kept).mapInArrow(run, schema)


def encode_texts(docs: DataFrame, vocabulary: str | None = None, text: str = "text", out: str = "ids",
                 decoded: str | None = None) -> DataFrame:
    """Add ``out``: ``array<int>`` of the text's ids, and in the same pass ``decoded``, their text, if named.

    NULL is taken as an empty text, which has no ids. Special tokens in a text get their own ids.
    Every text is encoded whole; other columns stay, a column named ``out`` or ``decoded`` is
    replaced; repeated rows and empty tables are fine. ``vocabulary`` is a path that every
    executor has, as libraries are.
    """
    path = vocabulary or default_vocabulary()

    def make(column: pa.Array) -> list[pa.Array]:
        e = encoder(path)
        parts = [e.encode(t or "") for t in column.to_pylist()]
        back = [pa.array([e.decode(memoryview(p).cast("I")) for p in parts], pa.string())] if decoded else []
        return [_nested(parts), *back]

    return _with(docs, {out: "array<int>", **({decoded: "string"} if decoded else {})}, text, make, 2 << 20)


def decode_ids(docs: DataFrame, vocabulary: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the ids, with special tokens; bytes that are no UTF-8 become U+FFFD.

    NULL ids give an empty text; an id that the vocabulary lacks is an error.
    """
    path = vocabulary or default_vocabulary()
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept, F.lit(None).cast("string").alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            texts = [e.decode(x or ()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
