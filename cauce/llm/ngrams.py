"""Hashed n-gram features of many texts at once, and the labelled rows that a classifier may learn from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cauce.llm.words import Words, mix

#: Documents that a classifier learns from at most; the others are only scored.
SAMPLE = 16_384

#: What separates words here: ASCII other than letters, digits and the apostrophe.
NOT_LETTERS = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])
#: What separates runs of symbols: blanks, controls, letters, digits and bytes beyond ASCII.
NOT_SYMBOLS = np.array([b < 33 or b > 126 or chr(b).isalnum() for b in range(256)])

_U = np.uint64
_SALT = [_U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _grams(w: Words, h: np.ndarray, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and the word ``step`` further on, and the document of each."""
    owner = np.repeat(np.arange(w.n_docs), w.counts())
    if not step:
        return mix(h ^ _SALT[salt]), owner
    ok = np.flatnonzero(w.room(step + 1))
    return mix(h[ok] * _U(3) + mix(h[ok + step] ^ _SALT[salt])), owner[ok]


def features(column: pa.Array, bits: int, symbols: bool = False, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers below ``2 ** bits`` and the document of each, repeats included.

    Words, pairs of neighbours, and pairs that skip one word; with ``symbols`` also runs of symbols.
    """
    w = Words(column, NOT_LETTERS, lower=lower)
    h = w.hashes()
    parts = [_grams(w, h, step, step) for step in (0, 1, 2)]
    if symbols:
        s = Words(column, NOT_SYMBOLS)
        parts.append(_grams(s, s.hashes(), 0, 3))
    number = np.concatenate([p[0] for p in parts]) >> _U(64 - bits)
    return number.astype(np.int64), np.concatenate([p[1] for p in parts])


def per_document(number: np.ndarray, owner: np.ndarray, n_docs: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct features of each document and how often each occurs."""
    key = np.sort(owner << bits | number)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    cuts = np.searchsorted(key >> bits, np.arange(n_docs + 1))
    low = (key & ((1 << bits) - 1)).astype(np.int32)
    return [(low[a:b], times[a:b]) for a, b in zip(cuts, cuts[1:])]


def held_out(key: Column) -> Column:
    """One document in five, by CRC-32 of the key's text; a NULL key is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, label: Column, sample: int = SAMPLE) -> DataFrame:
    """``_order, text, label`` of at most ``sample`` labelled documents that are not held out, in one partition.

    Which ones depends on a hash of the key alone. Labels that are NULL, and keys that are NULL,
    teach nothing. The sample of the labels is bounded by ``sample`` rows, hence broadcast.
    """
    chosen = (
        labels.select("doc_id", label.alias("label")).dropna().dropDuplicates(["doc_id"])
        .filter(~held_out(F.col("doc_id")))
        .withColumn("_order", F.xxhash64(F.col("doc_id"))).orderBy("_order", "doc_id").limit(sample)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").select("_order", "text", F.col("label").cast("double").alias("label"))
    return found.repartition(1).sortWithinPartitions("_order", "text")
