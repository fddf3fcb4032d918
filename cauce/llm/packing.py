"""Packing by lexical retrieval: windows are filled with the seed's BM25 neighbours.

Documents are encoded once and written: whole windows of a long document stand alone, its rest is
to be packed. The terms of the index are token ids, so corpus-wide document counts are one array
of the vocabulary's size. Rests are range-partitioned and sorted by content: by their rarest terms
that other documents have too, copies of one text by a hash of the row. Runs of this order are the
shards; each has an inverted index, from which a seed takes its best unused neighbours until its
window is full. Only the last window of a partition can stay short.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.bpe import Encoder, default_vocabulary
from cauce.llm.registry import query, table
from cauce.llm.words import distinct, slices
from cauce.sources.scratch import materialise

WINDOW = 1024
END = 0
#: Terms of the key by which rests are sorted, the rarest first.
KEY_TERMS = 8
#: Rests and tokens of one shard: what bounds its index in memory.
SHARD_DOCS, SHARD_TOKENS = 2048, 1 << 20
K1, B = 1.2, 0.75

_ENCODED = ("doc_id long, doc_tokens long, crcs array<long>, rest binary, "
            "docs long, rests long, rest_tokens long, counts array<int>")
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, seed boolean, score double")


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """Ids as the library gives them: the file's vocabulary, with compiled merges for pieces not yet known."""
    import tiktoken

    own = Encoder(path)
    special = set(own.vocabulary.special.values())
    compiled = tiktoken.Encoding("file", pat_str=r"[\s\S]+", special_tokens={}, mergeable_ranks={
        token: i for i, token in own.vocabulary.bytes_of.items() if i not in special})
    return Encoder(path, compiled._core_bpe.encode_single_piece)


def _encode(path: str, window: int, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(path)
        counts = np.zeros(max(e.vocabulary.size, end + 1), np.int32)
        docs = rests = rest_tokens = 0
        tail = np.array([end], "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("crcs", pa.list_(pa.int64())),
                            ("rest", pa.binary()), ("docs", pa.int64()), ("rests", pa.int64()),
                            ("rest_tokens", pa.int64()), ("counts", pa.list_(pa.int32()))])
        for part in slices(batches, "text", 1 << 20):
            n, crcs, kept = [], [], []
            for text in part.column("text").to_pylist():
                ids = e.encode(text or "") + tail
                cut = len(ids) // (4 * window) * 4 * window
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[i:i + 4 * window]) for i in range(0, cut, 4 * window)])
                values = np.frombuffer(ids, "<u4")
                counts[distinct(values)] += 1
                kept.append(values[cut // 4:].astype("<u2" if len(counts) <= 65536 else "<u4").tobytes())
                rests += len(ids) > cut
                rest_tokens += (len(ids) - cut) // 4
            docs += len(n)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(crcs, pa.list_(pa.int64())), pa.array(kept),
                 none, none, none, pa.nulls(len(n), pa.list_(pa.int32()))], schema=schema)
        if docs:
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary()),
                pa.array([docs]), pa.array([rests]), pa.array([rest_tokens]), pa.array([counts], pa.list_(pa.int32()))], schema=schema)

    return run


def _by_content(frequency: np.ndarray):
    """Add ``lex``: the places of a rest's rarest terms among all terms by frequency, big-endian, so that bytes sort like the list.

    Terms of one document only say nothing about neighbours and are left out.
    """
    place = np.empty(len(frequency), np.uint32)
    place[np.argsort(frequency, kind="stable")] = np.arange(len(frequency))
    none = np.uint32(len(frequency))
    place[frequency <= 1] = none
    kind = "<u2" if len(frequency) <= 65536 else "<u4"

    def key(rest: bytes | None) -> bytes:
        at = distinct(place[np.frombuffer(rest or b"", kind)])[:KEY_TERMS]
        return at[at < none].astype(">u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([key(rest) for rest in batch.column("rest").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "lex"])

    return run


class _Shard:
    """Inverted index over the rests of one shard, and what of each is left.

    Entries of used-up rests are dropped whenever a quarter of the indexed ones is used up.
    """

    def __init__(self, rows: list[tuple], idf: np.ndarray, mean: float):
        self.rows = rows
        self.ids = [r[2] for r in rows]
        size = np.array([len(x) for x in self.ids])
        self.begin = np.array([r[3] for r in rows])  # taken so far, as a window may go on from the last shard
        self.left = size - self.begin
        every = np.sort(np.concatenate(self.ids).astype(np.int64) * len(rows) + np.repeat(np.arange(len(rows)), size))
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        key, tf = every[first], np.diff(np.append(first, len(every)))
        term, self.member = np.divmod(key, len(rows))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[self.member] / mean))
        self.at = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.term, self.at = term[self.at], np.append(self.at, len(term))
        self.indexed = len(rows)

    def drop_used(self) -> None:
        """Keep the entries of rests that are not used up, in their order; a term may be left without any."""
        kept = self.left[self.member] > 0
        self.at = np.append(0, np.cumsum(kept))[self.at]
        self.member, self.weight = self.member[kept], self.weight[kept]

    def ranked(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Unused rests by falling score for all of the seed's terms, each asked once, ties and others in order."""
        open_ = np.flatnonzero(self.left > 0)
        if len(open_) <= self.indexed * 3 // 4:
            self.drop_used()
            self.indexed = len(open_)
        place = np.searchsorted(self.term, distinct(self.ids[seed]))
        spans = [slice(a, b) for a, b in zip(self.at[place].tolist(), self.at[place + 1].tolist())]
        score = np.bincount(np.concatenate([self.member[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), len(self.rows))
        order = open_[np.argsort(-score[open_], kind="stable")]
        return order, score


def _pack(idf: np.ndarray, mean: float, window: int, shard_docs: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        number = filled = 0
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            types = (pa.int64(),) * 7 + (pa.bool_(), pa.float64())
            names = [c.split()[0] for c in _PIECE.split(", ")]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        def take(shard: _Shard, i: int, n: int, seed: bool, score: float | None) -> None:
            nonlocal filled
            doc_id, tokens, ids, _ = shard.rows[i]
            a = int(shard.begin[i])
            out.append((doc_id, tokens - len(ids) + a, n, zlib.crc32(ids[a:a + n].astype("<u4").tobytes()),
                        tokens, base + number, filled, seed, score))
            shard.begin[i] += n
            shard.left[i] -= n
            filled += n

        def fill(rows: list[tuple], last: bool) -> list[tuple]:
            """Pack a shard; what is left for a window that it cannot fill goes to the next shard."""
            nonlocal number, filled
            shard = _Shard(rows, idf, mean)
            unused, seed, total = 0, None, int(shard.left.sum())
            while total and (total >= window or last):
                if seed is None or not shard.left[seed]:
                    while not shard.left[unused]:
                        unused += 1
                    seed = unused
                n = min(int(shard.left[seed]), window)
                take(shard, seed, n, True, None)
                total -= n
                if filled < window and total:
                    order, score = shard.ranked(seed)
                    order = order[order != seed]
                    while filled < window and len(order):
                        fits = np.flatnonzero(shard.left[order] <= window - filled)
                        k = fits[0] if len(fits) else 0
                        i = int(order[k])
                        n = min(int(shard.left[i]), window - filled)
                        take(shard, i, n, False, float(score[i]))
                        total -= n
                        if shard.left[i]:
                            seed = i  # the cut rest opens the next window
                        order = np.delete(order, k) if len(fits) else order[:0]
                number, filled = number + 1, 0
            return [(*rows[i][:3], int(shard.begin[i])) for i in np.flatnonzero(shard.left)]

        kind = "<u2" if len(idf) <= 65536 else "<u4"
        rows: list[tuple] = []
        tokens = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "crcs", "rest")]
            for doc_id, n, crcs, rest in zip(*columns):
                for k, crc in enumerate(crcs):
                    out.append((doc_id, k * window, window, crc, n, base + number, 0, True, None))
                    number += 1
                if rest:
                    ids = np.frombuffer(rest, kind)
                    rows.append((doc_id, n, ids, 0))
                    tokens += len(ids)
                if len(rows) >= shard_docs or tokens >= SHARD_TOKENS:
                    rows = fill(rows, False)
                    tokens = sum(len(r[2]) for r in rows)
                if len(out) >= 10_000:
                    yield emit()
        if rows:
            fill(rows, True)
        if out:
            yield emit()

    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end: int = END,
                   key: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, seed, score``.

    Each document is its ids and then ``end``; every id lies in one piece. ``seed`` marks the piece
    that opened its sequence (or is a whole window of one document), ``score`` the BM25 score of a
    neighbour against it. Neighbours come from the seed's shard: rests that share its rarest terms
    lie there, wherever they were stored. NULL texts are empty: one piece of the one id ``end``; NULL keys stay
    NULL; repeated rows are packed each by itself; other columns are ignored; an empty table gives
    an empty table. Counts of documents and terms are of all rows.
    """
    path = vocabulary or default_vocabulary()
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    encoded = materialise(source.mapInArrow(_encode(path, window, end), _ENCODED), "encoded")
    facts = encoded.filter("docs IS NOT NULL")
    total = facts.agg(F.sum("docs"), F.sum("rests"), F.sum("rest_tokens")).first()
    n, rests, tokens = (x or 0 for x in total)
    # at most one row per id of the vocabulary comes to the driver
    held = facts.select(F.posexplode("counts").alias("id", "n")).filter("n > 0").groupBy("id").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(max([end, *(r["id"] for r in held)]) + 1)
    for r in held:
        frequency[r["id"]] = r["n"]
    size = _vocabulary_size(facts)
    frequency = np.concatenate([frequency, np.zeros(max(0, size - len(frequency)))])
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    mean = max(1.0, tokens / max(1, rests))
    keyed = encoded.filter("docs IS NULL").select("doc_id", "doc_tokens", "crcs", "rest").mapInArrow(
        _by_content(frequency), "doc_id long, doc_tokens long, crcs array<long>, rest binary, lex binary")
    order = ["lex", "salt"]
    sorted_ = keyed.withColumn("salt", F.xxhash64("doc_id", "rest")).repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_.select("doc_id", "doc_tokens", "crcs", "rest").mapInArrow(_pack(idf, mean, window, shard_docs), _PIECE)


def _vocabulary_size(facts: DataFrame) -> int:
    return facts.agg(F.max(F.size("counts"))).first()[0] or 0


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
