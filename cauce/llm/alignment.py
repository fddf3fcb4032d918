"""Where two tokenizers agree: token ends of both intersected by galloping.

Every text is encoded by a byte-level BPE vocabulary (A, over a space and the text) and by a
sentencepiece model (B, which adds that space). Both lists of token ends are sorted byte offsets.
The shorter list drives: each of its ends is looked for in the longer one from the last found
place on, by doubling steps and then by halving them. Many stretches of many documents gallop
side by side, as one array operation per step. Ends that both have cut the tokens into groups;
the differences of their ranks in A and B are the ranges of tokens that overlap there.

Documents travel in slices of bounded size. Linked pairs are counted per slice first, so the
corpus-wide counts meet each pair once a slice and not once an occurrence.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.bpe import Encoder, default_vocabulary
from cauce.llm.registry import query, table
from cauce.llm.words import slices
from cauce.sources.scratch import materialise

#: Bytes of text in one slice; a longer text is a slice of its own.
SLICE = 1 << 20
#: Ends of the shorter list that one stretch walks over.
STRETCH = 64

_DOC = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())]
_SLICED = pa.schema([("slice", pa.int64()), ("docs", pa.list_(pa.struct(_DOC))), ("a_tokens", pa.binary()), ("b_tokens", pa.binary()),
                     ("a_at", pa.binary()), ("b_at", pa.binary()), ("links", pa.binary()),
                     ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_SLICED_DDL = ("slice long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string>>, "
               "a_tokens binary, b_tokens binary, a_at binary, b_at binary, links binary, pairs array<long>, counts array<long>")
_OUT = [*_DOC[:4], ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), _DOC[4]]


def default_pieces() -> str:
    """The public 32k sentencepiece model; any model of the same kind can be named instead."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class _Table:
    """Bytes of every id of a tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Pair:
    """Both tokenizers of a worker, with the bytes of their ids."""

    def __init__(self, vocabulary: str, pieces: str):
        import sentencepiece
        import tiktoken

        own = Encoder(vocabulary)
        special = set(own.vocabulary.special.values())
        compiled = tiktoken.Encoding("file", pat_str=r"[\s\S]+", special_tokens={}, mergeable_ranks={
            token: i for i, token in own.vocabulary.bytes_of.items() if i not in special})
        self.encoder = Encoder(vocabulary, compiled._core_bpe.encode_single_piece)
        self.encoder.vocabulary.cut = None  # special tokens inside a text are plain text
        self.a = _Table([own.vocabulary.bytes_of.get(i, b"") for i in range(own.vocabulary.size)])
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b = _Table([self._piece(i) for i in range(self.model.get_piece_size())])

    def _piece(self, i: int) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:-1], 16)])
        return self.model.id_to_piece(i).replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both; none for a text that either does not give back byte by byte."""
        none = np.zeros(0, np.int64)
        a_ids, b_ids = [], []
        for text, b in zip(texts, self.model.encode(texts, num_threads=1) if texts else []):
            a = np.frombuffer(self.encoder.encode(" " + text), "<u4").astype(np.int64) if text else none
            whole = (" " + text).encode()
            same = bool(text) and self.a.joined(a.tolist()) == whole and self.b.joined(b) == whole
            a_ids.append(a if same else none)
            b_ids.append(np.array(b, np.int64) if same else none)
        return a_ids, b_ids


@functools.lru_cache(maxsize=1)
def _pair(vocabulary: str, pieces: str) -> Pair:
    return Pair(vocabulary, pieces)


def gallop(driver: np.ndarray, other: np.ndarray, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``driver`` and in ``other`` of the values that both sorted, duplicate-free lists have.

    ``driver`` is cut into stretches that start where a binary search puts them and then walk in
    step: per value, doubling steps from the last place until one reaches it, then halving steps.
    """
    n, m = len(driver), len(other)
    if not n or not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.append(other, np.iinfo(np.int64).max)
    begin = np.arange(0, n, stretch)
    place = np.searchsorted(other, driver[begin])
    found = np.empty(n, np.int64)
    for k in range(stretch):
        at = begin[:np.searchsorted(begin, n - k)] + k
        if not len(at):
            break
        want, low = driver[at], place[:len(at)]
        # other[low - 1] < want holds throughout; high is the first known place that is not below
        high, step = low.copy(), 1
        going = np.flatnonzero(padded[high] < want)
        while len(going):
            low[going] = high[going] + 1
            high[going] = np.minimum(high[going] + step, m)
            step *= 2
            going = going[padded[high[going]] < want[going]]
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            below = padded[middle] < want[going]
            low[going[below]] = middle[below] + 1
            high[going[~below]] = middle[~below]
            going = going[low[going] < high[going]]
        found[at] = low
        place[:len(at)] = low
    hit = padded[found] == driver
    return np.flatnonzero(hit), found[hit]


def common_ends(a_end: np.ndarray, b_end: np.ndarray, a_doc: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and B of common ends; in every document the shorter list drives.

    Ends count on from document to document; ``a_doc`` and ``b_doc`` are the offsets of the documents in both lists.
    """
    short = np.diff(a_doc) <= np.diff(b_doc)
    pairs = []
    for driven_by_a in (True, False):
        chosen = short == driven_by_a
        a = np.flatnonzero(np.repeat(chosen, np.diff(a_doc)))
        b = np.flatnonzero(np.repeat(chosen, np.diff(b_doc)))
        if driven_by_a:
            i, j = gallop(a_end[a], b_end[b])
        else:
            j, i = gallop(b_end[b], a_end[a])
        pairs.append((a[i], b[j]))
    i, j = (np.concatenate(x) for x in zip(*pairs))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


_DIGITS = (10 ** np.arange(9, -1, -1)).astype(np.int32)


def listed(a_ids: np.ndarray, b_ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` as bytes, for common ends at ``i`` in A and ``j`` in B; and the offset behind every group."""
    n = len(a_ids) + len(b_ids)
    a_group, b_group = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_group[i], b_group[j] = 1, 1
    a_group, b_group = np.cumsum(a_group) - a_group, np.cumsum(b_group) - b_group  # groups closed before
    # rank differences: B tokens of earlier groups stand before an A token, A tokens up to its group before a B token
    a_to = np.arange(len(a_ids)) + np.append(0, j + 1)[a_group]
    b_to = np.arange(len(b_ids)) + (i + 1)[b_group]
    ids, mark = np.empty(n, np.int32), np.full(n, ord(","), np.uint8)
    ids[a_to], ids[b_to] = a_ids, b_ids
    mark[a_to[i]], mark[b_to[j]] = ord("|"), ord(";")
    width = max(1, len(str(int(ids.max())))) if n else 1
    digits = (ids[:, None] // _DIGITS[10 - width:] % 10 + 48).astype(np.uint8)
    lead = np.cumsum(digits != 48, axis=1) == 0
    lead[:, -1] = False
    field = np.concatenate([digits, mark[:, None]], axis=1)
    held = np.concatenate([~lead, np.ones((n, 1), bool)], axis=1)
    return field[held], np.cumsum(held.sum(axis=1))[b_to[j]]


def align_slice(a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_length: np.ndarray, b_length: np.ndarray):
    """Groups of many documents: ids of A and B on end, document offsets, common ends, group count and digest per document."""
    a_doc = np.cumsum([0, *map(len, a_ids)])
    b_doc = np.cumsum([0, *map(len, b_ids)])
    a = np.concatenate([np.zeros(0, np.int64), *a_ids])
    b = np.concatenate([np.zeros(0, np.int64), *b_ids])
    i, j = common_ends(np.cumsum(a_length[a]), np.cumsum(b_length[b]), a_doc, b_doc)
    groups = np.searchsorted(i, a_doc)
    text, ends = listed(a, b, i, j)
    cut = np.append(0, ends)[groups]
    data = text.tobytes()
    digest = [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cut.tolist(), cut[1:].tolist())]
    return a, b, a_doc, b_doc, i, j, np.diff(groups), digest


def _align(vocabulary: str, pieces: str, limit: int, tokens: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pair(vocabulary, pieces)
        base, number = TaskContext.get().partitionId() << 32, 0
        wide = len(p.b.tokens)
        for part in slices(batches, "text", limit):
            ids = p.encode([t or "" for t in part.column("text").to_pylist()])
            a, b, a_doc, b_doc, i, j, groups, digest = align_slice(*ids, p.a.length, p.b.length)
            links = a[i] * wide + b[j]
            pairs, counts = np.unique(links, return_counts=True)
            docs = pa.StructArray.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(a_doc)), pa.array(np.diff(b_doc)), pa.array(groups), pa.array(digest, pa.string())],
                fields=[pa.field(*f) for f in _DOC])
            place = np.searchsorted(pairs, links).astype("<u2" if len(pairs) <= 65536 else "<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array([base + number]), pa.ListArray.from_arrays([0, len(docs)], docs),
                *[pa.array([x.astype("<i4").tobytes() if tokens else None], pa.binary()) for x in (a, b, i, j)], pa.array([place.tobytes()]),
                *[pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int64())) for x in (pairs, counts)]], schema=_SLICED)
            number += 1

    return run


def _per_document(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each slice with the corpus-wide counts of their links."""
    for batch in batches:
        for row in range(batch.num_rows):
            docs = batch.column("docs")[row].values
            column = dict(zip([f[0] for f in _DOC], docs.flatten()))
            groups = column["n_groups"].to_numpy()
            data = batch.column("links")[row].as_py()
            link = np.frombuffer(data, "<u2" if len(data) == 2 * groups.sum() else "<u4")
            facts = batch.column("facts")[row].values
            count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if facts is not None and len(facts):
                pair, total, most = (x.to_numpy(zero_copy_only=False) for x in facts.flatten())
                order = np.argsort(pair)
                count, best = total[order][link], most[order].astype(np.int64)[link]
            cut = np.cumsum(np.append(0, groups))
            sums = [pa.array(np.diff(np.append(0, np.cumsum(x))[cut])) for x in (best, count)]
            yield pa.RecordBatch.from_arrays(
                [column["doc_id"], column["n_a"], column["n_b"], column["n_groups"], column["n_groups"], *sums, column["groups_sha256"]],
                schema=pa.schema(_OUT))


def aligned_slices(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None,
                   key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE, tokens: bool = True) -> DataFrame:
    """One written row per slice of documents: ``docs`` (facts of each document), with ``tokens`` the ids of A and B and
    ``a_at`` and ``b_at`` (places of common ends), all little-endian 32-bit and on end over the slice, ``links`` (place in
    ``pairs`` of every common end) and the slice's distinct ``pairs`` with ``counts``; a pair is ``a * (ids of B) + b``."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    run = _align(vocabulary or default_vocabulary(), pieces or default_pieces(), slice_bytes, tokens)
    return materialise(source.mapInArrow(run, _SLICED_DDL), "aligned")


def groups_of(sliced: DataFrame) -> DataFrame:
    """One row per group of ``aligned_slices``: ``doc_id, group, a_from, a_to, b_from, b_to`` (token ranks in the document,
    end exclusive) and the token ids ``a_ids`` and ``b_ids``."""
    ddl = "doc_id long, group long, a_from long, a_to long, b_from long, b_to long, a_ids array<int>, b_ids array<int>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b, i, j = (np.frombuffer(batch.column(c)[row].as_py(), "<i4") for c in ("a_tokens", "b_tokens", "a_at", "b_at"))
                facts = batch.column("docs")[row].values
                doc_id, n_a, n_b, n = facts.flatten()[:4]
                n = n.to_numpy()
                first = np.repeat(np.cumsum(n) - n, n)
                ranges = []
                for at, size in ((i, n_a), (j, n_b)):
                    size = size.to_numpy()
                    end = at.astype(np.int64) + 1
                    shift = np.repeat(np.cumsum(size) - size, n)
                    ranges += [np.append(np.zeros(1, np.int64), end)[:-1] - shift, end - shift]
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, at + 1).astype(np.int32)), pa.array(x[:at[-1] + 1 if len(at) else 0]))
                         for at, x in ((i, a), (j, b))]
                yield pa.RecordBatch.from_arrays(
                    [doc_id.take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.arange(len(i)) - first), *map(pa.array, ranges), *lists],
                    ["doc_id", "group", "a_from", "a_to", "b_from", "b_to", "a_ids", "b_ids"])

    return sliced.select("docs", "a_tokens", "b_tokens", "a_at", "b_at").mapInArrow(run, ddl)


def pair_counts(sliced: DataFrame, b_size: int) -> DataFrame:
    """``pair, count, best``: links of each id pair over the corpus, and whether no pair of its B id has more."""
    local = sliced.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.pairs", "x.counts")
    counts = materialise(local.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")), "pair-counts")
    b = F.col("pair") % b_size
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # a row per id of B at most
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None,
                 key: str = "doc_id", text: str = "text", slice_bytes: int = SLICE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``.

    A text that is NULL, empty, or not given back byte by byte by both tokenizers (one that holds
    U+2581, say) has no tokens: zeros and an empty digest. Within a document ends are distinct, so
    each common end links one A token to one B token. NULL keys stay NULL; repeated rows count and
    are returned each; texts of any length are aligned whole; ties of the highest count are all
    best; other columns are ignored; an empty table gives an empty table.
    """
    pieces = pieces or default_pieces()
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    sliced = aligned_slices(docs, vocabulary, pieces, key, text, slice_bytes, tokens=False)
    asked = sliced.select("slice", F.explode("pairs").alias("pair"))
    facts = asked.join(pair_counts(sliced, size), "pair").groupBy("slice").agg(
        F.collect_list(F.struct("pair", "count", "best")).alias("facts"))  # at most the distinct pairs of one slice
    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return sliced.select("slice", "docs", "links").join(facts, "slice", "left").select("docs", "links", "facts").mapInArrow(_per_document, ddl)


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))
