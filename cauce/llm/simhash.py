"""SimHash near-duplicates by a bit-sliced comparison inside pigeonhole bands.

64-bit fingerprints that differ in at most three bits agree on at least two of five bands, so
each of the ten pairs of bands is one exact key. Equal fingerprints are one row from the start.
Inside a key, fingerprints are turned into 64 bit planes; the distances of all neighbours at a
given offset are counted together, 64 pairs to a machine word, in carry-save counters, and words
whose pairs are all beyond the radius are dropped. Only links that join two parts leave a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.graph import components
from cauce.llm.registry import query, table
from cauce.llm.words import Words, slices, xxh64
from cauce.sources.scratch import materialise

RADIUS = 3
BANDS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: Fingerprints of one key that are compared in one piece; larger keys go in pairs of such pieces.
PIECE = 2048
_U = np.uint64
_ALL = _U(0xFFFFFFFFFFFFFFFF)


def _byte_lanes() -> np.ndarray:
    """For each byte value, its eight bits spread over the eight bytes of one word."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


_LANES = _byte_lanes()


def _majority(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per run ``doc[d] .. doc[d + 1]`` of hashes, the bits that more than half of them have."""
    n = np.diff(doc)
    out = np.zeros(len(n), _U)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    pieces = -(-n[full] // 255)  # a byte lane holds up to 255
    owner = np.repeat(np.arange(len(full)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = doc[full][owner] + 255 * nth
    first = np.flatnonzero(nth == 0)
    octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, k]], cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
        totals = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        for bit in range(8):
            over = 2 * totals[:, bit] > n[full]
            out[full] |= over.astype(_U) << _U(8 * k + bit)
    return out


def fingerprints(column: pa.Array) -> np.ndarray:
    """SimHash of each text: lower-cased A-Z, blank-separated words, 3-word shingles, XXH64 seed 42."""
    w = Words(column, lower=True)
    counts = w.counts()
    if not w.n:
        return np.zeros(len(counts), _U)
    first = w.room(3)
    short = np.flatnonzero((counts > 0) & (counts < 3))
    first[w.doc[short]] = True  # the whole of a shorter text
    at = np.flatnonzero(first)
    last = np.minimum(at + 2, np.repeat(w.doc[1:], counts)[at] - 1)
    h = xxh64(w.data, w.start[at], w.end[last] - w.start[at], 42)
    return _majority(h, np.searchsorted(at, w.doc))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` without ``text``, with its 64-bit fingerprint as a long; no words: zero."""
    kept = [c for c in docs.columns if c not in (text, out)]
    schema = docs.select(*kept, F.lit(0).cast("long").alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            values = pa.array(fingerprints(part.column("_text")).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], values], [*kept, out])

    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)


def _planes(f: np.ndarray) -> np.ndarray:
    """64 rows, row ``b`` holding bit ``b`` of every fingerprint, 64 of them to a word."""
    room = -(-len(f) // 64) * 64 + 64
    bits = np.unpackbits(f.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    wide = np.zeros((64, room), np.uint8)
    wide[:, :len(f)] = bits.T
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def _ahead(plane: np.ndarray, words: np.ndarray, d: int) -> np.ndarray:
    """The plane moved forward by ``d`` places, at the given words."""
    q, r = divmod(d, 64)
    top = plane.shape[-1] - 1
    low = plane[np.minimum(words + q, top)]
    if not r:
        return low
    return (low >> _U(r)) | (plane[np.minimum(words + q + 1, top)] << _U(64 - r))


def _bits(n: int, marks: np.ndarray) -> np.ndarray:
    wide = np.zeros(-(-n // 64) * 64 + 64, np.uint8)
    wide[:len(marks)] = marks
    return np.packbits(wide, bitorder="little").view("<u8")


def close_pairs(f: np.ndarray, run: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints within ``radius`` (at most 3) of one run, offset by offset.

    ``run`` numbers the runs and never falls. Two counter planes and a sticky overflow plane count
    up to three differing bits for 64 pairs at a time.
    """
    planes = _planes(f)
    n = len(f)
    longest = int(np.bincount(run).max()) if n else 0
    for d in range(1, longest):
        same = _bits(n, run[:-d] == run[d:])
        words = np.flatnonzero(same)
        if not len(words):
            break
        alive = same[words]
        ones = np.zeros(len(words), _U)
        twos, over = ones.copy(), ones.copy()
        for b in range(64):
            differs = planes[b][words] ^ _ahead(planes[b], words, d)
            carry = ones & differs
            ones = ones ^ differs
            over = over | (twos & carry)
            twos = twos ^ carry
            if b % 4 == 3:
                open_ = np.flatnonzero(alive & ~over)
                if len(open_) < len(words):
                    words, alive, ones, twos, over = (x[open_] for x in (words, alive, ones, twos, over))
                if not len(words):
                    break
        if not len(words):
            continue
        if radius < 3:
            count = [~ones & ~twos, ones & ~twos, ~ones & twos][:radius + 1]
            over = over | ~np.bitwise_or.reduce(count)
        hit = (alive & ~over).astype("<u8").view(np.uint8).reshape(-1, 8)
        row, bit = np.nonzero(np.unpackbits(hit, axis=1, bitorder="little"))
        i = words[row] * 64 + bit
        yield i, i + d


def _forest(f: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs that suffice to join what all close pairs join."""
    label = np.arange(len(f))
    a_out, b_out = [], []
    for i, j in close_pairs(f, run):
        while True:
            i, j = (x[label[i] != label[j]] for x in (i, j))
            if not len(i):
                break
            low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
            taken = np.full(len(f), len(f))
            np.minimum.at(taken, high, np.arange(len(high)))  # one link for each label that goes
            use = taken[taken < len(f)]
            a_out.append(i[use])
            b_out.append(j[use])
            label[high[use]] = low[use]
            while (label != label[label]).any():
                label = label[label]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)


def _link_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each key; rows come sorted by key, and a key may cross batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def links(keys: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        run = np.zeros(len(keys), np.int64)
        run[1:] = np.cumsum((keys[1:] != keys[:-1]).any(axis=1))
        i, j = _forest(f, run)
        return pa.RecordBatch.from_arrays([pa.array(f[i].view(np.int64)), pa.array(f[j].view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "x", "y")], axis=1)
        held.append((keys, batch.column("f").to_numpy(zero_copy_only=False).view(_U)))
        keys, f = (np.concatenate(x) for x in zip(*held, strict=True))
        change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
        if len(change):
            cut = change[-1] + 1
            yield links(keys[:cut], f[:cut])
            keys, f = keys[cut:], f[cut:]
        held = [(keys, f)]
    if held:
        yield links(*held[0])


def fingerprint_links(distinct: DataFrame, column: str = "fingerprint", piece: int = PIECE) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints of ``column`` that differ in at most 3 bits.

    The links join exactly what all close pairs join. A key with more than ``piece`` fingerprints
    is dealt over pairs of pieces, so no task holds more than twice that many of one key.
    """
    f = F.col(column)
    keys = []
    for number, pair in enumerate(combinations(BANDS, 2)):
        value = F.lit(number).cast("long")
        for lo, hi in pair:
            value = F.shiftleft(value, hi - lo).bitwiseOR(
                F.shiftrightunsigned(f, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)))
        keys.append(value)
    rows = materialise(distinct.select(f.alias("f"), F.explode(F.array(*keys)).alias("key")), "bands")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("n") / piece).cast("int")
    shared = (
        rows.join(sizes, "key").withColumn("c", pieces)
        .withColumn("p", F.pmod(F.xxhash64("f"), F.col("c")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
        .select("key", F.least("p", "other").cast("long").alias("x"), F.greatest("p", "other").cast("long").alias("y"), "f")
    )
    dealt = shared.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "f")
    return dealt.mapInArrow(_link_runs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns of ``also``, ``fingerprint``, ``group`` and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable over links of at most three differing bits;
    ``group`` is the smallest fingerprint of the component. NULL and empty texts have the
    fingerprint zero and link like any other. Rows of a NULL key take part and get the smallest
    non-NULL key of their component, or NULL. Repeated rows are kept. Other columns are ignored. An
    empty table gives an empty table.
    """
    printed = materialise(with_fingerprint(docs.select(key, *also, text), text), "prints")
    first = printed.groupBy("fingerprint").agg(F.min(key).alias("_first"))
    linked = components(fingerprint_links(printed.select("fingerprint").distinct()))
    held = materialise(first.join(linked, F.col("fingerprint") == F.col("node"), "left").select(
        F.col("fingerprint").alias("_f"), "_first", F.coalesce("component", "fingerprint").alias("group")), "members")
    least = held.groupBy("group").agg(F.min("_first").alias("component_id"))
    named = held.join(least, "group").select("_f", "group", "component_id")
    return printed.join(named, F.col("fingerprint") == F.col("_f")).drop("_f")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest key, of equal keys
    that of the smallest text hash; of rows alike in both, the first met. NULL keys come last."""
    marked = docs.withColumn("_hash", F.xxhash64(F.col(text))).withColumn("_null", F.col(key).isNull())
    found = near_duplicates(marked, key, text, ("_hash", "_null"))
    best = found.groupBy("group").agg(F.min(F.struct("_null", F.col(key).alias("_key"), "_hash")).alias("_best"))
    chosen = best.select("_best.*").withColumn("_key", F.coalesce("_key", F.lit(0)))
    id_ = F.when(F.col("_null"), F.lit(0)).otherwise(F.col(key))
    joined = marked.withColumn("_key", id_).join(chosen, ["_null", "_key", "_hash"], "left_semi")
    one = joined.groupBy("_null", "_key", "_hash").agg(F.first(F.struct(*docs.columns)).alias("_row"))
    return one.select("_row.*")


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
