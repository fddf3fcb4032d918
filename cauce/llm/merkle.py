"""A Merkle manifest as a postorder append log.

Rows are leaves; in each group they get places by key order, and every three consecutive nodes of
a level become one of the next. A builder takes an aligned run of 3^7 leaves and appends every
node when it is complete, so its log is the postorder of a subtree. The roots of these subtrees
are the leaves of the next band of builders, until each group has one root; the groups' roots are
the leaves of one last tree. A group of any size spreads over many builders.

In such a log the place of a node follows from subtree sizes alone: all nodes that end no later
than it, level by level. Proofs are read from the logs at these places, band by band from the
root down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StructType

from cauce.llm.registry import query, table
from cauce.operators.order import number_rows
from cauce.sources.scratch import materialise

ARITY = 3
#: Levels of one band: a builder holds 3^7 leaves and 3,280 nodes at most.
BAND = 7
_PATH = "array<struct<left: string, right: string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def hashed(*parts: str) -> str:
    """``H`` of texts or hex digests: lowercase hex SHA-256 of all of them on end."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """``H`` of the fields, each as ``-`` if NULL, else its UTF-8 byte count, ``:`` and itself, as hex."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# --- closed forms --------------------------------------------------------------------------

def depth(n: int, arity: int = ARITY) -> int:
    """Levels above ``n`` leaves."""
    d = 0
    while arity ** d < n:
        d += 1
    return d


def postorder(level: int, index, n: int, top: int, arity: int = ARITY):
    """Place in the postorder log of node ``index`` of ``level``, in a tree of ``n`` leaves up to level ``top``.

    Before it lie all nodes that end no later: up to its own level those that end with it or
    before, above it those that end before.
    """
    index = np.asarray(index, np.int64)
    end = np.minimum((index + 1) * arity ** level, n)
    place = np.full(index.shape, -1, np.int64)
    for j in range(top + 1):
        size = arity ** j
        place += -(-end // size) if j <= level else (end - 1) // size
    return place


def log_size(n: int, top: int, arity: int = ARITY) -> int:
    """Nodes of a tree of ``n`` leaves up to level ``top``."""
    return sum(-(-n // arity ** j) for j in range(top + 1))


def build_log(leaves: Iterable[str], top: int, arity: int = ARITY) -> list[str]:
    """Digests of all nodes up to level ``top`` in the order in which they are complete."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(top + 1)]

    def done(digest: str, level: int) -> None:
        log.append(digest)
        if level < top:
            waiting[level].append(digest)
            if len(waiting[level]) == arity:
                close(level)

    def close(level: int) -> None:
        children, waiting[level] = waiting[level], []
        done(hashed(*children), level + 1)

    for leaf in leaves:
        done(leaf, 0)
    for level in range(top):
        if waiting[level]:
            close(level)
    return log


def paths(log: str, n: int, top: int, above: list[tuple[str, str]], arity: int = ARITY) -> list[list[tuple[str, str]]]:
    """For each leaf of a log (hex digests on end) the siblings left and right of its branch, from its own level up, then ``above``."""
    below = [above]
    for level in range(top - 1, -1, -1):
        count = -(-n // arity ** level)
        at = (postorder(level, np.arange(count), n, top, arity) * 64).tolist()
        here = []
        for i in range(count):
            first = i - i % arity
            left = "".join([log[p:p + 64] for p in at[first:i]])
            right = "".join([log[p:p + 64] for p in at[i + 1:min(first + arity, count)]])
            here.append([(left, right), *below[i // arity]])
        below = here
    return below


# --- bands of builders ---------------------------------------------------------------------

class Manifest(NamedTuple):
    """``groups``: one row per group (the group columns, ``gid``, ``n``, ``subroot``); ``bands``: the logs of the leaves'
    builders and of those above, ``gid, block, n, top, start, log`` and for the first band ``held``, the columns kept
    beside each leaf; ``upper``: the logs over the groups; ``root``: the digest of all, NULL for an empty table."""

    groups: DataFrame
    bands: list[DataFrame]
    upper: list[DataFrame]
    root: str | None


_LOG = "gid long, block long, n long, top int, start long, log binary, root string"
_LOG_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string())


def _build(held: bool):
    """Rows sorted by ``gid, pos`` to one log for each aligned block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _LOG.split(", ")] + ["held"] * held
        now, leaves, beside = None, [], []

        def emit() -> pa.RecordBatch:
            gid, block, n = now
            span = ARITY ** BAND
            top = min(BAND, depth(n))
            log = build_log(leaves, top)
            # where the segment begins in the log of the whole group: all nodes that end before its first leaf
            start = sum(block * span // ARITY ** j for j in range(depth(n) + 1))
            columns = [[gid], [block], [min(span, n - block * span)], [top], [start], [bytes.fromhex("".join(log))], [log[-1]]]
            arrays = [pa.array(c, t) for c, t in zip(columns, _LOG_TYPES)]
            if held:
                rows = pa.concat_arrays(beside)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows))
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            gid, block = batch.column("gid").to_numpy(), batch.column("block").to_numpy()
            new = np.flatnonzero(np.append(True, (gid[1:] != gid[:-1]) | (block[1:] != block[:-1]))) if len(gid) else gid
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(gid)]):
                key = int(gid[a]), int(block[a]), batch.column("n")[a].as_py()
                if now is not None and key != now:
                    yield emit()
                    leaves, beside = [], []
                now = key
                leaves += batch.column("digest").slice(a, b - a).to_pylist()
                if held:
                    beside.append(batch.column("held").slice(a, b - a))
        if now is not None:
            yield emit()

    return run


def _bands(leaves: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """Logs of all bands over ``gid, pos, n, digest`` (and ``held`` for the first), and the root of each ``gid``.

    ``largest`` is the number of leaves of the largest group; it only decides how many bands there are.
    """
    bands, span = [], ARITY ** BAND
    while True:
        held = "held" in leaves.columns
        schema = StructType.fromDDL(_LOG)
        if held:
            schema = schema.add("held", ArrayType(leaves.schema["held"].dataType))
        dealt = (
            leaves.withColumn("block", F.floor(F.col("pos") / span).cast("long"))
            .repartition("gid", "block").sortWithinPartitions("gid", "pos")
        )
        band = materialise(dealt.mapInArrow(_build(held), schema), "merkle-log")
        bands.append(band)
        if largest <= span:
            return bands, band.select("gid", F.col("root").alias("digest"))
        largest = -(-largest // span)
        totals = band.groupBy("gid").agg((F.max("block") + 1).alias("n"))
        leaves = band.join(totals.withColumnRenamed("n", "total"), "gid").select(
            "gid", F.col("block").alias("pos"), F.col("total").alias("n"), F.col("root").alias("digest"))


def _read(held: bool):
    """Logs with the path ``above`` their root to one row per leaf."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row].as_py() for c in ("gid", "block", "n", "top", "log", "above")}
                log, n, top = get["log"].hex(), get["n"], get["top"]
                found = paths(log, n, top, [(x["left"], x["right"]) for x in get["above"]])
                at = (postorder(0, np.arange(n), n, top) * 64).tolist()
                flat = [x for path in found for x in path]
                sides = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], pa.string()) for k in (0, 1)], ["left", "right"])
                arrays = [pa.array(np.full(n, get["gid"])), pa.array(get["block"] * ARITY ** BAND + np.arange(n)),
                          pa.array([log[p:p + 64] for p in at]),
                          pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), sides).cast(_PATH_TYPE)]
                names = ["gid", "pos", "digest", "path"]
                if held:
                    arrays.append(batch.column("held")[row].values)
                    names.append("held")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _down(bands: list[DataFrame], above: DataFrame) -> DataFrame:
    """``gid, pos, digest, path`` (and ``held``) of every leaf; ``above`` has the path of each ``gid``'s root."""
    for k, band in reversed(list(enumerate(bands))):
        if "block" in above.columns:
            met = band.join(above, ["gid", "block"])
        else:
            met = band.join(above, "gid")
        held = "held" in band.columns
        columns = ["gid", "block", "n", "top", "log", "above", *(["held"] if held else [])]
        schema = StructType.fromDDL(f"gid long, pos long, digest string, path {_PATH}")
        if held:
            schema = schema.add("held", band.schema["held"].dataType.elementType)
        read = met.select(*columns).mapInArrow(_read(held), schema)
        if k == 0:
            return read
        above = read.select("gid", F.col("pos").alias("block"), F.col("path").alias("above"))
    raise ValueError("a manifest has one band at least")


def _placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``gid``, ``pos`` and ``n`` of their group, and the groups with ``gid`` in order of the group column, NULL first.

    Rows are sorted in range slices that cut through groups, and written; only slice and group
    counts are gathered. ``(group, order)`` may repeat: equal rows take any of their places.
    """
    sliced = materialise(
        rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    slice_ = F.shiftright("_at", 33)
    facts = sliced.groupBy(F.col(group).alias("_group"), slice_.alias("_slice")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_group")
    facts = materialise(facts.select(
        "*", F.coalesce(F.sum("_n").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"),
        F.sum("_n").over(whole).alias("n")), "slice-facts")
    groups = materialise(number_rows(facts.filter("_shift = 0").select("_group", "n"), ["_group"], "gid", F.lit(-1)), "groups")
    numbered = facts.join(groups.select(F.col("_group").alias("_same"), "gid"), F.col("_group").eqNullSafe(F.col("_same"))).drop("_same")
    met = sliced.join(numbered, F.col(group).eqNullSafe(F.col("_group")) & (F.shiftright("_at", 33) == F.col("_slice")))
    return met.select(*rows.columns, "gid", (F.col("_at") - F.col("_first") + F.col("_shift")).alias("pos"), "n"), groups


def build_manifest(rows: DataFrame, group: str, order: str, digest: str, keep: list[str]) -> Manifest:
    """The manifest of ``rows``: leaves are their ``digest`` (hex), by ``order`` in each ``group``.

    Groups follow each other by value, NULL first; a NULL ``order`` comes first; rows of one order
    are sorted by digest. The columns ``keep`` stay beside each leaf and come back with its proof.
    Repeated rows are a leaf each; an empty table gives empty logs and no root.
    """
    fields = [F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(digest).alias("digest"), F.struct(*keep).alias("held")]
    placed, groups = _placed(rows.select(*fields), "_g", ["_o", "digest"])
    largest = groups.agg(F.max("n")).first()[0] or 0
    bands, roots = _bands(placed.select("gid", "pos", "n", "digest", "held"), largest)
    subroots = materialise(groups.join(roots, "gid").withColumnRenamed("digest", "subroot"), "subroots")
    count = groups.count()
    upper, root = _bands(subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("pos"), F.lit(count).cast("long").alias("n"),
                                         F.col("subroot").alias("digest")), count)
    top = root.first()
    return Manifest(subroots.withColumnRenamed("_group", group), bands, upper, top and top["digest"])


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``gid, pos, leaf, held, path, subroot, root``; ``path`` has the digests left and right of its branch, bottom to top."""
    start = manifest.upper[-1].select("gid").distinct().withColumn("above", F.expr(f"CAST(array() AS {_PATH})"))
    over = _down(manifest.upper, start).select(F.col("pos").alias("gid"), F.col("path").alias("above"))
    read = _down(manifest.bands, over)
    return read.join(manifest.groups.select("gid", "subroot"), "gid").select(
        "gid", "pos", F.col("digest").alias("leaf"), "held", "path", "subroot", F.lit(manifest.root).cast("string").alias("root"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["left"], digest, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """``H`` of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def document_proofs(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of ``docs``.

    A leaf holds ``doc_id, source, lang, n_chars, text``; groups are sources. ``claimed`` is a text
    that somebody says the document has: the proof is folded from it, and verified if that gives
    the root; without it from the text itself. NULLs in any column are part of the leaf; a NULL
    doc_id comes first in its source; repeated rows are leaves of their own; texts of any length
    are hashed whole; other columns are ignored; an empty table gives no rows.
    """
    fields = lambda text: leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    says = fields(F.col("text") if claimed is None else claimed)
    leaves = docs.select("doc_id", F.col("source").cast("string").alias("source"), fields(F.col("text")).alias("leaf"), says.alias("claim"))
    # a claim that is the leaf itself need not be carried
    leaves = leaves.withColumn("claim", F.nullif("claim", "leaf"))
    found = proofs(build_manifest(leaves, "source", "doc_id", "leaf", ["doc_id", "claim"]))
    rows = found.select(F.col("held.doc_id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        folded(F.coalesce("held.claim", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR END"


_LEAF = "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "{text}"))) + ")"
#: Both trees level by level; siblings of each branch; folds of the claimed leaves along them. CRC-32 bit by bit.
_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER () AS id,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS crc
  FROM documents
), leaves AS (
  SELECT id, doc_id, source, {_LEAF.format(text="text")} AS h,
    CASE WHEN xor(crc, 4294967295::BIGINT) % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} ELSE {_LEAF.format(text="text")} END AS claim
  FROM docs
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaves
), tree(g, lvl, i, h, n) AS (
  SELECT g, 0, i, h, count(*) OVER (PARTITION BY g) FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 3, h, count(*) OVER (PARTITION BY g) FROM (
    SELECT g, lvl, min(i) AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM tree WHERE n > 1 GROUP BY g, lvl, i // 3)
), subroots AS (SELECT g, h AS subroot FROM tree WHERE n = 1
), upper(lvl, i, h, n) AS (
  SELECT 0, g, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 3, h, count(*) OVER () FROM (
    SELECT lvl, min(i) AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM upper WHERE n > 1 GROUP BY lvl, i // 3)
), nodes AS (
  SELECT g, lvl, i, h FROM tree WHERE n > 1
  UNION ALL
  SELECT NULL, 1000 + lvl, i, h FROM upper WHERE n > 1
), branch AS (
  SELECT p.id, t.lvl, p.i // (3 ** t.lvl)::BIGINT AS i, p.g FROM placed p JOIN (SELECT DISTINCT g, lvl FROM tree WHERE n > 1) t ON t.g = p.g
  UNION ALL
  SELECT p.id, 1000 + u.lvl, p.g // (3 ** u.lvl)::BIGINT, NULL FROM placed p CROSS JOIN (SELECT DISTINCT lvl FROM upper WHERE n > 1) u
), steps AS (
  SELECT b.id, b.lvl, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (WHERE x.i < b.i), '') AS l,
    coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (WHERE x.i > b.i), '') AS r, row_number() OVER (PARTITION BY b.id ORDER BY b.lvl) AS k
  FROM branch b JOIN nodes x ON x.lvl = b.lvl AND x.i // 3 = b.i // 3 AND x.g IS NOT DISTINCT FROM b.g GROUP BY b.id, b.lvl, b.i
), proof AS (SELECT id, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY id
), fold(id, k, h) AS (
  SELECT id, 0::BIGINT, claim FROM placed
  UNION ALL
  SELECT f.id, f.k + 1, sha256(s.l || f.h || s.r) FROM fold f JOIN steps s ON s.id = f.id AND s.k = f.k + 1
), ends AS (SELECT id, arg_max(h, k) AS folded_root FROM fold GROUP BY id
), top AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT p.doc_id, p.h AS leaf, s.subroot, top.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots s ON s.g = p.g JOIN ends e ON e.id = p.id LEFT JOIN proof o ON o.id = p.id CROSS JOIN top
"""


@query("op11_merkle", _SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return document_proofs(table(spark, sf_dir, "documents"), F.coalesce(tampered, F.col("text")))
