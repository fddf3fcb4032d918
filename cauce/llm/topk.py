"""Exact top-k inner products by columnar branch-and-bound.

Vectors lie in blocks, vertically: one array per dimension. For a query, scores are summed up
dimension block by dimension block; what is still missing of a score is bounded by the norms of
the remaining dimensions (Cauchy-Schwarz). Candidates whose upper bound lies below the k-th best
lower bound leave, and the block is compacted to the survivors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cauce.llm.registry import query, table
from cauce.sources.scratch import materialise

#: Vectors of one candidate block and of one query block.
CANDIDATES, QUERIES = 8192, 256
#: Dimensions summed up between two rounds of pruning.
STEP = 8
_BLOCK = "block long, n int, dims int, ids binary, columns binary"


def quantised(vector, scale: int):
    """``floor(scale * x)`` of each component as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _blocks(size: int):
    """Rows to vertical blocks of at most ``size`` vectors of one length."""
    def pack(number: int, ids: list[np.ndarray], rows: list[np.ndarray]) -> tuple:
        m = np.concatenate(rows)
        return number, len(m), m.shape[1], np.concatenate(ids).astype("<i8").tobytes(), np.ascontiguousarray(m.T).astype("<i8").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list]] = {}
        out = []
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lists = batch.column("v")
            lengths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                rows = flat[starts[at][:, None] + np.arange(dims)] if dims else np.zeros((len(at), 0), np.int64)
                for k in range(0, len(at), size):
                    have = held.setdefault(dims, ([], []))
                    have[0].append(ids[at[k:k + size]])
                    have[1].append(rows[k:k + size])
                    if sum(map(len, have[0])) >= size:
                        all_ids, all_rows = np.concatenate(have[0]), np.concatenate(have[1])
                        out.append(pack(number, [all_ids[:size]], [all_rows[:size]]))
                        held[dims] = ([all_ids[size:]], [all_rows[size:]])
                        number += 1
            if out:
                yield _batch(out)
                out = []
        for ids, rows in held.values():
            if sum(map(len, ids)):
                out.append(pack(number, ids, rows))
                number += 1
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in _BLOCK.split(", ")])


def block_top(queries: np.ndarray, q_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray, k: int,
              step: int = STEP, known: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query ``(number, candidate ids, scores)`` of its ``k`` best in a vertical block, ties to smaller ids.

    ``queries`` is one row per query, ``columns`` one row per dimension; ``known`` are ``k`` scores per
    query that others reach already: candidates that must stay below the least of them leave.
    """
    dims = columns.shape[0]
    # norms of what follows each step, a little enlarged so that rounding never prunes
    after = np.sqrt(np.cumsum(columns[::-1].astype(float) ** 2, axis=0)[::-1]) * (1 + 1e-9) + 1e-6
    for number, (q, own) in enumerate(zip(queries, q_ids)):
        rest = np.sqrt(np.cumsum(q[::-1].astype(float) ** 2)[::-1]) * (1 + 1e-9) + 1e-6
        alive = np.flatnonzero(ids != own)
        score = np.zeros(len(alive), np.int64)
        bar = known[number].min() if known is not None else -np.inf
        for a in range(0, dims, step):
            b = min(a + step, dims)
            part = columns[a:b] if len(alive) == columns.shape[1] else columns[a:b][:, alive]
            score += q[a:b] @ part
            if b < dims and len(alive):
                slack = rest[b] * after[b][alive]
                floor = max(bar, np.partition(score - slack, len(alive) - k)[len(alive) - k]) if len(alive) > k else bar
                stay = score + slack >= floor
                if not stay.all():
                    alive, score = alive[stay], score[stay]
        if len(alive) > k:
            bar = max(bar, np.partition(score, len(alive) - k)[len(alive) - k])
        stay = score >= bar
        alive, score = alive[stay], score[stay]
        order = np.lexsort((ids[alive], -score))[:k]
        yield number, ids[alive][order], score[order]


def _search(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # the k best scores of each query so far, by query block
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                dims = get["dims"]
                q = np.frombuffer(get["q_columns"], "<i8").reshape(dims, get["q_n"]).T
                columns = np.frombuffer(get["columns"], "<i8").reshape(dims, get["n"])
                q_ids, ids = np.frombuffer(get["q_ids"], "<i8"), np.frombuffer(get["ids"], "<i8")
                known = best.setdefault(get["q_block"], np.full((len(q), k), np.iinfo(np.int64).min))
                found = list(block_top(q, q_ids, columns, ids, k, known=known))
                for number, _, score in found:
                    known[number] = np.sort(np.append(known[number], score))[-k:]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q_ids, [len(f[1]) for f in found])),
                    pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                    ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, key: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer inner products.

    Queries are the rows for which ``is_query`` holds; candidates are all rows of the same length
    but those with the query's own key. Components become ``floor(scale * x)``; a table whose scores
    might not fit 64 bits is refused. Vectors that are NULL, hold NULL or non-finite components, or have
    a NULL key take no part. Ties go to the smaller key; repeated rows count once each, candidates as
    well as queries; several vectors under one query key are all asked and ranked together. Other columns
    are ignored; an empty table gives an empty table.

    Every block of queries meets every block of candidates, as an exact search over all rows must.
    Candidate blocks are dealt to as many groups as there are shuffle partitions and stay there; the
    queries, in blocks, go to each group once. A group's later blocks are pruned by the scores that
    its earlier ones reached, and only rows that can be among the ``k`` go on.
    """
    spark = vectors.sparkSession
    sound = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & sound).select(
        F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), is_query.alias("q"))
    square = F.aggregate(F.col("v"), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    if (rows.agg(F.max(square)).first()[0] or 0.0) >= 2.0 ** 62:
        raise ValueError("inner products of these vectors may not fit 64 bits: use a smaller scale")
    blocks = materialise(rows.select("id", "v").mapInArrow(_blocks(CANDIDATES), _BLOCK), "candidates")
    queries = materialise(rows.filter("q").select("id", "v").mapInArrow(_blocks(QUERIES), _BLOCK), "queries").select(
        "dims", *[F.col(c).alias(f"q_{c}") for c in ("block", "n", "ids", "columns")])
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)))
    used = dealt.groupBy("dims").agg(F.collect_set("part").alias("parts"))  # at most a number per group
    sent = queries.join(used, "dims").select("*", F.explode("parts").alias("part")).drop("parts")
    found = sent.join(dealt, ["dims", "part"]).mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op6_topk", _SQL)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
