"""Exact top-k search with block-at-a-time pruning.

Vectors are turned into integers; the dimensions are the terms, a component the
weight of its term.  The rows are cut into blocks by range of their id; a
block keeps its rows as a forward index (one row after the other) and, per term, the
largest and the smallest weight.  For a query the summed term maxima (the larger of query weight times maximum
and times minimum) bound every score in the block.  Blocks are visited in decreasing order of the
query's bound, scored through the forward index, and the visit ends at the
first block whose bound lies below the query's k-th best score so far.

Queries and blocks meet in cells: blocks stand in groups, queries in
batches, and a cell of one group and one batch is one task's work, of bounded
size; each cell gives its k best per query and these are merged.  Every
row is scored or bounded away, so the result is exact.

Scores are integer inner products; ties go to the smaller id.  Rows with a null id, a null vector, or a null
or non-finite component take no part; components of vectors of different lengths
count as 0 where one has none; scores beyond the range of a long stop at its ends.  Rows that repeat an id are candidates of their own, except that a query
never meets rows of its own id; a repeated query id is asked once for each row and its answers are merged.  With fewer than k candidates
all are returned, with none no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

TOP = 20
SCALE = 64
EVERY = 20
BLOCK = 512
BLOCKS_PER_GROUP = 32
QUERIES_PER_BATCH = 4096

RANKED = "query_id long, vec_id long, score long"
PACKED = "low long, ids binary, width int, data binary"


def usable(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v: the vectors that take part, as arrays of long."""
    x = F.col("v")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return v.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _pack(ids: np.ndarray, matrix: np.ndarray) -> dict:
    least, most = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    return {"low": int(ids[0]), "ids": ids.tobytes(), "width": matrix.shape[1], "data": np.dtype(kind).char.encode() + matrix.astype(kind).tobytes()}


def _unpack(ids: bytes, width: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    values = np.frombuffer(data[1:], np.dtype(data[:1].decode())) if len(data) > 1 else np.zeros(0)
    return found, values.astype(np.int64).reshape(len(found), width)


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows in blocks of at most so many, each a range of ids within its partition."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held = [], []

        def made() -> pa.RecordBatch:
            width = max(map(len, held))
            matrix = np.zeros((len(held), width), np.int64)
            for i, row in enumerate(held):
                matrix[i, : len(row)] = row
            return pa.RecordBatch.from_pylist([_pack(np.array(held_ids, np.int64), matrix)], pa.schema([("low", pa.int64()), ("ids", pa.binary()), ("width", pa.int32()), ("data", pa.binary())]))

        for batch in batches:
            column = batch.column(1)
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
            for vec_id, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                held_ids.append(vec_id)
                held.append(values[a:b])
                if len(held) == size:
                    yield made()
                    held_ids, held = [], []
        if held:
            yield made()

    return rows.mapInArrow(blocks, PACKED)


def _grouped(rows: DataFrame, groups: int, size: int, name: str) -> DataFrame:
    """Packed blocks, with the number of the id range that holds them."""
    ranged = rows.repartitionByRange(max(1, groups), "vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id")
    return cut(packed(ranged, size).withColumn(name, F.spark_partition_id()))


def _product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products; floats carry them while no partial sum can reach 2^53."""
    width = min(queries.shape[1], rows.shape[1])
    q, r = queries[:, :width], rows[:, :width]
    most = width * np.abs(q.astype(float)).max(initial=0) * np.abs(r.astype(float)).max(initial=0)
    if most < 2**24:
        return (q.astype(np.float32) @ r.T.astype(np.float32)).astype(np.int64)
    if most < 2**53:
        return (q.astype(np.float64) @ r.T.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return q @ r.T
    wide = np.iinfo(np.int64)
    return np.clip(q.astype(object) @ r.T.astype(object), wide.min, wide.max).astype(np.int64)


class Best:
    """The k best (score, smallest id) per query, as they are found."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.kept = np.zeros((n, k), bool)

    def kth(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of the queries at rows against a block's ids."""
        if scores.shape[1] > 2 * self.k:  # rows that cannot be among the k best leave before the sort
            floor = np.partition(np.where(allowed, scores, np.iinfo(np.int64).min), -self.k, axis=1)[:, -self.k, None]
            floor = np.maximum(floor, self.kth()[rows][:, None])
            allowed = allowed & (scores >= floor)
        at, of = np.nonzero(allowed)
        if not len(at):
            return
        depth = np.bincount(at, minlength=len(rows))
        place = np.arange(len(at)) - np.repeat(np.cumsum(depth) - depth, depth)
        width = int(depth.max())
        s = np.full((len(rows), width), np.iinfo(np.int64).min)
        i = np.full((len(rows), width), np.iinfo(np.int64).max)
        k = np.zeros((len(rows), width), bool)
        s[at, place], i[at, place], k[at, place] = scores[at, of], ids[of], True
        s, i, k = (np.concatenate(x, axis=1) for x in ((self.scores[rows], s), (self.ids[rows], i), (self.kept[rows], k)))
        order = np.lexsort((i, ~s, ~k))[:, : self.k]
        self.scores[rows], self.ids[rows], self.kept[rows] = (np.take_along_axis(x, order, axis=1) for x in (s, i, k))


def search_group(query_ids: np.ndarray, queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[Best, int]:
    """The k best of a group of blocks for each query, and how many (query, block) pairs were scored."""
    bounds = np.stack([_bound(queries, m) for _, m in blocks], axis=1)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best, scored = Best(len(queries), k), 0
    open_ = np.arange(len(queries))
    for visit in range(len(blocks)):
        at = order[open_, visit]
        going = (bounds[open_, at] >= best.kth()[open_]) | ~best.kept[open_, -1]
        open_, at = open_[going], at[going]
        scored += len(open_)
        for b in np.unique(at):
            rows = open_[at == b]
            ids, matrix = blocks[b]
            best.add(rows, _product(queries[rows], matrix), ids, ids[None, :] != query_ids[rows, None])
    return best, scored


def _bound(queries: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    most, least = matrix.max(axis=0, keepdims=True), matrix.min(axis=0, keepdims=True)
    return (_product(np.maximum(queries, 0), most) + _product(np.minimum(queries, 0), least))[:, 0]


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = TOP,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    blocks_per_group: int = BLOCKS_PER_GROUP,
    queries_per_batch: int = QUERIES_PER_BATCH,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows.  queries is a condition on vec_id."""
    rows = cut(usable(vectors, id_col, vector_col, scale))
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(queries)).first()
    index = _grouped(rows, math.ceil(n / (block * blocks_per_group)), block, "group")
    batches = _grouped(rows.filter(queries), math.ceil(asked / queries_per_batch), queries_per_batch, "batch")
    groups, rounds = (df.agg(F.max(name)).first()[0] for df, name in ((index, "group"), (batches, "batch")))
    if rounds is None:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    every = lambda last, name: F.explode(F.sequence(F.lit(0), F.lit(last))).alias(name)
    cells = batches.select("*", every(groups, "group")).groupBy("group", "batch")

    def answered(questions: pa.Table, blocks: pa.Table) -> pa.Table:
        index_blocks = [_unpack(r["ids"], r["width"], r["data"]) for r in blocks.sort_by("low").to_pylist()]
        out = [np.zeros((3, 0), np.int64)]
        for row in questions.to_pylist() if index_blocks else []:
            ids, matrix = _unpack(row["ids"], row["width"], row["data"])
            best, _ = search_group(ids, matrix, index_blocks, k)
            q, j = np.nonzero(best.kept)
            out.append(np.stack([ids[q], best.ids[q, j], best.scores[q, j]]))
        q, v, s = np.concatenate(out, axis=1)
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    found = cells.cogroup(index.select("*", every(rounds, "batch")).groupBy("group", "batch")).applyInArrow(answered, RANKED)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {TOP}
"""
