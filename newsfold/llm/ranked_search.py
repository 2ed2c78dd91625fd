"""Ranked lexical search by norm buckets.

Each document is a vector of impacts over the terms asked for, each item a vector of weights; a score is their inner product.
The vectors are ordered by length over the whole corpus, longest first, and cut into buckets of neighbours in that order.  A bucket whose
greatest length times the item's length lies below the item's tenth score so far is left out
(Cauchy-Schwarz).  Inside a bucket the item's heaviest coordinates are summed through the bucket's lists, and what the
others can add is bounded by the lengths of the rests; vectors whose bound falls short are left out, the rest are scored anew with all terms in
64-bit integers.  The search starts from the tenth score among the longest vectors of all, and each task raises it as it goes.

Items are asked in batches of bounded size, each against all documents; a batch's terms, weights and starting scores are all that the
driver holds, and all that each task gets besides its own documents.  A task gives at most ten rows per item.

Rows that share an item id are one item with the terms of all its texts, a null id included; items without a term that
documents hold have no rows.  Document rows that repeat an id are documents of their own; a null id comes after all others of equal
score.  Null and empty texts have no terms.  Columns other than the ids and texts are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import corpus_bytes, cut, shuffle_partitions, text_of

TOP = 10
BUCKET = 1024
#: Longest vectors that give the starting scores.
SEED_ROWS = 2048
#: Vectors a task searches, so that tasks grow in number with the documents.
ROWS_PER_TASK = 1 << 14
#: Bytes of item texts that one pass over the documents answers.
BATCH_BYTES = 4 << 20
#: The coordinates summed through the lists hold at least so much of an item's squared length.
FOCUS = 0.75
#: Bounds are floating point; they are raised by so much before they exclude anything.
SLACK = 1 + 1e-9

#: Bytes that stand in no term become spaces, A-Z become a-z; all bytes of other code points stand in terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
NO_ID = np.iinfo(np.int64).max

COUNTED = "doc_id long, n long, terms array<int>, tfs array<long>"
VECTORS = "doc_id long, norm double, terms binary, impacts binary"
VECTOR_FIELDS = pa.schema([("doc_id", pa.int64()), ("norm", pa.float64()), ("terms", pa.binary()), ("impacts", pa.binary())])
FOUND = "item long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split(b" ")


def _counted(vocabulary: dict[bytes, int]):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, offsets, terms, tfs = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()):
                own = Counter(terms_of(text.as_py()))
                own.pop(b"", None)
                ns.append(own.total())
                asked = [(vocabulary[t], n) for t, n in own.items() if t in vocabulary]
                terms += [t for t, _ in asked]
                tfs += [n for _, n in asked]
                offsets.append(len(terms))
            at = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (tfs, pa.int64()))]
            yield pa.record_batch([batch.column(0), pa.array(ns, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return counted


def _vectors(weights: np.ndarray, whole: int, length: int):
    """Impacts of the documents, without the terms that weigh nothing."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tfs = (c.values.to_numpy() for c in batch.columns[2:])
            at = batch.column(2).offsets.to_numpy()
            out = []
            for doc_id, n, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                use = weights[terms[a:b]] > 0
                if use.any():
                    m = 100 - 75 + (75 * n * whole) // length
                    tf = tfs[a:b][use]
                    impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m)  # below 1,000,000
                    norm = math.sqrt(float((impacts.astype(np.float64) ** 2).sum()))
                    if norm:
                        out.append({"doc_id": doc_id, "norm": norm, "terms": terms[a:b][use].astype(np.int32).tobytes(), "impacts": impacts.astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, VECTOR_FIELDS)

    return vectors


class Items:
    """Items as weight vectors: per item the terms with a weight, heaviest first, and what of the item's length the first ones leave."""

    def __init__(self, vectors: list[dict[int, int]], focus: float = FOCUS) -> None:
        self.terms, self.weights, self.norms, self.focus, self.rests = [], [], [], [], []
        for vector in vectors:
            order = sorted(vector, key=lambda t: (-vector[t], t))
            weights = np.array([vector[t] for t in order], np.int64)
            squares = np.cumsum(weights.astype(np.float64) ** 2)
            total = squares[-1] if len(squares) else 0.0
            first = int(np.searchsorted(squares, focus * total)) + 1 if total else 0
            self.terms.append(np.array(order, np.int64))
            self.weights.append(weights)
            self.norms.append(math.sqrt(total))
            self.focus.append(min(first, len(order)))
            self.rests.append(math.sqrt(max(0.0, total - squares[self.focus[-1] - 1])) if total else 0.0)
        self.norms = np.array(self.norms)

    def __len__(self) -> int:
        return len(self.terms)


class Bucket:
    """Documents in a row, by document and by term."""

    def __init__(self, ids: list, norms: list[float], terms: list[bytes], impacts: list[bytes], vocabulary: int) -> None:
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.known = np.array([i is not None for i in ids], bool)
        self.norms = np.array(norms)
        held = [np.frombuffer(t, np.int32) for t in terms]
        self.sizes = np.array([len(t) for t in held], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.terms = np.concatenate(held).astype(np.int64)
        self.impacts = np.concatenate([np.frombuffer(i, np.int32) for i in impacts]).astype(np.int64)
        order = np.argsort(self.terms, kind="stable")
        self.of = np.repeat(np.arange(len(ids)), self.sizes)[order]
        self.by_term = self.impacts[order].astype(np.float64)
        self.lists = np.searchsorted(self.terms[order], np.arange(vocabulary + 1))

    def bounds(self, items: Items, q: int) -> np.ndarray:
        """No document's score with the item is above its bound."""
        sums, squares = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for t, w in zip(items.terms[q][: items.focus[q]].tolist(), items.weights[q].tolist()):
            a, b = self.lists[t], self.lists[t + 1]
            if a < b:  # a document stands in a term's list once
                sums[self.of[a:b]] += w * self.by_term[a:b]
                squares[self.of[a:b]] += self.by_term[a:b] ** 2
        return sums + items.rests[q] * np.sqrt(np.maximum(0.0, self.norms**2 * SLACK - squares))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of some documents with an item, given as a weight per term."""
        sizes = self.sizes[rows]
        at = np.arange(sizes.sum()) + np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes)
        products = dense[self.terms[at]] * self.impacts[at]
        return np.add.reduceat(products, np.cumsum(sizes) - sizes)


class Search:
    """The best documents of each item among the buckets seen so far."""

    def __init__(self, items: Items, vocabulary: int, k: int, floors: np.ndarray) -> None:
        self.items, self.k, self.floors = items, k, floors.astype(np.int64).copy()
        self.best = [np.zeros((3, 0), np.int64) for _ in range(len(items))]
        self.dense = np.zeros(vocabulary, np.int64)
        self.buckets = self.bounded = self.scored = 0

    def see(self, bucket: Bucket) -> None:
        longest = bucket.norms.max()
        open_ = np.flatnonzero((self.items.norms > 0) & (self.items.norms * longest * SLACK >= self.floors))
        self.buckets += len(open_)
        for q in open_.tolist():
            rows = np.flatnonzero(bucket.bounds(self.items, q) * SLACK >= max(1, self.floors[q]))
            self.bounded += len(bucket.ids)
            self.scored += len(rows)
            if len(rows):
                terms = self.items.terms[q]
                self.dense[terms] = self.items.weights[q]
                scores = bucket.scores(rows, self.dense)
                self.dense[terms] = 0
                self._add(q, scores, bucket.ids[rows], bucket.known[rows])

    def _add(self, q: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        fit = scores >= max(1, self.floors[q])
        found = np.concatenate([self.best[q], np.stack([scores[fit], ids[fit], known[fit].astype(np.int64)])], axis=1)
        order = np.lexsort((found[1], ~found[2], -found[0]))[: self.k]
        self.best[q] = found[:, order]
        if len(order) == self.k:
            self.floors[q] = max(self.floors[q], found[0, order[-1]])

    def rows(self) -> pa.RecordBatch:
        sizes = [b.shape[1] for b in self.best]
        scores, ids, known = np.concatenate([np.zeros((3, 0), np.int64), *self.best], axis=1)
        item = np.repeat(np.arange(len(sizes)), sizes)
        return pa.record_batch([pa.array(item), pa.array(ids, mask=known == 0), pa.array(scores)], ["item", "doc_id", "score"])


def _searched(items: Items, vocabulary: int, k: int, floors: np.ndarray, size: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, vocabulary, k, floors)
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= size:
                search.see(Bucket(*zip(*held[:size]), vocabulary))
                held = held[size:]
        if held:
            search.see(Bucket(*zip(*held), vocabulary))
        yield search.rows()

    return searched


def _asked(items: DataFrame) -> tuple[list, list[Counter], dict[bytes, int]]:
    """Ids, terms with their number of occurrences, and the vocabulary of a batch of items."""
    vocabulary: dict[bytes, int] = {}
    by_id: dict = {}
    for row in items.collect():  # a batch of bounded size
        own = by_id.setdefault(row["item_id"], Counter())
        own.update(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(row["text"].encode()) if t)
    return list(by_id), list(by_id.values()), vocabulary


def _batch(docs: DataFrame, items: DataFrame, k: int, bucket: int, seed_rows: int) -> DataFrame | None:
    """item_id, doc_id, score of the k best documents of each item of a batch."""
    ids, counts, vocabulary = _asked(items)
    if not vocabulary:
        return None
    counted = cut(docs.mapInArrow(_counted(vocabulary), COUNTED).filter("n > 0"))
    whole, length = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not whole:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term asked for
        weights[term] = math.floor(1000 * math.log((2 * whole + 2) / (2 * df + 1)))
    asked = Items([{t: n * int(weights[t]) for t, n in own.items() if weights[t] > 0} for own in counts])

    vectors = counted.filter(F.size("terms") > 0).mapInArrow(_vectors(weights, whole, length), VECTORS)
    numbered = cut(vectors.withColumn("row", F.monotonically_increasing_id()))  # rows of a written table, so numbers stay
    longest = numbered.orderBy(F.desc("norm"), "row").limit(seed_rows).select("doc_id", "norm", "terms", "impacts")
    floors = np.zeros(len(asked), np.int64)
    sought = longest.coalesce(1).mapInArrow(_searched(asked, len(vocabulary), k, floors, bucket), FOUND)
    for item, kth in sought.groupBy("item").agg(F.min("score"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select("item", "min(score)").collect():
        floors[item] = kth

    # equal lengths are told apart by the row, so that copies spread over partitions
    tasks = max(shuffle_partitions(docs), math.ceil(whole / ROWS_PER_TASK))
    ranged = numbered.repartitionByRange(tasks, F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row")
    found = ranged.select("doc_id", "norm", "terms", "impacts").mapInArrow(_searched(asked, len(vocabulary), k, floors, bucket), FOUND)
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), "item long, item_id long")  # the items of the batch
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    bucket: int = BUCKET,
    seed_rows: int = SEED_ROWS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), text_of(item_text_col).cast("string").alias("text"))
    batches = max(1, math.ceil(corpus_bytes(asked, "text") / batch_bytes))
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(batches):
        own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == number)
        found = _batch(rows, own, k, bucket, seed_rows)
        out = out if found is None else out.unionByName(found)
    return out


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), q AS (
  SELECT item_id, t, count(*)::BIGINT AS times FROM i GROUP BY item_id, t
), s AS (
  SELECT count(*)::HUGEINT AS whole, sum(len(ts))::HUGEINT AS length FROM d WHERE len(ts) > 0
), o AS (
  SELECT r, doc_id, len(ts) AS n, t, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, doc_id, len(ts), t
), w AS (
  SELECT t, floor(1000 * ln((2 * any_value(whole) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM o, s GROUP BY t
), p AS (
  SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n::HUGEINT * whole) // length)::BIGINT) AS impact FROM o, s
), c AS (
  SELECT q.item_id, p.r, p.doc_id, sum(q.times * w.w * p.impact)::BIGINT AS score
  FROM q JOIN w USING (t) JOIN p USING (t) GROUP BY q.item_id, p.r, p.doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
WHERE rank <= 10
"""
