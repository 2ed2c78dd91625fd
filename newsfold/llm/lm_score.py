"""Language-model scores of documents by stupid backoff.

The n-gram counts of all orders stand in tables partitioned by the n-gram's
hash.  The documents' n-grams, exploded and summed per block of documents, are
joined to the tables partition by partition: a partition sums the counts of all
blocks into its part of the table and returns to each block the totals of the n-grams it holds.  Words and pairs
go first; a longer n-gram is only asked for where both shorter ones in it occur more than once, for all others
occur once and need no table.  Each document then sums the logarithms of its words' scores.

A word's score is c(n-gram) / c(n-gram without its last word) for the longest n-gram ending in it that is in the tables;
for each order passed over it is multiplied by ALPHA; with no n-gram left it is c(word) / N.  The tables hold all words, and
longer n-grams from min_count occurrences on, by default all of them.  N-grams stay inside a document, so its first
words start with shorter ones.  N-grams are told apart by 64-bit hashes.

Words are ASCII white-space separated, unchanged.  Null and empty texts have no words: score 0 and a null mean.  All rows count, repeated ones too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix, pack, unpack
from .exchange import BLOCK_BYTES, Blocks, answer, ids_array, union, word_hashes

ORDER = 3
ALPHA = 0.4
MIN_COUNT = 1
DECIMALS = 6
#: Kind of message that carries the number of words.
WORDS = 0

ROWS = "doc_id long, n_words long, score double, mean double"
COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64()), ("mean", pa.float64())])


class Grams:
    """The n-grams of a block's texts, order by order: next() moves to the next order, learn() takes its table's counts.
    From order 3 on an n-gram with a part that occurs once occurs once itself, so only the others are looked up."""

    def __init__(self, texts: list[bytes], min_count: int) -> None:
        self.words, self.counts = word_hashes(texts)
        self.min_count = min_count
        ends = np.cumsum(self.counts)
        places = np.arange(len(self.words))
        self.room = (np.repeat(ends, self.counts) - places).astype(np.int32)
        self.place = (places - np.repeat(ends - self.counts, self.counts)).astype(np.int32)  # of the word in its document
        self.hashes = mix(self.words)
        self.order = 0
        self.tables: list[np.ndarray] = []  # for each order, the count of the n-gram that starts at each word

    def next(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of the next order's n-grams, and how often each occurs here."""
        self.order += 1
        starts = np.flatnonzero(self.room >= self.order)
        if self.order > 1:
            self.hashes[starts] = mix(self.hashes[starts] * np.uint64(0x9E3779B97F4A7C15) + self.words[starts + self.order - 1])
        if self.order > 2:
            shorter = self.tables[-1] >= max(2, self.min_count)
            starts = starts[shorter[starts] & shorter[starts + 1]]
        keys, which, times = np.unique(self.hashes[starts], return_inverse=True, return_counts=True)
        self.asked = starts, which
        return keys, times.astype(np.uint32)

    def learn(self, totals: np.ndarray) -> None:
        table = (self.room >= self.order).astype(np.int64)  # one occurrence, unless looked up
        starts, which = self.asked
        table[starts] = totals[which]
        self.tables.append(table)


def log_scores(grams: Grams, n_words: int, alpha: float) -> np.ndarray:
    """log10 of each word's score."""
    n = len(grams.place)
    out, passed, open_ = np.zeros(n), np.zeros(n), np.ones(n, bool)
    for order in range(len(grams.tables), 0, -1):
        there = np.flatnonzero(open_ & (grams.place >= order - 1))
        found = grams.tables[order - 1][there - order + 1]
        kept = found >= (grams.min_count if order > 1 else 1)
        at = there[kept]
        below = grams.tables[order - 2][at - order + 1] if order > 1 else float(n_words)
        out[at] = np.log10(found[kept] / below) + passed[at] * np.log10(alpha)
        passed[there] += 1
        open_[at] = False
    return out


def score(
    docs: DataFrame,
    order: int = ORDER,
    alpha: float = ALPHA,
    min_count: int = MIN_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, score (the sum of log10 scores), mean for every row of docs, under the counts of all of them."""
    blocks = Blocks(docs, id_col, text_col, block_bytes)
    bits = blocks.bucket_bits(blocks.bytes / 6)

    def reach(texts, told, orders):
        grams = Grams(texts, min_count)
        for m in range(1, orders + 1):
            grams.next()
            grams.learn(np.concatenate([np.zeros(0, np.int64), *[unpack(a, np.int64) for a in told.get(m, [])]]))
        return grams

    def first_orders(ids, texts, told):
        grams = Grams(texts, min_count)
        n = grams.counts.sum(keepdims=True).astype(np.uint64)
        out = [(WORDS, np.zeros(1, np.uint64), [n])]
        for m in range(1, min(order, 2) + 1):
            keys, times = grams.next()
            out.append((m, keys, [times]))
        return out

    def of_order(m):
        def question(ids, texts, told):
            keys, times = reach(texts, told, m - 1).next()
            return [(m, keys, [times])]

        return question

    def merge(kind, keys, extras):
        unit = np.dtype(np.uint64 if kind == WORDS else np.uint32)
        times = [np.frombuffer(e, np.uint8).reshape(unit.itemsize, -1).T.copy().view(unit).ravel() for e in extras]
        found, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(found), np.int64)
        np.add.at(totals, which, np.concatenate(times).astype(np.int64))
        return [pack(x) for x in np.split(totals[which], np.cumsum([len(k) for k in keys])[:-1])]

    def result(ids, texts, told):
        grams = reach(texts, told, order)
        logs = log_scores(grams, int(unpack(told[WORDS][0], np.int64)[0]), alpha)
        ends = np.cumsum(grams.counts)
        sums = [round(float(logs[a:b].sum()), DECIMALS) for a, b in zip((ends - grams.counts).tolist(), ends.tolist())]
        means = [s / n if n else None for s, n in zip(sums, grams.counts.tolist())]
        return [ids_array(ids), grams.counts, sums, means]

    answers = [answer(blocks.ask(bits, first_orders), merge)]
    for m in range(3, order + 1):
        answers.append(answer(blocks.ask(bits, of_order(m), union(*answers)), merge))
    return blocks.tell(result, union(*answers), ROWS, COLUMNS)


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d
), g AS (
  SELECT doc_id, i, w[i] AS w3,
         CASE WHEN i > 1 THEN w[i - 1] END AS w2,
         CASE WHEN i > 2 THEN w[i - 2] END AS w1
  FROM p
), c1 AS (SELECT w3 AS a, count(*) AS c FROM g GROUP BY ALL),
   c2 AS (SELECT w2 AS a, w3 AS b, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
   c3 AS (SELECT w1 AS a, w2 AS b, w3 AS c_, count(*) AS c FROM g WHERE w1 IS NOT NULL GROUP BY ALL),
   n AS (SELECT count(*) AS n FROM g),
s AS (
  SELECT g.doc_id,
         CASE WHEN t.c >= {MIN_COUNT} THEN log10(t.c::DOUBLE / tb.c)
              WHEN b.c >= {MIN_COUNT} THEN log10(b.c::DOUBLE / bu.c) + (g.w1 IS NOT NULL)::INT * log10({ALPHA})
              ELSE log10(u.c::DOUBLE / n.n) + ((g.w1 IS NOT NULL)::INT + (g.w2 IS NOT NULL)::INT) * log10({ALPHA}) END AS l
  FROM g CROSS JOIN n
  JOIN c1 u ON u.a = g.w3
  LEFT JOIN c2 b ON b.a = g.w2 AND b.b = g.w3
  LEFT JOIN c1 bu ON bu.a = g.w2
  LEFT JOIN c3 t ON t.a = g.w1 AND t.b = g.w2 AND t.c_ = g.w3
  LEFT JOIN c2 tb ON tb.a = g.w1 AND tb.b = g.w2
), r AS (SELECT doc_id, round(sum(l), {DECIMALS}) AS score FROM s GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(r.score, 0.0) AS score,
       CASE WHEN len(d.w) > 0 THEN r.score / len(d.w) END AS mean
FROM d LEFT JOIN r USING (doc_id)
"""
