"""Spelling variant grouping by sorted-list dynamic programming.

Words one edit apart are found by running each word's banded edit matrix down a sorted list: rows
of the matrix belong to prefixes, so words that follow each other in the list share the rows of their
common prefix, and once all entries of a prefix's row exceed one edit the whole range of words with that
prefix is skipped.  A band of three entries is enough.  The rows of many words are worked out at a time, prefix length by prefix length.

So that no list holds the vocabulary, an edit is first located: it lies in one half of the shorter word, and the other half is
common to both.  For the lengths L and L + 1, each word stands in one list per half, named by the
characters outside it; a list that grows too long is cut again by halving the part that may differ, which
ends at one character and so at a list bounded by the alphabet.  A pair counts only in
the list whose part holds the first character in which the two differ, so it counts once.  A list gives one row
per word (how many near words, which is the best), so pairs stay where they are found.

Words are runs of Latin letters (code points U+0041 to U+00FF, one byte each in Latin-1); A-Z are lower-cased.  By a
checksum of id and run some runs lose a code point, as typing errors would.  Null texts have no words; a
null id counts as the text ``null``; rows that repeat count each.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

RUN = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
DELETE_EVERY = 31
#: Words in a list before the part that may differ is halved; above the square of the alphabet, so that parts of one character always fit.
LIST_WORDS = 20_000
#: Entries of the edit matrices that are worked out at a time, and bytes of words.
FRONTIER = 1 << 19
BATCH_BYTES = 16 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIST = ["length", "first", "past", "head", "tail"]
NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def vocabulary(docs: DataFrame, min_length: int, min_count: int, delete_every: int, id_col: str, text_col: str) -> DataFrame:
    """word, n."""
    # runs shorter than a word are never one
    runs = F.regexp_extract_all(text_of(text_col).cast("string"), F.lit(RUN + "{%d,}" % max(1, min_length)), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.explode(runs).alias("run"))
    run = F.col("run")
    low = F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    rows = rows.select("id", low.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = rows.select(F.when(F.col("h") % delete_every == 0, shorter).otherwise(run).alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _named(rows: DataFrame, parts: Column) -> DataFrame:
    """Rows word, n of each list: parts is an array of (length, first, past), the shorter length and the part that may differ."""
    rows = rows.select("word", "n", F.explode(parts).alias("part")).select("word", "n", "part.*")
    head = F.substring("word", F.lit(1), F.col("first"))
    tail = F.expr("right(word, length - past)")
    return rows.select("word", "n", "length", "first", "past", head.alias("head"), tail.alias("tail"))


def _part(length: Column, first: Column, past: Column) -> Column:
    return F.struct(length.cast("int").alias("length"), first.cast("int").alias("first"), past.cast("int").alias("past"))


def lists(words: DataFrame, min_length: int, list_words: int) -> DataFrame:
    """Rows word, n, length, first, past, head, tail; no list has more than list_words words, if its part has more than one character."""
    n = F.char_length("word")
    half = lambda m: F.floor(m / 2)
    both = lambda m: [_part(m, F.lit(0), half(m)), _part(m, half(m), m)]
    as_longer = F.when(n > max(1, min_length), F.array(*both(n - 1))).otherwise(F.array().cast("array<struct<length:int,first:int,past:int>>"))
    open_ = _named(words, F.filter(F.concat(F.array(*both(n)), as_longer), lambda p: p["past"] > p["first"]))
    done = []
    while True:
        wide = F.col("past") - F.col("first") > 1
        long = cut(open_.groupBy(*LIST).count().filter((F.col("count") > list_words) & wide).drop("count"))
        if long.isEmpty():
            break
        done.append(open_.join(long, LIST, "left_anti").select("word", "n", *LIST))
        middle = F.floor((F.col("first") + F.col("past")) / 2)
        halves = F.array(_part(F.col("length"), F.col("first"), middle), _part(F.col("length"), middle, F.col("past")))
        open_ = _named(open_.join(long, LIST, "left_semi"), halves)
    for part in done:
        open_ = open_.union(part)
    return open_


class Lists:
    """Sorted lists in a row: middles (the parts that may differ) as bytes, the list of each, the length of the shorter ones."""

    def __init__(self, middles: list[bytes], group: np.ndarray, shorter: np.ndarray) -> None:
        n = len(middles)
        self.lengths = np.fromiter(map(len, middles), np.int64, n)
        width = int(self.lengths.max(initial=0)) + 2
        self.chars = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in middles), np.uint8).reshape(n, width)
        self.shorter = shorter
        new = np.diff(group, prepend=-1) != 0
        # characters that each word shares with the one before it in its list; none with that of another list
        self.shared = np.full(n, -1)
        same = np.flatnonzero(~new)
        for a in range(0, len(same), 1 << 14):
            at = same[a : a + (1 << 14)]
            self.shared[at] = (self.chars[at] != self.chars[at - 1]).argmax(axis=1)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        of = np.cumsum(new) - 1
        self.low, self.high = starts[of], ends[of]

    def near(self, frontier: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (word of the shorter length, other word of its list one edit away)."""
        asked = np.flatnonzero((self.lengths == self.shorter) & (self.high - self.low > 1))
        rows = np.full((3, len(asked)), 2, np.uint8)
        rows[1], rows[2] = 0, 1
        work = [(0, asked, self.low[asked], self.high[asked], rows)]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        heads: dict[int, np.ndarray] = {}
        while work:
            depth, word, low, high, band = work.pop()
            if depth not in heads:  # where a new prefix of depth + 1 characters begins
                heads[depth] = np.append(np.flatnonzero(self.shared <= depth), len(self.shared))
            begin = np.searchsorted(heads[depth], low)
            size = np.searchsorted(heads[depth], high) - begin
            if size.sum() > frontier and len(word) > 1:
                half = len(word) // 2
                work += [(depth, word[s], low[s], high[s], band[:, s]) for s in (slice(half), slice(half, None))]
                continue
            up = np.repeat(np.arange(len(word)), size)
            child = np.arange(len(up)) + np.repeat(begin - (np.cumsum(size) - size), size)
            low, high, word, band = heads[depth][child], heads[depth][child + 1], word[up], band[:, up]
            char = self.chars[low, depth]
            ended = char == 0  # the word at low is the prefix itself
            length = self.shorter[word]
            last = np.where(length == depth, band[1], np.where(length == depth - 1, band[0], 2))
            hit = ended & (last == 1)
            found.append((word[hit], low[hit]))
            going = ~ended
            low, high, word, char, band, length = low[going], high[going], word[going], char[going], band[:, going], length[going]
            band = self._next_row(band, char, word, depth, length)
            alive = band.min(axis=0, initial=2) <= 1
            if alive.any():
                work.append((depth + 1, word[alive], low[alive], high[alive], band[:, alive]))
        a, b = (np.concatenate(x) for x in zip(*found))
        return a, b

    def _next_row(self, band: np.ndarray, char: np.ndarray, word: np.ndarray, depth: int, length: np.ndarray) -> np.ndarray:
        """The band of the next prefix: columns depth, depth + 1, depth + 2 of its row; 2 stands for more than one edit."""
        width = self.chars.shape[1]
        differs = [self.chars[word, min(max(depth + k, 0), width - 1)] != char for k in (-1, 0, 1)]
        out = np.empty_like(band)
        out[0] = np.minimum(band[0] + differs[0], band[1] + 1)
        out[1] = np.where(depth + 1 <= length, np.minimum(np.minimum(band[1] + differs[1], band[2] + 1), out[0] + 1), 2)
        out[2] = np.where(depth + 2 <= length, np.minimum(band[2] + differs[2], out[1] + 1), 2)
        return np.minimum(out, 2)

    def first_difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for at in range(0, len(a), 1 << 14):
            s = slice(at, at + (1 << 14))
            out[s] = (self.chars[a[s]] != self.chars[b[s]]).argmax(axis=1)
        return out


def _scanned(rows: list[tuple], frontier: int) -> pa.RecordBatch:
    """rows: list number, word, n, length, first, past, in the order of the lists and of the words in them."""
    number, words, counts, length, first, past = zip(*rows)
    middles = [w[a : len(w) - (m - b)].encode("latin-1") for w, m, a, b in zip(words, length, first, past)]
    length, first, past = (np.array(x, np.int64) for x in (length, first, past))
    held = Lists(middles, np.array(number), past - first)
    a, b = held.near(frontier)
    # in its own list a pair differs before the end of the part, or in the last part
    own = (held.first_difference(a, b) < (past - first)[a]) | (past == length)[a]
    a, b = a[own], b[own]
    longer = held.lengths[b] > held.lengths[a]  # words of the shorter length meet both ways by themselves
    a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
    n = np.array(counts, np.int64)
    of_pairs = np.unique(b)
    rank = np.zeros(len(words), np.int64)
    rank[of_pairs[sorted(range(len(of_pairs)), key=lambda k: words[of_pairs[k]])]] = np.arange(len(of_pairs))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    word, at, times = np.unique(a, return_index=True, return_counts=True)
    best = b[at]
    return pa.record_batch([pa.array([words[k] for k in word.tolist()], pa.string()), pa.array(times, pa.int64()), pa.array(n[best]), pa.array([words[k] for k in best.tolist()], pa.string())], schema=NEAR)


def _scan(frontier: int, batch_bytes: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        list_rows: list[tuple] = []
        key, number, width = None, 0, 0

        def closed() -> bool:
            """Moves the list that has ended to the held ones; says whether they are enough."""
            nonlocal list_rows, width
            if len(list_rows) > 1:
                held.extend(list_rows)
                width = max(width, max(len(r[1]) for r in list_rows))
            list_rows = []
            return len(held) * width > batch_bytes

        for batch in batches:
            for word, n, length, first, past, head, tail in zip(*(c.to_pylist() for c in batch.columns)):
                own = (length, first, past, head, tail)
                if own != key:
                    if closed():
                        yield _scanned(held, frontier)
                        held, width = [], 0
                    key, number = own, number + 1
                list_rows.append((number, word, n, length, first, past))
        closed()
        if held:
            yield _scanned(held, frontier)

    return scan


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, list_words: int = LIST_WORDS, frontier: int = FRONTIER, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """words: word, n.  Gives word, n_near, best_n, best for the words that have a near word: how many, and the one of largest n (ties: smallest)."""
    middle = F.expr("substring(word, first + 1, char_length(word) - first - (length - past))")  # code-point order, which is that of Latin-1
    named = lists(words, min_length, list_words).repartition(*LIST).sortWithinPartitions(*LIST, middle)
    found = named.select("word", "n", *LIST).mapInArrow(_scan(frontier, batch_bytes), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("best")))
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return whole.select("word", "n_near", (-F.col("b.minus_n")).alias("best_n"), F.col("b.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """links: word, form, where forms never run in a circle.  Gives word, root: the last form, by doubling steps."""
    found = cut(links.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(found.join(further, "root", "left").select("word", "root", "next"))
        if step.filter("next IS NOT NULL").isEmpty():
            return step.select("word", "root")
        found = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
    delete_every: int = DELETE_EVERY,
    id_col: str = "doc_id",
    text_col: str = "text",
    list_words: int = LIST_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of docs."""
    words = cut(vocabulary(docs, min_length, min_count, delete_every, id_col, text_col))
    near = near_words(words, min_length, list_words)
    joined = words.join(near, "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = cut(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
        )
    )
    root = roots(formed.filter("form IS NOT NULL"))
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
