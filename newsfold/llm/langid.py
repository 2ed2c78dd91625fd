"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts (up to ORDER bytes long) holds how
often each byte followed.  The statistics are frozen after training; a text's
code length under a language is the sum over its bytes of the PPM-C cost: in
the longest context that the tree has seen, -log2(count / (n + d)), where n is
the context's count and d its number of distinct bytes; a byte not seen there
pays the escape -log2(d / (n + d)) and is coded in the next shorter context,
without the bytes that the longer one has ruled out, at last evenly over the bytes not yet ruled out.

The contexts are suffixes of each other, and whatever byte followed a longer one also followed the shorter one.  So what a longer
context rules out changes the shorter one's n and d only, and the cost under a context is that under the next shorter one plus one of
two numbers: one if the byte has followed the shorter context, one if not.  A language's tree is kept as sorted arrays of the
contexts with these two numbers and of the (context, byte) pairs seen with their cost, so its size follows its own sample
and not the other languages'.  Scoring looks the distinct byte runs of a block of texts up in one tree after the
other, in batches inside tasks, without a shuffle.

Every language that has a labelled text takes part, with the whole of its tree.  Training takes at most DOCS_PER_LANGUAGE
whole documents of each (those with the smallest hash of their id); the bound is a parameter.

The predicted language has the smallest code length (ties: the first in code-point order); score is its share of 2^-length
over all languages.  Null texts and texts without a letter are "und" with score 0, as is every text if there is
nothing to learn from.  Rows that repeat an id are predicted one by one; a null id takes no part in training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
ORDER = 3
DOCS_PER_LANGUAGE = 300
#: Bytes scored at a time, to bound a task's memory.
CHUNK = 1 << 20
#: Every text is read as if it followed this many line feeds.
START = b"\n" * ORDER


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after START; first and end position of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + ORDER)
    return np.frombuffer(START + START.join(texts) if texts else b"", np.uint8), ends - lengths, ends


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ORDER + 1 bytes that end inside a text, as big-endian integers, and their counts."""
    data, firsts, ends = _joined(texts)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, firsts, 1)
    np.add.at(inside, ends, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    grams = np.zeros(len(at), np.int64)
    for back in range(ORDER, -1, -1):
        grams = grams << 8 | data[at - back]
    return np.unique(grams, return_counts=True)


def training_rows(docs: DataFrame, train, per_language: int) -> DataFrame:
    """doc_id, language of the sample: at most per_language rows of each language."""
    usable = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    sample = usable.withColumn("rank", rank).filter(F.col("rank") <= per_language)
    return sample.select("doc_id", F.col("lang").alias("language")).distinct()


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in the sorted keys, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """One language's statistics, as costs.  For each length of context: the runs (context and byte) seen, their cost in bits,
    the contexts, and what to add to the shorter context's cost for a byte that this one has not seen: to the cost of a byte
    that the shorter one has seen, and of another."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, min_seen: int) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []
        counts, shorter = counts.astype(np.float64), None
        for order in range(ORDER + 1):
            runs, which = np.unique(grams & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            seen = np.bincount(which, counts, len(runs))
            if order == ORDER and min_seen > 1:
                _, of = np.unique(runs >> 8, return_inverse=True)
                stays = np.bincount(of, seen)[of] >= min_seen
                runs, seen = runs[stays], seen[stays]
            nodes, of = np.unique(runs >> 8, return_inverse=True)
            n, d = np.bincount(of, seen, len(nodes)), np.bincount(of, minlength=len(nodes)).astype(np.float64)
            size, escape = np.log2(n + d), np.log2(n + d) - np.log2(d)
            if shorter is None:
                after_seen, after_other = np.zeros(len(nodes)), escape + np.log2(np.maximum(256 - d, 1))
            else:
                up, _ = _places(shorter["nodes"], nodes & ((1 << 8 * (order - 1)) - 1))
                same, _ = _places(shorter["runs"], runs & ((1 << 8 * order) - 1))
                n_left = shorter["n"][up] - np.bincount(of, shorter["seen"][same], len(nodes))
                d_left = shorter["d"][up] - d
                some = d_left > 0  # else the shorter context has nothing more to offer and costs nothing
                left = np.log2(np.where(some, n_left + d_left, 1))
                after_seen = escape + left - shorter["size"][up]
                after_other = escape + left - np.log2(np.where(some, d_left, 1)) - shorter["escape"][up]
            self.levels.append((runs.astype(np.uint32), (size[of] - np.log2(seen)).astype(np.float32), nodes.astype(np.uint32), after_seen.astype(np.float32), after_other.astype(np.float32)))
            shorter = {"runs": runs, "seen": seen, "nodes": nodes, "n": n, "d": d, "size": size, "escape": escape}

    def costs(self, suffixes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Bits of the last byte of each of the longest runs; suffixes has the distinct runs of each length and their places one shorter."""
        bits, known = np.zeros(1), np.zeros(1, bool)
        for (runs, cost, nodes, after_seen, after_other), (wanted, up) in zip(self.levels, suffixes):
            bits, known = bits[up], known[up]
            at, inside = _places(nodes, wanted >> 8)
            if inside.any():
                bits += np.where(inside, np.where(known, after_seen[at], after_other[at]), 0)
            at, known = _places(runs, wanted)
            if known.any():
                bits = np.where(known, cost[at], bits)
        return bits


class Model:
    """The trees of all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], min_seen: int = 1) -> None:
        """counts: runs of ORDER + 1 bytes and how often each occurs; contexts of ORDER bytes of fewer occurrences can be left out."""
        self.languages = sorted(counts)
        self.trees = [Tree(*counts[x], min_seen) for x in self.languages]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        data, firsts, ends = _joined(texts)
        for at in range(ORDER, len(data), CHUNK):  # the corpus begins with START, which is not scored
            block = data[at - ORDER : at + CHUNK].astype(np.uint32)
            n = len(block) - ORDER
            runs = np.zeros(n, np.uint32)
            for back in range(ORDER, -1, -1):
                runs = runs << 8 | block[ORDER - back : ORDER - back + n]
            low, high = np.searchsorted(ends, at, side="right"), np.searchsorted(firsts, at + n)
            a, b = np.maximum(firsts[low:high], at) - at, np.minimum(ends[low:high], at + n) - at
            some = np.flatnonzero(b > a)
            if not len(some):
                continue
            edges = np.stack([a[some], b[some]], axis=1).ravel()
            wanted, places = np.unique(runs, return_inverse=True)
            suffixes = []
            for order in range(ORDER, -1, -1):
                shorter, up = np.unique(wanted & np.uint32((1 << 8 * order) - 1), return_inverse=True)
                suffixes.append((wanted, up))
                wanted = shorter
            for column, tree in enumerate(self.trees):
                bits = np.append(tree.costs(suffixes[::-1])[places], 0.0)
                out[low + some, column] += np.add.reduceat(bits, edges)[::2]
        return out


def train(docs: DataFrame, train_rows, per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """docs: doc_id, text, lang; train_rows: the condition of rows to learn from."""
    sample = training_rows(docs, train_rows, per_language)
    texts = docs.select("doc_id", "text", "lang").join(F.broadcast(sample), "doc_id")  # as bounded as the sample

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                rows.setdefault(lang, []).append(text)
            for lang, found in rows.items():
                grams, n = gram_counts(found)
                yield pa.record_batch([pa.array([lang] * len(n)), pa.array(grams), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    grams = texts.filter(F.col("lang") == F.col("language")).select("lang", "text").mapInArrow(counted, "lang string, gram long, n long")
    table = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # as bounded as the sample
    if not table.num_rows:
        return None
    langs = table["lang"].combine_chunks().dictionary_encode()
    order = np.argsort(langs.indices.to_numpy(), kind="stable")
    gram, n = table["gram"].to_numpy()[order], table["n"].to_numpy()[order]
    edges = np.searchsorted(langs.indices.to_numpy()[order], np.arange(len(langs.dictionary) + 1))
    return Model({x: (gram[a:b], n[a:b]) for x, a, b in zip(langs.dictionary.to_pylist(), edges, edges[1:])})


def identify(docs: DataFrame, train_rows, keep: list[str] | None = None, **bounds) -> DataFrame:
    """The columns to keep (by default doc_id), lang_pred, score and bits_per_byte for every row of docs (doc_id, text, lang)."""
    model = train(docs, train_rows, **bounds)
    kept = docs.select(*[F.col(c) for c in keep or ["doc_id"]])
    added = T.StructType().add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]
            known = batch.column(1).to_numpy(zero_copy_only=False).astype(bool) & (model is not None)
            names, score, rate = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts)), np.zeros(len(texts))
            at = np.flatnonzero(known)
            if len(at):
                bits = model.code_lengths([texts[i] for i in at])
                names[at] = np.array(model.languages, object)[bits.argmin(axis=1)]
                score[at] = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                rate[at] = bits.min(axis=1) / [len(texts[i]) for i in at]
            columns = [*batch.columns[2:], pa.array(names, pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[2:], *added.names])

    rows = docs.select(F.col("text").alias("_text"), letters.alias("_letters"), *kept.columns)
    return rows.mapInArrow(predicted, T.StructType([*kept.schema.fields, *added.fields]))


def held_out() -> "F.Column":
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def predict(docs: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte; learns from the rows that are not held out."""
    out = identify(docs, F.coalesce(~held_out(), F.lit(False)), **bounds)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
