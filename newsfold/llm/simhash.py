"""SimHash near-deduplication with pigeonring filtering.

A fingerprint has a bit for every position that is set in over half of the
XXH64 values of a text's word shingles.  Only distinct fingerprints are
compared.  For links of at most d differing bits the 64 bits form a ring of
d + 1 segments; two linked fingerprints have a segment i from which every
chain of l consecutive segments differs in at most l * d / (d + 1) bits, that
is l - 1.  So segment i agrees, and of the two halves of segment i + 1 at
least one does: with d = 3 each fingerprint stands under eight keys of 24
bits.  Pairs under a key must pass the chains before their full distance is
looked at.

A key with more than GROUP fingerprints is not compared in one task: of the
bits outside the key, cut into d + 1 blocks, at least one block agrees in
every link, so the key's rows go on under d + 1 longer keys.  Keys grow until a
group is small; with all but 10 bits in the key no group is larger than GROUP.
Inside a group the links are reduced to one row per linked fingerprint and
pass, so no group emits all its pairs.  Components are joined over these rows.

Null and empty texts have no words and the fingerprint zero; a text of fewer
words than a shingle is one shingle.  Rows with a null id join the component of
their text but never name it; rows that repeat an id share its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import looked_up
from .common import cut, shuffle_partitions
from .graph import component_roots

SHINGLE = 3
DISTANCE = 3
GROUP = 1024
#: Fingerprints per distance matrix when groups of equal size are compared together.
CELLS = 1 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 100_000):
        block = range(at, min(n, at + 100_000))
        hashes = np.array([xxh64_intdigest(joined[starts[i] : ends[i + last]], 42) for i in block], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp: the fingerprint's 64 bits as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(hashed, "doc_id long, fp long")


def ring(distance: int) -> list[list[int]]:
    """For each segment, the masks of the chains of 1, 2, ... segments from it."""
    segments = [sum(1 << int(b) for b in bits) for bits in np.array_split(np.arange(64), distance + 1)]
    n = len(segments)
    return [[sum(segments[(i + j) % n] for j in range(length)) for length in range(1, n + 1)] for i in range(n)]


def first_masks(distance: int) -> list[tuple[int, int]]:
    """The first keys: (segment i, bits of segment i and of one half of the next)."""
    if distance == 0:
        return [(0, (1 << 64) - 1)]
    out = []
    for i, chains in enumerate(ring(distance)):
        following = [b for b in range(64) if (chains[1] & ~chains[0]) >> b & 1]
        out += [(i, chains[0] | sum(1 << int(b) for b in half)) for half in np.array_split(following, 2)]
    return out


def longer_masks(mask: int, distance: int) -> list[int]:
    """The mask with each of distance + 1 blocks of the bits outside it."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in block) for block in np.array_split(free, distance + 1)]


def _linked(x: np.ndarray, segment: np.ndarray, distance: int) -> np.ndarray:
    """Whether differences x pass the chains from the segment; the longest is the full distance."""
    chains = np.array(ring(distance), np.uint64)
    ok = np.ones(np.broadcast_shapes(x.shape, segment.shape), bool)
    for length in range(1, distance + 2):
        ok &= np.bitwise_count(x & chains[segment, length - 1]) < length
    return ok


def _links(segments: np.ndarray, fps: np.ndarray, starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """fps stand in groups that begin at starts (the last start is the end).
    Returns pairs that connect, within each group, what its links connect."""
    out_a, out_b = [], []
    lengths = np.diff(starts)
    for g in np.unique(lengths[lengths > 1]).tolist():
        at = starts[:-1][lengths == g]
        step = max(1, CELLS // (g * g))
        for i in range(0, len(at), step):
            rows = at[i : i + step, None] + np.arange(g)
            f = fps[rows]
            near = _linked(f[:, :, None] ^ f[:, None, :], segments[rows[:, :1]][:, :, None], distance)
            some = near.sum(axis=(1, 2)) > g
            if not some.any():
                continue
            rows, f, near = rows[some], f[some], near[some]
            label = np.broadcast_to(np.arange(g), f.shape).copy()
            while True:
                lower = np.where(near, label[:, None, :], g).min(axis=2)
                if (lower == label).all():
                    break
                label = lower
            k, j = np.nonzero(label != np.arange(g))
            out_a.append(f[k, j])
            out_b.append(f[k, label[k, j]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _compare(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows segment, mask, value, fp, sorted by the first three; groups may run over batches."""
    held: list[np.ndarray] = []

    def compared(rows: list[np.ndarray]) -> pa.RecordBatch:
        segments, masks, values, fps = rows
        changes = np.flatnonzero((masks[1:] != masks[:-1]) | (values[1:] != values[:-1])) + 1
        a, b = _links(segments, fps.view(np.uint64), np.concatenate([[0], changes, [len(fps)]]), distance)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        rows = [c.to_numpy() for c in batch.columns]
        if not len(rows[0]):
            continue
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        _, masks, values, _ = rows
        last = np.flatnonzero((masks != masks[-1]) | (values != values[-1]))
        end = int(last[-1]) + 1 if len(last) else 0
        if end:
            yield compared([x[:end] for x in rows])
        held = [x[end:] for x in rows]
    if held:
        yield compared(held)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """fps: distinct fingerprints fp.  Pairs a, b whose components are those of all links."""
    spark = fps.sparkSession
    level = first_masks(distance)
    keys = F.array(*[F.struct(F.lit(i).alias("segment"), F.lit(_signed(m)).alias("mask")) for i, m in level])
    rows = fps.select("fp", F.explode(keys).alias("key")).select(F.col("key.segment").cast("long").alias("segment"), "key.mask", F.col("fp").bitwiseAND(F.col("key.mask")).alias("value"), "fp")
    masks = {m for _, m in level}
    found = None
    while True:
        sizes = rows.groupBy("segment", "mask", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = cut(rows.join(sizes, ["segment", "mask", "value"]))
        columns = ["segment", "mask", "value", "fp"]
        small = sized.filter(F.col("n") <= group).select(*columns)
        placed = small.repartition(shuffle_partitions(fps), "segment", "mask", "value").sortWithinPartitions("segment", "mask", "value")
        pairs = placed.mapInArrow(lambda batches: _compare(batches, distance), "a long, b long").distinct()
        found = pairs if found is None else found.union(pairs)
        large = sized.filter(F.col("n") > group).select(*columns)
        if large.isEmpty():
            return found
        deeper = {m: longer_masks(m, distance) for m in masks}
        table = spark.createDataFrame([(_signed(m), _signed(x)) for m, xs in deeper.items() for x in xs], "mask long, longer long")
        rows = large.join(F.broadcast(table), "mask").select(  # distance + 1 rows for each mask of the level
            "segment", F.col("longer").alias("mask"), F.col("fp").bitwiseAND(F.col("longer")).alias("value"), "fp"
        )
        masks = {x for xs in deeper.values() for x in xs}


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id, kept for every row; the component's smallest id is kept."""
    prints = cut(fingerprints(docs, shingle, id_col, text_col))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = component_roots(links(distinct.select("fp"), distance))
    rooted = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = looked_up(rooted, named, ["root"], rooted.count()).select("fp", "component_id")
    return looked_up(prints, component, ["fp"], prints.count()).select(  # fingerprints and roots of many rows are not shuffled
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
