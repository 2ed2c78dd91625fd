"""Exact deduplication by a minimal perfect hash over historical digests.

Texts are reduced to their SHA-256.  The distinct digests of the history are
spread over buckets; each bucket holds a minimal perfect hash (levels of bit
sets: keys that meet alone in a level stay there, the others go on to the next
level; a key's rank among the set bits is its slot).  A slot holds the full
digest, the winner's id and the group's size.  Incoming rows are first summed
per digest on the map side, then looked up in their bucket: a slot whose 32
bytes agree makes the rows repeats of a historical group, every other digest
forms a group of its own.

Of equal texts the row with the largest id stays.  Null text counts as empty;
rows with a null id belong to their group but win only if the whole group has
no id (then ``keep_id`` is null and none is kept); rows that repeat an id share
its decision.  Columns other than the id and the text are not read.  A group
of any size costs one summed row per map task, and the join that brings the
decision back to the rows meets one row per digest, so Spark can split it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, text_of

DIGESTS_PER_BUCKET = 100_000
#: Room in a level's bit set, per key that reaches it.
ROOM = 2

INDEX = "bucket long, levels array<binary>, digests binary, winners binary, sizes binary"
GROUPS = "digest binary, keep_id long, group_size long"
NO_ID = np.iinfo(np.int64).min


def _cells(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Cell of each digest (rows of four 64-bit integers) in a level's bit set."""
    h = np.full(len(digests), level + 1, np.uint64)
    for j in range(4):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + digests[:, j])
    return h % np.uint64(size)


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """Bit sets of a minimal perfect hash over distinct digests."""
    levels, rest = [], digests
    while len(rest):
        size = ROOM * len(rest)
        cells = _cells(rest, len(levels), size)
        alone = np.bincount(cells.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        rest = rest[~alone[cells]]
    return levels


def slots_of(digests: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each digest; -1, or any slot, for digests that the hash was not built over."""
    slots = np.full(len(digests), -1, np.int64)
    open_ = np.arange(len(digests))
    before = 0
    for level, bits in enumerate(levels):
        cells = _cells(digests[open_], level, len(bits)).astype(np.int64)
        hit = bits[cells]
        slots[open_[hit]] = before + np.cumsum(bits)[cells[hit]] - 1
        before += int(bits.sum())
        open_ = open_[~hit]
    return slots


def _as_words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def _ids(column) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy().astype(np.int64)


def _build(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    words, ids, sizes = _as_words(table["digest"]), _ids(table["keep_id"]), table["group_size"].to_numpy()
    levels = build_levels(words)
    at = slots_of(words, levels)
    slots, winners, counts = np.empty_like(words), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    slots[at], winners[at], counts[at] = words, ids, sizes
    return pa.table({
        "bucket": table["bucket"].slice(0, 1),
        "levels": pa.array([[len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in levels]], pa.list_(pa.binary())),
        "digests": pa.array([slots.tobytes()], pa.binary()),
        "winners": pa.array([winners.tobytes()], pa.binary()),
        "sizes": pa.array([counts.tobytes()], pa.binary()),
    })


def _groups(words: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> pa.Table:
    data = words.tobytes()
    return pa.table({
        "digest": pa.array([data[i : i + 32] for i in range(0, len(data), 32)], pa.binary()),
        "keep_id": pa.array(ids, mask=ids == NO_ID),
        "group_size": pa.array(sizes.astype(np.int64)),
    })


def _look_up(rows: pa.Table, index: pa.Table) -> pa.Table:
    rows = rows.combine_chunks()
    words, ids, sizes = _as_words(rows["digest"]), _ids(rows["keep_id"]), rows["group_size"].to_numpy()
    if not index.num_rows:
        return _groups(words, ids, sizes)
    held = index.combine_chunks().to_pylist()[0]
    levels = [np.unpackbits(np.frombuffer(b[8:], np.uint8), count=int.from_bytes(b[:8], "little")).astype(bool) for b in held["levels"]]
    slots = np.frombuffer(held["digests"], np.uint64).reshape(-1, 4)
    winners, counts = np.frombuffer(held["winners"], np.int64).copy(), np.frombuffer(held["sizes"], np.int64).copy()
    at = slots_of(words, levels)
    member = (at >= 0) & (slots[at] == words).all(axis=1)
    hit = at[member]  # a digest comes once among the summed rows, so a slot is hit once
    winners[hit] = np.maximum(winners[hit], ids[member])
    counts[hit] += sizes[member]
    new = ~member
    return _groups(np.concatenate([slots, words[new]]), np.concatenate([winners, ids[new]]), np.concatenate([counts, sizes[new]]))


def summed(digests: DataFrame, buckets: int) -> DataFrame:
    """One row per digest: bucket, digest, largest id, number of rows."""
    return (
        digests.groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest", "keep_id", "group_size")
    )


def build_index(digests: DataFrame, buckets: int) -> DataFrame:
    """digests: doc_id, digest.  One row per bucket: the levels' bit sets and the slots."""
    return summed(digests, buckets).groupBy("bucket").applyInArrow(_build, INDEX)


def merge_groups(digests: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Groups of the index after the rows of digests have joined them, and the new groups."""
    rows = summed(digests, buckets)
    return rows.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_look_up, GROUPS)


def digests_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("digest"))


def exact_dedup(docs: DataFrame, historical: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    historical marks the rows (by the columns doc_id and digest) over whose digests the perfect hash is
    built; by default those below the middle of the id range, so that the older half is
    the history of the newer one.  The choice has no effect on the result."""
    digests = cut(digests_of(docs, id_col, text_col))
    rows, low, high = digests.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    if historical is None:
        historical = F.col("doc_id") < F.lit(((low or 0) + (high or 0)) // 2)
    buckets = max(1, math.ceil(rows / DIGESTS_PER_BUCKET))
    old = F.coalesce(historical, F.lit(False))
    index = build_index(digests.filter(old), buckets)
    groups = merge_groups(digests.filter(~old), index, buckets)
    return digests.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
