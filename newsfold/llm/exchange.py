"""Questions of text blocks, answered by buckets of keys.

Operators that compare every word or byte window of a corpus with every other
one would shuffle a row per window.  Here the documents are dealt into
blocks of bounded size, once, as compressed bundles; a block asks about its sorted distinct 64-bit keys with one
message per bucket (a range of keys), a bucket merges the messages of all
blocks, and its answers go back in the order of the keys.  A key that fills a
third of the corpus costs one entry per block.  Keys travel as differences in
compressed byte planes, which take about five bytes a key.

Blocks and buckets grow in number, not in size, with the corpus.  All rounds of an operator
form one plan over one shuffle of the texts, which Spark reuses for each round
and recomputes where an executor is lost.  Rows are dealt by id and text together, so an id that repeats, or is null, in many rows does not gather them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import corpus_bytes, pack_sorted, planes, shuffle_partitions, text_of, unpack_sorted

BLOCK_BYTES = 8 << 20
KEYS_PER_BUCKET = 2 << 20
#: Words are hashed, and bytes looked at, so many documents' bytes at a time.
CHUNK_BYTES = 1 << 20
#: Spare bits of keys that only filter: a share of 2^-SPARE of the other keys passes by chance.
SPARE = 12
NO_ID = np.iinfo(np.int64).min

MESSAGES = "kind int, bucket long, block long, keys binary, extra binary"
ANSWERS = "kind int, bucket long, block long, answer binary"


class Blocks:
    """The documents of a corpus in blocks: columns block, data (a bundle of documents)."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> None:
        self.bytes = corpus_bytes(docs, text_col)
        n = max(1, math.ceil(self.bytes / block_bytes))
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("string").alias("text"))
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block")
        bundles = rows.select(block, "doc_id", "text").mapInArrow(_bundled, "block long, data binary")
        # not below the session's partitions, else Spark would deal the texts again to meet its own number
        self.rows = bundles.repartition(max(n, shuffle_partitions(docs)), "block")

    def bucket_bits(self, keys: float) -> int:
        return max(0, math.ceil(math.log2(max(1.0, keys / KEYS_PER_BUCKET))))

    def filter_bits(self, keys: float) -> int:
        return min(64, math.ceil(math.log2(max(2.0, keys))) + SPARE)

    def ask(self, bits: int, question: Callable, answers: DataFrame | None = None) -> DataFrame:
        """Messages of all blocks.  question(texts of the block, answers so far) gives (kind, sorted
        distinct keys, arrays that go with the keys) for each kind."""

        def asked(key, rows: pa.Table, told: pa.Table | None = None) -> pa.Table:
            out: list[dict] = []
            block = key[0].as_py()
            if rows.num_rows:
                for kind, keys, arrays in question(*texts_of(rows), answers_of(told)):
                    edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
                    edges = [0, *edges, len(keys)]
                    for bucket, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                        if a < b:
                            out.append({"kind": kind, "bucket": bucket, "block": block, "keys": pack_sorted(keys[a:b]), "extra": b"".join(planes(x[a:b]) for x in arrays)})
            return pa.Table.from_pylist(out, pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())]))

        return self._run(asked, answers, MESSAGES)

    def tell(self, result: Callable, answers: DataFrame, schema: str, kinds: pa.Schema) -> DataFrame:
        """Rows of result(texts of the block, all answers): a list of columns."""

        def told(key, rows: pa.Table, answers_: pa.Table) -> pa.Table:
            columns = result(*texts_of(rows), answers_of(answers_)) if rows.num_rows else [[] for _ in kinds]
            return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.types)], schema=kinds)

        return self._run(told, answers, schema)

    def _run(self, work: Callable, answers: DataFrame | None, schema: str) -> DataFrame:
        rows = self.rows.groupBy("block")
        if answers is None:
            return rows.applyInArrow(lambda key, table: work(key, table), schema)
        return rows.cogroup(answers.groupBy("block")).applyInArrow(lambda key, table, told: work(key, table, told), schema)


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows block, doc_id, text; the documents of a batch that go to one block become one compressed bundle."""
    for batch in batches:
        blocks, ids = batch.column(0).to_numpy(), batch.column(1).fill_null(NO_ID).to_numpy()
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        order = np.argsort(blocks, kind="stable")
        edges = np.flatnonzero(np.diff(blocks[order], prepend=-1, append=-1))
        data = []
        for a, b in zip(edges[:-1], edges[1:]):
            own = order[a:b]
            held = [texts[i] for i in own.tolist()]
            head = np.concatenate([[len(own)], ids[own], [len(t) for t in held]]).astype(np.int64)
            data.append(zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(held)))
        yield pa.record_batch([pa.array(blocks[order[edges[:-1]]]), pa.array(data, pa.binary())], ["block", "data"])


def texts_of(rows: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids (NO_ID for null) and UTF-8 texts of a block's bundles, in the order of id and text."""
    found: list[tuple[int, bytes]] = []
    for bundle in rows["data"]:
        data = zstandard.ZstdDecompressor().decompress(bundle.as_buffer())
        n = int(np.frombuffer(data, np.int64, 1)[0])
        ids, lengths = np.frombuffer(data, np.int64, 2 * n, 8).reshape(2, n)
        at = 8 + 16 * n
        for doc_id, length in zip(ids.tolist(), lengths.tolist()):
            found.append((doc_id, data[at : at + length]))
            at += length
    found.sort()
    return np.array([doc_id for doc_id, _ in found], np.int64), [text for _, text in found]


def ids_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def answers_of(told: pa.Table | None) -> dict[int, list[bytes]]:
    """Per kind, the answers in the order of the buckets."""
    out: dict[int, list[bytes]] = {}
    if told is not None and told.num_rows:
        for row in told.sort_by([("kind", "ascending"), ("bucket", "ascending")]).to_pylist():
            out.setdefault(row["kind"], []).append(row["answer"])
    return out


def answer(messages: DataFrame, merge: Callable) -> DataFrame:
    """merge(kind, keys of each message, extra of each message) gives the answer to each message."""

    def merged(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        held = rows.to_pylist()
        told = merge(held[0]["kind"], [unpack_sorted(r["keys"]) for r in held], [r["extra"] for r in held])
        return rows.select(["kind", "bucket", "block"]).append_column("answer", pa.array(told, pa.binary()))

    return messages.groupBy("kind", "bucket").applyInArrow(merged, ANSWERS)


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def flags_to_bytes(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def flags_of(answers: list[bytes]) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(a, np.uint8, offset=8), count=int.from_bytes(a[:8], "little")) for a in answers]
    return np.concatenate([np.zeros(0, np.uint8), *parts]).astype(bool)


def repeated_in_others(keys: list[np.ndarray]) -> list[np.ndarray]:
    """For each message, which of its keys stand in another message too."""
    every = np.sort(np.concatenate(keys))
    twice = every[1:][every[1:] == every[:-1]]
    if not len(twice):
        return [np.zeros(len(k), bool) for k in keys]
    return [twice[np.minimum(np.searchsorted(twice, k), len(twice) - 1)] == k for k in keys]


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about so many bytes each."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def word_hashes(texts: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """XXH3 of all words of all texts, and the number of words of each text."""
    from itertools import repeat

    from xxhash import xxh3_64_intdigest

    parts, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for a, b in chunks(texts):
        for i in range(a, b):
            words = texts[i].split()
            counts[i] = len(words)
            parts.append(np.fromiter(map(xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words)))
    return np.concatenate(parts), counts
