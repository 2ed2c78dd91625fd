"""Suffix-array deduplication by a depth-limited radix sort.

Suffixes of all texts' bytes are ordered only through THRESHOLD bytes, most
significant digits first; after the last pass the groups of equal suffixes are exactly the
repeated windows.  Only equality is needed of the order, so a digit (a run of
bytes) is told from others by a 64-bit polynomial hash over a random byte table, and a
pass keeps the suffixes whose group has more than one member.

The first digit is long: of the ANCHORS suffixes from a byte on, the one whose
next 8 bytes hash lowest is the anchor, and the digit is what any window that starts
there holds from its anchor on.  Equal windows have equal anchors at equal
places, so a suffix can only be in a group if its anchor's digit is, and one
key per anchor stands for up to ANCHORS suffixes.  Before it, anchors are grouped by a longer run
of bytes: where that repeats, all windows of the suffixes from the anchor to the next are known to repeat,
and if all members of a group of the first digit are known, the last pass skips it.
The last pass takes the remaining suffixes, all members of the groups that are open, through the full threshold.

Every byte covered by a repeated window, the first copy included, is removed; copies may overlap and may lie in
one document, never across documents.  Null and empty texts have no bytes; rows that repeat a text are copies of each other,
whatever their ids.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import mix
from .exchange import BLOCK_BYTES, Blocks, answer, chunks, flags_of, flags_to_bytes, ids_array, repeated_in_others, union

THRESHOLD = 400
ANCHORS = 64
GRAM = 8
SEED = 20240215

ROWS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

KNOWN, DIGIT, FULL = 0, 1, 2
#: Answers to a first digit: alone, in a group with unknown members, in a group whose members are all known.
ALONE, OPEN, DONE = 0, 1, 2


class Powers:
    """Powers of the polynomial's base and of its inverse, modulo 2^64, as far as they were needed."""

    BASE = 0x5851F42D4C957F2D

    def __init__(self) -> None:
        self.table = np.random.default_rng(SEED).integers(0, 1 << 64, 256, np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.BASE, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.BASE, -size, 1 << 64))])

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.reach(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[first]) * self.down[first] + (end - first).astype(np.uint64))


@dataclass
class Chunk:
    """Some documents of a block one after the other."""

    data: np.ndarray  # their bytes
    ends: np.ndarray  # end of each document
    starts: np.ndarray  # suffixes that a window starts at, ascending
    runs: np.ndarray  # index in starts at which each run of suffixes with one anchor begins
    anchors: np.ndarray  # anchor of each run
    heads: np.ndarray  # places at which the longer runs of bytes start: anchors and documents' first bytes
    head_ends: np.ndarray


def _chunk(texts: list[bytes], threshold: int) -> Chunk:
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    raw = b"".join(texts)
    data = np.frombuffer(raw, np.uint8)
    document_end = np.repeat(ends, lengths)
    starts = np.flatnonzero(document_end - np.arange(len(data)) >= threshold)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Chunk(data, ends, starts, none, none, none, none)
    grams = np.ndarray(len(raw) - GRAM + 1, "<u8", raw, strides=(1,))
    lowest = grams * np.uint64(0x9E3779B97F4A7C15) & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < ANCHORS:  # the lowest of the next 2, 4, ... grams
        step = min(width, ANCHORS - width)
        lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
        width += step
    anchor = (lowest[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(starts) != 1)
    runs = np.flatnonzero(new)
    anchors = anchor[runs]
    firsts = (ends - lengths)[lengths >= threshold]
    heads = np.unique(np.concatenate([anchors, firsts]))
    return Chunk(data, ends, starts.astype(np.int32 if len(data) < 1 << 31 else np.int64), runs, anchors, heads, np.minimum(heads + threshold + ANCHORS - 1, document_end[heads]))


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_inverse=True, return_counts=True)


class Passes:
    """The passes over one block's texts, as far as the answers go."""

    def __init__(self, texts: list[bytes], told: dict[int, list[bytes]], threshold: int, keep_bits: int) -> None:
        self.threshold = threshold
        self.digit = threshold - ANCHORS + 1
        self.powers = Powers()
        self.told = told
        mask = np.uint64((1 << 64) - (1 << (64 - keep_bits)))
        self.chunks = [_chunk(texts[a:b], threshold) for a, b in chunks(texts)]
        self.held, known, digits = [], [], []
        for chunk in self.chunks:
            sums = self.powers.sums(chunk.data)
            known.append(self.powers.hashes(sums, chunk.heads, chunk.head_ends))
            digits.append(self.powers.hashes(sums, chunk.anchors, chunk.anchors + self.digit) & mask)
            self.held.append((len(chunk.heads), len(chunk.anchors)))
        self.known = _distinct(known)
        self.digits = _distinct(digits)

    def _per_chunk(self, values: np.ndarray, which: int) -> list[np.ndarray]:
        return np.split(values, np.cumsum([h[which] for h in self.held])[:-1])

    def known_starts(self) -> list[np.ndarray]:
        """Per chunk, which starts are known to repeat."""
        keys, key_of, times = self.known
        repeats = (flags_of(self.told.get(KNOWN, [])) | (times > 1))[key_of]
        out = []
        for chunk, own in zip(self.chunks, self._per_chunk(repeats, 0)):
            cover = np.zeros(len(chunk.data) + ANCHORS + 1, np.int64)
            np.add.at(cover, chunk.heads[own], 1)
            np.add.at(cover, chunk.heads[own] + ANCHORS, -1)
            out.append(np.cumsum(cover)[chunk.starts] > 0)
        return out

    def digit_states(self, known: list[np.ndarray]) -> np.ndarray:
        """Of each distinct digit, whether all its runs here are known, and whether it occurs more than once."""
        all_known = [np.minimum.reduceat(k, c.runs) if len(c.runs) else np.zeros(0, bool) for c, k in zip(self.chunks, known)]
        keys, key_of, times = self.digits
        out = np.ones(len(keys), bool)
        np.logical_and.at(out, key_of, np.concatenate([np.zeros(0, bool), *all_known]))
        return out

    def open_starts(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per chunk, the starts that the last pass takes and their keys."""
        keys, key_of, _ = self.digits
        states = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(a, np.uint8) for a in self.told.get(DIGIT, [])]])
        open_runs = (states == OPEN)[key_of]
        starts, found = [], []
        for chunk, own in zip(self.chunks, self._per_chunk(open_runs, 1)):
            lengths = np.diff(np.append(chunk.runs, len(chunk.starts)))
            at = chunk.starts[np.repeat(own, lengths)].astype(np.int64)
            starts.append(at)
            found.append(self.powers.hashes(self.powers.sums(chunk.data), at, at + self.threshold) if len(at) else np.zeros(0, np.uint64))
        return starts, found


def _digit_groups(keys: list[np.ndarray], extras: list[bytes]) -> list[bytes]:
    """State of each digit of each message; bit 0 of an extra: all known there, bit 1: more than one run there."""
    every, bits = np.concatenate(keys), np.frombuffer(b"".join(extras), np.uint8)
    found, which, blocks = np.unique(every, return_inverse=True, return_counts=True)
    unknown = np.bincount(which, (bits & 1) == 0, len(found)) > 0
    many = (np.bincount(which, (bits & 2) > 0, len(found)) > 0) | (blocks > 1)
    state = np.where(~many, ALONE, np.where(unknown, OPEN, DONE)).astype(np.uint8)[which]
    return [x.tobytes() for x in np.split(state, np.cumsum([len(k) for k in keys])[:-1])]


def dedup(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs; threshold is at least ANCHORS + GRAM."""
    if threshold < ANCHORS + GRAM:
        raise ValueError(f"threshold must be at least {ANCHORS + GRAM}")
    blocks = Blocks(docs, id_col, text_col, block_bytes)
    anchors = blocks.bytes * 2 / ANCHORS
    bits, keep = blocks.bucket_bits(anchors), blocks.filter_bits(anchors)

    def ask_known(ids, texts, told):
        return [(KNOWN, Passes(texts, told, threshold, keep).known[0], [])]

    def ask_digits(ids, texts, told):
        passes = Passes(texts, told, threshold, keep)
        keys, _, times = passes.digits
        state = passes.digit_states(passes.known_starts()).astype(np.uint8) | (times > 1).astype(np.uint8) << 1
        return [(DIGIT, keys, [state])]

    def ask_full(ids, texts, told):
        return [(FULL, _distinct(Passes(texts, told, threshold, keep).open_starts()[1])[0], [])]

    def merge(kind, keys, extras):
        return _digit_groups(keys, extras) if kind == DIGIT else [flags_to_bytes(x) for x in repeated_in_others(keys)]

    known = answer(blocks.ask(bits, ask_known), merge)
    digits = answer(blocks.ask(bits, ask_digits, known), merge)
    full = answer(blocks.ask(blocks.bucket_bits(blocks.bytes / 4), ask_full, union(digits)), merge)

    def result(ids, texts, told):
        passes = Passes(texts, told, threshold, keep)
        starts, keys = passes.open_starts()
        found, key_of, times = _distinct(keys)
        repeats = (flags_of(told.get(FULL, [])) | (times > 1))[key_of]
        own = np.split(repeats, np.cumsum([len(k) for k in keys])[:-1])
        sizes, removed, spans, digests = [], [], [], []
        for chunk, at, hit, sure in zip(passes.chunks, starts, own, passes.known_starts()):
            cover = np.zeros(len(chunk.data) + 1, np.int64)
            gone_from = np.concatenate([at[hit], chunk.starts[sure]])
            np.add.at(cover, gone_from, 1)
            np.add.at(cover, gone_from + threshold, -1)
            gone = np.cumsum(cover)[:-1] > 0
            first = 0
            for end in chunk.ends.tolist():
                mine, data = gone[first:end], chunk.data[first:end]
                sizes.append(len(data))
                removed.append(int(mine.sum()))
                spans.append(int(np.count_nonzero(mine[1:] & ~mine[:-1]) + mine[:1].sum()))
                digests.append(hashlib.sha256(data[~mine].tobytes() if removed[-1] else data.tobytes()).hexdigest())
                first = end
        return [ids_array(ids), sizes, removed, spans, digests]

    return blocks.tell(result, union(known, digits, full), ROWS, COLUMNS)


#: Texts as hexadecimal digits, two for each byte.
ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), k AS (
  SELECT doc_id, p, md5(substring(h, 2 * p + 1, {2 * THRESHOLD})) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {THRESHOLD - 1})) AS p FROM d WHERE length(h) >= {2 * THRESHOLD})
), c AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM k) WHERE n > 1
), o AS (
  SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {THRESHOLD}, TRUE)::INT AS opens FROM c
), g AS (
  SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o
), r AS (
  SELECT doc_id, run, min(p) AS a, max(p) + {THRESHOLD} AS b FROM g GROUP BY doc_id, run
), t AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS rest FROM r GROUP BY doc_id
), x AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS past FROM r
), y AS (
  SELECT x.doc_id, string_agg(substring(h, 2 * past + 1, 2 * (a - past)), '' ORDER BY a) AS head FROM x JOIN d USING (doc_id) GROUP BY x.doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed, coalesce(t.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(y.head, '') || substring(h, 2 * coalesce(t.rest, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN y USING (doc_id)
"""
