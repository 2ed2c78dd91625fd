"""Substring deduplication by level-wise doubling.

A window of words can repeat only if its two halves do.  So windows of a
quarter of the length are compared first, over the whole corpus; where both
halves of a window of twice the length repeat, that window is a candidate of
the next level, and so on up to the full length (a last step that is not a
doubling takes two overlapping parts).  Most windows end at the first level, a
corpus without repeats has no candidates after it.

Words are ASCII white-space separated, unchanged; windows stay inside a document.  Levels
below the full one compare shortened hashes, which can only let a window pass
to the next level; the full windows are compared by 128 bits: two chains
of hashes, each from word hashes of its own seed.  Of equal windows the first stays (smaller id, then earlier start); every word
that a later one covers is removed.  Windows are judged on the input.

Null and empty texts have no words and keep none.  Null ids stand before all others; rows of one id and one text count in
their order, so a repeated row is removed but for the first; rows of one id and different texts stand in the order of their texts within a block and of their blocks otherwise.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import from_planes, mix
from .exchange import BLOCK_BYTES, Blocks, answer, flags_of, flags_to_bytes, ids_array, repeated_in_others, union, word_hashes

WINDOW = 20
#: Levels before the full one.
HALVINGS = 2

ROWS = "doc_id long, n_words long, n_removed long, kept_sha256 string"
COLUMNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def level_lengths(window: int, halvings: int = HALVINGS) -> list[int]:
    lengths = [max(1, -(-window // 2**halvings))]
    while lengths[-1] < window:
        lengths.append(min(2 * lengths[-1], window))
    return lengths


def _joined(first: np.ndarray, second: np.ndarray, salt: int) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second + np.uint64(salt))


def _short_windows(words: np.ndarray, length: int, salt: int) -> np.ndarray:
    out = mix(words + np.uint64(salt))
    for j in range(1, length):
        out = _joined(out[: len(out) - 1], words[j:], salt) if len(out) > 1 else out[:0]
    return np.concatenate([out, np.zeros(len(words) - len(out), np.uint64)])


class Windows:
    """All windows of a block, level by level."""

    def __init__(self, texts: list[bytes], window: int, keep_bits: int) -> None:
        self.lengths = level_lengths(window)
        self.texts = texts
        self.words, self.counts = word_hashes(texts)
        self.ends = np.cumsum(self.counts)
        n = len(self.words)
        self.room = np.repeat(self.ends, self.counts) - np.arange(n)  # words from here to the document's end
        self.mask = np.uint64((1 << 64) - (1 << (64 - keep_bits)))
        long_enough = np.repeat(self.counts >= window, self.counts)
        self.level = 0
        self.hashes = _short_windows(self.words, self.lengths[0], 1)
        self.candidates = np.flatnonzero(long_enough & (self.room >= self.lengths[0]))

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys of the candidates, each candidate's key, how often each key occurs."""
        full = self.level == len(self.lengths) - 1
        found = self.hashes[self.candidates]
        return np.unique(found if full else found & self.mask, return_inverse=True, return_counts=True)

    def double(self, elsewhere: np.ndarray) -> None:
        """On to the next level: elsewhere says of each key whether another block has it."""
        _, which, times = self.keys()
        repeats = np.zeros(len(self.words) + 1, bool)
        repeats[self.candidates[(elsewhere | (times > 1))[which]]] = True
        length, longer = self.lengths[self.level : self.level + 2]
        step = longer - length
        at = np.flatnonzero(repeats[:-1] & (self.room >= longer))
        self.candidates = at[repeats[at + step]]
        self.hashes = self._doubled(self.hashes, step, 1)
        self.level += 1

    def _doubled(self, hashes: np.ndarray, step: int, salt: int) -> np.ndarray:
        out = np.zeros_like(hashes)
        n = max(0, len(hashes) - step)
        out[:n] = _joined(hashes[:n], hashes[len(hashes) - n :], salt)
        return out

    def second_hashes(self) -> np.ndarray:
        """Another hash of the full windows, from hashes of the words with another seed."""
        out = _short_windows(word_hashes(self.texts, 1)[0], self.lengths[0], 2)
        for length, longer in zip(self.lengths, self.lengths[1:]):
            out = self._doubled(out, longer - length, 2)
        return out

    def first_of_keys(self, which: np.ndarray, n: int) -> np.ndarray:
        """Place among the candidates of each key's first candidate."""
        first = np.full(n, len(which))
        np.minimum.at(first, which, np.arange(len(which)))
        return first


def _reach(texts: list[bytes], told: dict[int, list[bytes]], window: int, bits: int, level: int) -> Windows:
    windows = Windows(texts, window, bits)
    for done in range(level):
        windows.double(flags_of(told.get(done, [])))
    return windows


def _owners(keys: list[np.ndarray], extras: list[bytes]) -> list[bytes]:
    """For each message, which of its keys have their first window in that block."""
    parts = [(from_planes(e[: 8 * len(k)], np.uint64), from_planes(e[8 * len(k) :], np.int64)) for k, e in zip(keys, extras)]
    key = np.concatenate(keys)
    check, first_id = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((first_id, check, key))  # stable: ties stay in the order of the blocks
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    owner = np.zeros(len(order), bool)
    owner[order[new]] = True
    return [flags_to_bytes(x) for x in np.split(owner, np.cumsum([len(k) for k in keys])[:-1])]


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by a space) for every row of docs."""
    blocks = Blocks(docs, id_col, text_col, block_bytes)
    keys = blocks.bytes / 4  # more than the words of any text of usual language
    bits, keep = blocks.bucket_bits(keys), blocks.filter_bits(keys)
    last = len(level_lengths(window)) - 1

    def at_level(level: int):
        def question(ids, texts, told):
            windows = _reach(texts, told, window, keep, level)
            found, which, _ = windows.keys()
            if level < last:
                return [(level, found, [])]
            first = windows.candidates[windows.first_of_keys(which, len(found))]
            document = np.searchsorted(windows.ends, first, side="right")
            return [(level, found, [windows.second_hashes()[first], ids[document]])]

        return question

    def merge(kind, keys_, extras):
        return _owners(keys_, extras) if kind == last else [flags_to_bytes(x) for x in repeated_in_others(keys_)]

    answers: list[DataFrame] = []
    for level in range(last + 1):
        answers.append(answer(blocks.ask(bits, at_level(level), union(*answers) if answers else None), merge))

    def result(ids, texts, told):
        windows = _reach(texts, told, window, keep, last)
        found, which, _ = windows.keys()
        firsts = np.zeros(len(which), bool)
        firsts[windows.first_of_keys(which, len(found))] = True
        later = windows.candidates[~(firsts & flags_of(told.get(last, []))[which])] if len(which) else which
        cover = np.zeros(len(windows.words) + 1, np.int64)
        np.add.at(cover, later, 1)
        np.add.at(cover, later + window, -1)
        kept = np.cumsum(cover)[:-1] == 0
        removed, digests = [], []
        for text, n, end in zip(texts, windows.counts.tolist(), windows.ends.tolist()):
            own = kept[end - n : end]
            words = text.split()
            gone = n - int(own.sum())
            removed.append(gone)
            digests.append(hashlib.sha256(b" ".join(compress(words, own.tolist()) if gone else words)).hexdigest())
        return [ids_array(ids), windows.counts, removed, digests]

    return blocks.tell(result, union(*answers), ROWS, COLUMNS)




ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), k AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM k
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS i FROM f WHERE later
), p AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM p ANTI JOIN g USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
