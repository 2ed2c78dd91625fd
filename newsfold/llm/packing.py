"""Best-fit packing of documents into token sequences by exact-complement hashing.

Documents are tokenized in one pass (Arrow batches) and cut into pieces; from
there on only the pieces' lengths matter.  A histogram of the lengths, at most
one row per length, is all that the driver sees.  On it the plan is made:
lengths that fill a gap exactly are looked up among single lengths, then the
sums of two, then of three lengths, as many as the available pieces allow
(each step uses up or halves a length, so the steps are bounded by the lengths times
the logarithm of the largest count); what is left goes best-fit by decreasing length into the smallest gap
that holds it.  The plan is a list of runs "pieces number a to b of this length go to sequences s, s+1, ... at this offset".

Pieces are numbered within their length in two levels (counts per length and hash slice, then
rows inside a slice), so a length that most pieces share is not gathered in one task.

Null text counts as empty: one piece that holds the end id alone.  Rows that repeat an id
are packed as documents of their own.  Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SEQUENCE = 1024
END_ID = 2
PIECES_PER_SLICE = 20_000
#: Ways of taking sums of two or three, from the longest length down.  A sum takes a share of what is available, at least one.  Of lengths
#: below a floor (of a sequence's length) a share of the pieces is held back, with which the best-fit step closes the gaps of lengths
#: that have no exact complement.  The longest length in a sum is at least so much of the longest left after single complements.
#: What serves best depends on the lengths, so the plan is made in each way and the shortest is taken.
WAYS = ((0.5, 0.0, 0.0, 0.0), (0.1, 0.15, 0.9, 0.0), (0.5, 0.0, 0.0, 0.85), (0.5, 0.15, 0.9, 0.8), (0.5, 0.0, 0.0, 0.9))
VOCABULARY = "byte_bpe_50k"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"

#: Scripts whose letters and spaces are the same for every version of Unicode; texts with other characters, or with the
#: string of a special token, take the tokenizers library itself, whose own split then decides.
_PLAIN = r"[\x00-ɏ‐-‧‰-⁞€]*"


def make_encoder(vocabulary: str, folder: str | None):
    """Text to token ids, as the vocabulary's tokenizer gives them without added special tokens.

    The rank file of the same vocabulary gives the same ids several times faster; it is used for
    plain texts."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    place = public_tokenizers.path if folder is None else lambda name: f"{folder}/{name}"
    with open(place(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = regex.compile(_PLAIN)
    special = regex.compile(r"<\|")
    slow: list = []

    def encode(text: str) -> list[int]:
        if plain.fullmatch(text) and not special.search(text):
            return fast.encode_ordinary(text)
        if not slow:
            slow.append(Tokenizer.from_file(place(f"{vocabulary}.json")))
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def cut_lengths(n: int, sequence: int) -> list[int]:
    """Piece lengths of a document of n ids; only the first may be shorter than a sequence."""
    first = n % sequence
    return ([first] if first else []) + [sequence] * (n // sequence)


def pieces(docs: DataFrame, sequence: int, end_id: int, vocabulary: str, folder: str | None, id_col: str, text_col: str) -> DataFrame:
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder(vocabulary, folder)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), sequence)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(out, (doc_id, piece, start, length, crc)):
                        column.append(value)
                    start += length
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(tokenized, PIECES)


class Plan:
    """Runs over the pieces of each length, made from the number of pieces per length."""

    @classmethod
    def shortest(cls, counts: dict[int, int], sequence: int) -> Plan:
        return min((cls(counts, sequence, *way) for way in WAYS), key=lambda plan: plan.sequences)

    def __init__(self, counts: dict[int, int], sequence: int, share: float, floor: float, held: float, least: float) -> None:
        self.sequence = sequence
        self.share, self.held_share, self.least = share, held, least
        self.floor = int(floor * sequence)
        self.left = np.zeros(sequence + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.held = np.zeros(sequence + 1, np.int64)  # what the sums of two and three leave of each length
        self.filled = [0, 0, 0, 0]  # sequences filled by one, two, three, four lengths that sum up to them
        self.used = np.zeros(sequence + 1, np.int64)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, from, to, first sequence, offset
        self._fill()

    def _place(self, length: int, n: int, first: int, offset: int) -> None:
        at = int(self.used[length])
        self.runs.append((length, at, at + n, first, offset))
        self.used[length] += n
        self.left[length] -= n

    def _open(self, lengths: tuple[int, ...], n: int) -> int:
        """n new sequences that hold these lengths each; the number of the first one."""
        first, offset = self.sequences, 0
        for length in lengths:
            self._place(length, n, first, offset)
            offset += length
        self.sequences += n
        return first

    def _consume(self, lengths: tuple[int, ...], share: float = 1.0) -> None:
        n = min(int(self.left[x] - self.held[x]) // lengths.count(x) for x in lengths)
        if n > 0:
            n = max(1, int(n * share))
            self._open(lengths, n)
            self.filled[len(lengths) - 1] += n

    def _fill(self) -> None:
        full = self.sequence
        self._consume((full,))
        for length in range(full - 1, full // 2 - 1, -1):  # the complement is a single length
            self._consume((length, full - length))
        least = int(self.least * max(np.flatnonzero(self.left), default=0))
        self.held[: self.floor] = self.left[: self.floor] * self.held_share
        for length in range(full - 1, max(full // 3, least) - 1, -1):  # a sum of two; length is the largest of the sequence's lengths
            gap = full - length
            a = np.arange((gap + 1) // 2, min(length, gap - 1) + 1)
            for x in a[self._open_to(a) & self._open_to(gap - a)].tolist():
                if not self._open_to(length):
                    break
                self._consume((length, x, gap - x), self.share)
        for length in range(full - 1, max(full // 4, least) - 1, -1):  # a sum of three
            gap = full - length
            for a in range((gap + 2) // 3, min(length, gap - 2) + 1):
                if not self._open_to(length):
                    break
                if self._open_to(a):
                    rest = gap - a
                    b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
                    for x in b[self._open_to(b) & self._open_to(rest - b)].tolist():
                        self._consume((length, a, x, rest - x), self.share)
        self._best_fit()

    def _open_to(self, lengths):
        """Whether a sum may take of these lengths."""
        return self.left[lengths] > self.held[lengths]

    def _best_fit(self) -> None:
        gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number of sequences)
        for length in range(self.sequence - 1, 0, -1):
            while self.left[length]:
                fits = [g for g in gaps if g >= length]
                if fits:
                    gap = min(fits)
                    first, n = gaps[gap].pop()
                    if not gaps[gap]:
                        del gaps[gap]
                    take = min(n, int(self.left[length]))
                    self._place(length, take, first, self.sequence - gap)
                    if gap > length:
                        gaps.setdefault(gap - length, []).append((first, take))
                    if take < n:
                        gaps.setdefault(gap, []).append((first + take, n - take))
                    continue
                each = self.sequence // length
                each = each if self.left[length] >= each else int(self.left[length])
                n = int(self.left[length]) // each
                first = self._open((length,) * each, n)
                if gap := self.sequence - each * length:
                    gaps.setdefault(gap, []).append((first, n))

    def by_length(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: the runs' first numbers (ascending), first sequences and offsets."""
        out: dict[int, list] = {}
        for length, at, _, first, offset in self.runs:
            out.setdefault(length, []).append((at, first, offset))
        return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def numbered(found: DataFrame, per_slice: int) -> DataFrame:
    """Adds number: the piece's place among those of its length, from 0."""
    rows = found.count()
    slices = max(1, rows // per_slice)
    sliced = found.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counts = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = sliced.withColumn("inside", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["length", "slice"]).withColumn("number", F.col("before") + F.col("inside"))


def pack(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    folder holds the vocabulary's files on every executor; by default the installed public ones."""
    found = cut(pieces(docs, sequence, end_id, vocabulary, folder, id_col, text_col))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length
    runs = Plan.shortest(counts, sequence).by_length()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequences, offsets = np.empty_like(numbers), np.empty_like(numbers)
            for length in np.unique(lengths):
                rows = lengths == length
                at, first, offset = runs[int(length)]
                run = np.searchsorted(at, numbers[rows], side="right") - 1
                sequences[rows] = first[run] + numbers[rows] - at[run]
                offsets[rows] = offset[run]
            yield pa.record_batch([*batch.columns[:5], pa.array(sequences), pa.array(offsets)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "number"]
    return numbered(found, PIECES_PER_SLICE).select(*columns).mapInArrow(placed, PLACED)
