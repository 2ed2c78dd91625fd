"""Small helpers shared by the operators: sizes, partition counts, 64-bit
mixing, and a compact form for sorted integers sent through a shuffle."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a run of characters other than ASCII white space; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def corpus_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def planes(a: np.ndarray) -> bytes:
    """Byte planes of an integer array: planes of equal bytes vanish when compressed."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(data, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(dtype)


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(planes(a))


def unpack(data, dtype) -> np.ndarray:
    return from_planes(zstandard.ZstdDecompressor().decompress(data), dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)
