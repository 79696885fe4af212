"""Helpers shared by the operators: words, hashes, packed arrays, tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

#: White space of the word pattern ``[^\x20\x09-\x0D]+``; bytes.split() uses the same six.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(a: np.ndarray) -> bytes:
    """Numbers as zstandard over their byte planes; high zero bytes cost nothing."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending unsigned numbers, packed as differences."""
    return pack(np.diff(a.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length n, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


#: Rows of an Arrow batch that become Python objects at once.
SLICE_ROWS = 256


def sliced(batches: Iterator) -> Iterator:
    """Arrow batches in slices of few rows, so that a batch isn't held twice."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def rows_in_blocks(batches: Iterator, size_of, limit: int) -> Iterator[list]:
    """Rows of Arrow batches in lists whose sizes add up to ``limit`` at most, or one row."""
    block, total = [], 0
    for batch in sliced(batches):
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            size = size_of(row)
            if block and total + size > limit:
                yield block
                block, total = [], 0
            block.append(row)
            total += size
    if block:
        yield block


def power_of_two(n: float) -> int:
    """The smallest power of two that is not below ``n``."""
    return 1 << max(0, int(np.ceil(n)) - 1).bit_length()
