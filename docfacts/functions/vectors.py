"""Vectors of texts, and distances on array columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


# Runs of letters and digits are words; a component is a multiple of 2 ** -14, so
# that squares and their sums are exact in doubles, in any order.
WORD = r"[\p{L}\p{N}]+"
UNIT = 1 << 14
# Components held at once while a batch is encoded.
CELLS = 1 << 20


def _draws(words: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of each word, from its MD5. Equal words are hashed once."""
    coded = words.dictionary_encode()
    digests = b"".join(hashlib.md5(w, usedforsecurity=False).digest() for w in coded.dictionary.cast(pa.binary()).to_pylist())
    found = np.frombuffer(digests, np.uint8).reshape(-1, 16)
    which = coded.indices.to_numpy(zero_copy_only=False)
    drawn = found[:, :4].copy().view(">u4").ravel().astype(np.int64) % dims
    return drawn[which], np.where(found[:, 4] < 128, 1, -1)[which]


def _places(words: pa.Array, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For a batch of word lists in stretches of at most ``CELLS`` components: how many lists, and
    place (list * dims + dimension) and sign of each word."""
    step = max(1, CELLS // dims)
    for start in range(0, len(words), step):
        part = words.slice(start, step)
        lengths = part.value_lengths().to_numpy(zero_copy_only=False)
        drawn, sign = _draws(part.flatten(), dims)
        yield len(part), np.repeat(np.arange(len(part)) * dims, lengths) + drawn, sign


def lists_with_dimension(words: pa.Array, dims: int) -> np.ndarray:
    """For each dimension, how many of the word lists have a word in it."""
    total = np.zeros(dims, np.int64)
    for n, places, _ in _places(words, dims):
        used = np.zeros(n * dims, bool)
        used[places] = True
        total += used.reshape(n, dims).sum(axis=0)
    return total


def unit_vectors(words: pa.Array, weights: np.ndarray) -> pa.Array:
    """The vector of each word list: whole-number sums of signed weights, scaled to length one and
    rounded to multiples of 2 ** -14."""
    dims, done = len(weights), [np.zeros(0)]
    for n, places, sign in _places(words, dims):
        sums = np.zeros(n * dims, np.int64)
        np.add.at(sums, places, sign * weights[places % dims])
        sums = sums.reshape(n, dims)
        length = np.sqrt((sums * sums).sum(axis=1).astype(np.float64))
        length[length == 0] = 1
        size = np.floor(np.abs(sums).astype(np.float64) * UNIT / length[:, None] + 0.5)
        done.append((np.sign(sums) * size / UNIT).ravel())
    return pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * dims, np.concatenate(done))


def _sum_over(vector: Column, query: Sequence[float] | Column, term) -> Column:
    """The terms of two vectors added in order, at any length. A null vector gives null; another
    length is an error, never a distance."""
    if not isinstance(query, Column):
        query = F.array(*[F.lit(float(x)) for x in query])
    left, right = vector.cast("array<double>"), query.cast("array<double>")
    total = F.aggregate(F.zip_with(left, right, term), F.lit(0.0), lambda total, x: total + x)
    wrong = F.raise_error(F.concat(
        F.lit("vector of "), F.size(left).cast("string"), F.lit(" dimensions, expected "), F.size(right).cast("string")
    ))
    return F.when(F.size(left) == F.size(right), total).when(left.isNotNull() & right.isNotNull(), wrong)


def squared_l2(vector: Column, query: Sequence[float] | Column) -> Column:
    return _sum_over(vector, query, lambda a, b: (a - b) * (a - b))


def dot(vector: Column, query: Sequence[float] | Column) -> Column:
    return _sum_over(vector, query, lambda a, b: a * b)


def cosine_distance(vector: Column, query: Sequence[float] | Column) -> Column:
    """``1 - cosine``; a zero vector is at distance 1 from everything, a null one at none."""
    squares = lambda v: F.aggregate(v.cast("array<double>"), F.lit(0.0), lambda total, x: total + x * x)
    if not isinstance(query, Column):
        query = F.array(*[F.lit(float(x)) for x in query])
    product = dot(vector, query)
    cosine = F.try_divide(product, F.sqrt(squares(vector)) * F.sqrt(squares(query)))
    return F.when(product.isNotNull(), F.lit(1.0) - F.coalesce(cosine, F.lit(0.0)))


METRICS = {"l2": squared_l2, "cosine": cosine_distance}


def distance(vector: Column, query: Sequence[float] | Column, metric: str = "l2") -> Column:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    return METRICS[metric](vector, query)


def squared_l2_by_batches(vector: Column, to: Sequence[float]) -> Column:
    """``squared_l2`` to one vector, the same bits by Arrow batches. It is evaluated once per row:
    filters above don't repeat it."""
    query = np.array([float(x) for x in to], np.float64)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            known = vectors.drop_null()
            lengths = known.value_lengths().to_numpy(zero_copy_only=False)
            if (lengths != len(query)).any():
                raise ValueError(f"vector of {lengths[lengths != len(query)][0]} dimensions, expected {len(query)}")
            found = np.zeros(len(vectors))
            missing = vectors.is_null().to_numpy(zero_copy_only=False).copy()
            at, step = np.flatnonzero(~missing), max(1, CELLS // max(1, len(query)))
            for start in range(0, len(known) if len(query) else 0, step):
                part = known.slice(start, step).flatten()
                values = part.to_numpy(zero_copy_only=False).reshape(-1, len(query))
                found[at[start : start + step]] = np.cumsum((values - query) ** 2, axis=1)[:, -1]
                if part.null_count:
                    gaps = part.is_null().to_numpy(zero_copy_only=False).reshape(-1, len(query)).any(axis=1)
                    missing[at[start : start + step]] = gaps
            yield pa.array(found, mask=missing)

    return run.asNondeterministic()(vector.cast("array<double>"))
