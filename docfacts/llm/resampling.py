"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Features are runs of 1 to ``order`` consecutive words; a feature's bucket is the CRC-32 of its
UTF-8 bytes modulo ``buckets``. A bucket's gain is the scaled logarithm of its smoothed share in
the target against that in the documents, a document's weight the floored mean of the gains of
its features, its score the weight plus a Gumbel draw from its id, and the highest scores are
drawn: a sample without replacement in proportion to the weights' exponentials.

Head and tail: every task counts its features with a bounded table that drops the rarest half
when full, the tables are added up, and the ``HEAD`` most frequent words and runs are broadcast,
words with their CRC state and longer runs with their bucket. A feature of the head costs a
look-up; one of the tail takes its CRC directly, a run of words by continuing the state of the
run before its last word. Both give the same bucket, so totals are exact whatever the head
holds, and cover all documents.

Scale: three passes over the texts (head, totals, weights), in blocks of ``BLOCK_WORDS`` words, so
that a very long text is never held as a list of words. What is broadcast or seen by the driver
is bounded by parameters: ``HEAD`` features of at most ``LONGEST`` bytes, two totals for each
bucket, and a count for each score (scores are whole numbers between about -40,000 and 60,000 at
any size). Ranks need no sort of all rows: a score's rows begin after the counts of the higher
scores, and equal rows are numbered as one group.

Defined results: a null or empty text has no feature and weight 0; a null id draws with empty
text in the place of the id and comes last among ties; repeated rows get a rank each; an empty
target or table gives gains by the smoothing alone. Other columns take no part.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfacts.llm.common import sliced
from docfacts.llm.copies import expanded
from docfacts.session import scratch_dir

#: Words of a text whose letters A-Z were lowered, in UTF-8; bytes from 0x80 on belong to words.
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ORDER, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
#: Features of the head, and the bytes of the longest word or run that may be one.
HEAD, LONGEST = 32_768, 64
BLOCK_WORDS = 65_536


def word_blocks(text: bytes, order: int = 1) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in lists of bounded length, each with the ``order - 1`` words before
    it, and how many those are."""
    found = (match.group() for match in WORDS.finditer(text.lower()))
    before: list[bytes] = []
    while block := list(itertools.islice(found, BLOCK_WORDS)):
        words = before + block
        yield words, len(before)
        before = words[max(0, len(words) - order + 1) :]


def new_runs(n_words: int, before: int, n: int) -> range:
    """Where the runs of ``n`` words begin that end after the first ``before`` words."""
    return range(max(0, before - n + 1), max(0, n_words - n + 1))


def feature_buckets(
    text: bytes, order: int, buckets: int, states: dict[bytes, int], pairs: dict[bytes, int]
) -> Iterator[np.ndarray]:
    """The buckets of all features of a text, in an array for each block and run length.

    ``states`` has the CRC states of the head's words, ``pairs`` the buckets of its pairs.
    """
    crc = zlib.crc32
    for words, before in word_blocks(text, order):
        state = [states[w] if w in states else crc(w) for w in words]
        yield np.array(state[before:], dtype=np.int64) % buckets
        for n in range(2, order + 1):
            starts = new_runs(len(words), before, n)
            if order == 2:
                yield np.array([
                    pairs[pair] if (pair := words[i] + b" " + words[i + 1]) in pairs else crc(b" " + words[i + 1], state[i]) % buckets
                    for i in starts
                ], dtype=np.int64)
            else:
                # ``state[i]`` becomes the state of the n words from i on.
                state = [crc(b" " + words[i + n - 1], state[i]) for i in range(max(0, len(words) - n + 1))]
                yield np.array(state[starts.start :], dtype=np.int64) % buckets


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


class Frequent:
    """Counts of the most frequent items in a table of bounded size; counts may be too low."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, items: Iterator[bytes]) -> None:
        self.counts.update(items)
        if len(self.counts) > 4 * self.size:
            self.counts = Counter(dict(self.counts.most_common(2 * self.size)))

    def top(self) -> list[tuple[bytes, int]]:
        return self.counts.most_common(2 * self.size)


def head_of(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS, head: int = HEAD) -> tuple[dict, dict]:
    """CRC states of the most frequent words, and buckets of the most frequent pairs for order 2."""
    longest = LONGEST

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Frequent(head), Frequent(head)
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                for block, before in word_blocks(text or b"", order):
                    words.add(w for w in block[before:] if len(w) <= longest)
                    if order == 2:
                        joined = (block[i] + b" " + block[i + 1] for i in new_runs(len(block), before, 2))
                        pairs.add(pair for pair in joined if len(pair) <= longest)
        found = [(w, 1, n) for w, n in words.top()] + [(p, 2, n) for p, n in pairs.top()]
        if found:
            item, length, n = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.binary()), pa.array(length, pa.int32()), pa.array(n, pa.int64())], ["item", "length", "n"]
            )

    counted = _texts(docs).mapInArrow(count, "item binary, length int, n long").groupBy("length", "item").agg(F.sum("n").alias("n"))
    best = [
        [bytes(r["item"]) for r in counted.filter(F.col("length") == length).orderBy(F.desc("n"), "item").limit(head).collect()]
        if length == 1 or order == 2 else []
        for length in (1, 2)
    ]
    return {w: zlib.crc32(w) for w in best[0]}, {p: zlib.crc32(p) % buckets for p in best[1]}


def bucket_totals(docs: DataFrame, order: int, buckets: int, states: dict, pairs: dict) -> np.ndarray:
    """The features in each bucket, over all rows: one number a bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in sliced(batches):
            for text in batch.column(0).to_pylist():
                for found in feature_buckets(text or b"", order, buckets, states, pairs):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    result = np.zeros(buckets, dtype=np.int64)
    summed = _texts(docs).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():
        result[row["bucket"]] = row["n"]
    return result


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket from the totals of the documents and of the target."""
    buckets, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (all_source + buckets)) / float((s + 1) * (all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ], dtype=np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, order: int, states: dict, pairs: dict) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                n_words = n = total = 0
                for words in feature_buckets(text or b"", order, buckets, states, pairs):
                    n += len(words)
                    total += int(gains[words].sum())
                n_words = n if order == 1 else sum(len(w) - b for w, b in word_blocks(text or b""))
                rows.append((n_words, n, total // n if n else 0))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_words", "n_features", "weight"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs, "doc_id").mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def with_score(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``score``: the weight and a Gumbel draw from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + gumbel)


def ranked(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Add ``rank`` (1, 2, 3...) to the highest scores of the rows long enough; null for the others.

    ``rows`` is read three times, so it should be a written table.
    """
    eligible = rows.filter(F.col("n_words") >= least_words)
    # One row for each score that occurs; scores span about 100,000 whole numbers at most.
    by_score = sorted(((r["score"], r["n"]) for r in eligible.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, above, starts = percent * sum(n for _, n in by_score) // 100, 0, []
    for score, n in by_score:
        if above >= wanted:
            break
        starts.append((score, above))
        above += n
    cutoff = starts[-1][0] if starts else None
    what = ("doc_id", "n_words", "n_features", "weight", "score")
    no_rank = F.lit(None).cast("long")
    if cutoff is None:
        return rows.select(*what, no_rank.alias("rank"))
    near = (F.col("n_words") >= least_words) & (F.col("score") >= cutoff)
    rest = rows.filter(~near).select(*what, no_rank.alias("rank"))
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "score long, _above long"))
    before = (
        Window.partitionBy("score")
        .orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight", "n_words")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    groups = (
        rows.filter(near)
        .groupBy(*what)
        .agg(F.count("*").alias("n"))
        .withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(offsets, "score")
        .withColumn("_first", F.col("_above") + F.col("_before") + 1)
    )
    drawn = expanded(groups, "n", "_first", "rank")
    return rest.unionByName(drawn.select(*what, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    order: int = ORDER,
    buckets: int = BUCKETS,
    head: int = HEAD,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; those with a rank are drawn."""
    states, pairs = head_of(docs, order, buckets, head)
    source = bucket_totals(docs, order, buckets, states, pairs)
    gains = gains_of(source, bucket_totals(target, order, buckets, states, pairs))
    path = scratch_dir(docs.sparkSession, "resampling")
    with_score(weighted(docs, gains, order, states, pairs), seed).write.parquet(path)
    return ranked(docs.sparkSession.read.parquet(path), least_words, percent)
