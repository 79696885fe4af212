"""Language-model scores from a log-frequency Bloom filter.

The corpus is read once into blocks of whole documents: the words' numbers within the
block and the block's distinct words. All further steps work on these packed blocks and
count n-grams (orders 1 and 2) within each first, so that a frequent word costs one entry
a block and not one a use. Counts meet by ranges of their hash; the number of ranges
follows the corpus.

An n-gram with count c enters the filter as (n-gram, 1) ... (n-gram, q) with
q = 1 + floor(log_b c); a reader probes level after level until one is absent. The
filter is cut into one slice for each hash range, built where the range is counted, with
``BITS_PER_ENTRY`` bits for each of its entries. So every n-gram of the corpus is in it,
and absent ones are taken for present as rarely in a large corpus as in a small one.

No task holds more than one slice: the range's n-grams of all blocks, those of held-out
documents too, are probed where the slice is, and the levels go back to their blocks.

Score of a text: runs of ``RUN`` tokens each take the mixture of two experts, the unigram
model and a bigram model smoothed towards it, so text like the corpus profits from
bigrams and other text loses next to nothing.

Nulls: a null text is empty (its one token is the end); a null id counts as held out.
Empty table: no rows. Repeated rows each count and each get a row.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import (
    mix, pack, pack_sorted, power_of_two, rows_in_blocks, unpack, unpack_sorted, utf8,
)
from docfacts.session import scratch_dir

LOG_BASE = 1.5
BITS_PER_ENTRY = 12
PROBES = 3
BLOCK_BYTES = 4_000_000
RANGE_BYTES = 8_000_000
RUN = 16
BIGRAM_SHARE = 0.1
PRIOR = 1.0
ALPHA = 0.1

_END = b" "  # no word has a space, so the end can't meet one
_END_HASH = np.uint64(xxhash.xxh3_64_intdigest(_END))
_KEY_BITS = 48
_MOST_LEVELS = 1 + int(np.log(2.0**63) / np.log(LOG_BASE))  # so a full slice ends a reader too
_BLOCKS = "block long, ids array<long>, held binary, lens binary, seq binary, words binary"
_COUNTED = "block long, range int, keys binary, counts binary"
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 0 for 0, else 1 + floor(log_b c)."""
    safe = np.maximum(counts, 1)
    return np.where(counts > 0, 1 + np.floor(np.log(safe) / np.log(LOG_BASE) + 1e-9), 0).astype(np.int64)


def estimate(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    j = np.asarray(levels, dtype=np.float64)
    return np.where(j > 0, np.maximum(1.0, (LOG_BASE ** (j - 1) + LOG_BASE**j - 1) / 2), 0.0)


def unigram_keys(words: np.ndarray) -> np.ndarray:
    return mix(words ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(64 - _KEY_BITS)


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second) >> np.uint64(64 - _KEY_BITS)


def _positions(keys: np.ndarray, levels: np.ndarray, probe: int, bits: int, ranges: int) -> np.ndarray:
    """Bit of the whole filter: the key's slice, and a place in it by level and probe."""
    own = bits // ranges
    spread = mix(keys * np.uint64(0x2545F4914F6CDD1D) + levels.astype(np.uint64) * np.uint64(PROBES) + np.uint64(probe))
    return (keys >> np.uint64(_KEY_BITS - ranges.bit_length() + 1)) * np.uint64(own) + spread % np.uint64(own)


def filter_slice(keys: np.ndarray, counts: np.ndarray, range_id: int, bits: int, ranges: int) -> bytes:
    """The slice of the filter for one hash range; n-grams of count 0 have no entry."""
    own = bits // ranges
    levels = level(counts)
    flags = np.zeros(own, np.uint8)
    for j in range(1, int(levels.max(initial=0)) + 1):
        here = keys[levels >= j]
        for probe in range(PROBES):
            flags[_positions(here, np.full(len(here), j), probe, bits, ranges) - np.uint64(range_id * own)] = 1
    return np.packbits(flags).tobytes()


def probe_levels(table: np.ndarray, keys: np.ndarray, bits: int, ranges: int, first: int = 0) -> np.ndarray:
    """Quantised counts by probing level after level until one is absent; ``table`` begins with the slice ``first``."""
    skipped = np.uint64(first * (bits // ranges))
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    j = 1
    while len(alive) and j <= _MOST_LEVELS:
        for probe in range(PROBES):
            at = _positions(keys[alive], np.full(len(alive), j), probe, bits, ranges) - skipped
            alive = alive[(table[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1]
        found[alive] = j
        j += 1
    return found


def _cuts(keys: np.ndarray, top_bits: int, ranges: int) -> np.ndarray:
    """Where each hash range begins in ascending keys."""
    edges = np.arange(1, ranges, dtype=np.uint64) << np.uint64(top_bits - ranges.bit_length() + 1)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _encode(batches):
    """Documents to blocks: word numbers in text order, by ascending hash of the block's distinct words."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    for number, rows in enumerate(rows_in_blocks(batches, lambda r: len(r[1] or ""), BLOCK_BYTES)):
        numbers, pieces = defaultdict(count().__next__), []
        for _, text, _ in rows:
            tokens = utf8(text).lower().split()
            tokens.append(_END)
            pieces.append(np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([base | number], pa.int64()),
            "ids": pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
            "held": [np.packbits(np.array([r[2] for r in rows], bool)).tobytes()],
            "lens": [pack(np.array([len(p) for p in pieces], np.int64))],
            "seq": [pack(rank[np.concatenate(pieces)])],
            "words": [pack_sorted(hashes[order])],
        })


class _Block:
    """The arrays of a block row."""

    def __init__(self, held: bytes, lens: bytes, seq: bytes, words: bytes):
        self.lens, self.words = unpack(lens, np.int64), unpack_sorted(words)
        self.seq = unpack(seq, np.uint32).astype(np.int64)
        self.held = np.unpackbits(np.frombuffer(held, np.uint8))[: len(self.lens)].astype(bool)
        self.starts = np.cumsum(self.lens) - self.lens

    def before(self, values: np.ndarray, first) -> np.ndarray:
        """For each token, the value of the word before it; ``first`` for the first of a text."""
        out = values[np.roll(self.seq, 1)]
        out[self.starts] = first
        return out

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        train = np.repeat(~self.held, self.lens)
        return self.words, np.bincount(self.seq[train], minlength=len(self.words))

    def grams(self, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the words and distinct bigrams, what sorts them, and each token's place among the bigrams."""
        grams, place = np.unique(bigram_keys(history, self.words[self.seq]), return_inverse=True)
        keys = np.concatenate([unigram_keys(self.words), grams])
        return keys, np.argsort(keys, kind="stable"), place

    def gram_counts(self) -> tuple[np.ndarray, np.ndarray]:
        keys, by, place = self.grams(self.before(self.words, _END_HASH))
        train = np.repeat(~self.held, self.lens)
        _, counts = self.word_counts()
        counts = np.concatenate([counts, np.bincount(place[train], minlength=len(keys) - len(counts))])
        return keys[by], counts[by]


def _counted(what: str, key_bits: int, ranges: int):
    """Blocks to (block, range, keys, counts): one row for each hash range that the block has keys of."""

    def counted(batches):
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for block, held, lens, seq, words in zip(*columns):
                keys, counts = getattr(_Block(held, lens, seq, words), what)()
                cuts = _cuts(keys, key_bits, ranges)
                parts = [(i, slice(a, b)) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                for start in range(0, len(parts), 256):
                    some = parts[start : start + 256]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block] * len(some), pa.int64()),
                        "range": pa.array([i for i, _ in some], pa.int32()),
                        "keys": [pack_sorted(keys[at]) for _, at in some],
                        "counts": [pack(counts[at].astype(np.uint64)) for _, at in some],
                    })

    return counted


def _merged(part: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Keys by row, distinct keys, each key's place among them, and total counts."""
    own = [unpack_sorted(x) for x in part["keys"].to_pylist()]
    counts = np.concatenate([unpack(x, np.uint64) for x in part["counts"].to_pylist()]).astype(np.int64)
    keys, place = np.unique(np.concatenate(own), return_inverse=True)
    order = np.argsort(place, kind="stable")
    totals = np.add.reduceat(counts[order], np.searchsorted(place[order], np.arange(len(keys))))
    return own, keys, place, totals


def _count_words(part: pa.Table) -> pa.Table:
    """For each block of one hash range, the corpus counts of its words; sums in the first row."""
    own, keys, place, totals = _merged(part)
    at = np.cumsum([0, *map(len, own)])
    zero = [0] * (len(own) - 1)
    return pa.table({
        "block": part["block"], "range": part["range"],
        "counts": pa.array([pack(totals[place[a:b]].astype(np.uint64)) for a, b in zip(at, at[1:])], pa.binary()),
        "tokens": pa.array([int(totals.sum()), *zero], pa.int64()),
        "distinct": pa.array([int((totals > 0).sum()), *zero], pa.int64()),
        "estimated": pa.array([float(estimate(level(totals)).sum()), *map(float, zero)], pa.float64()),
    })


def _level_grams(ranges: int):
    def levels(part: pa.Table) -> pa.Table:
        """For each block of one hash range, the levels of its n-grams by the range's slice of the filter."""
        own, keys, place, totals = _merged(part)
        i = part["range"][0].as_py()
        bits = ranges * max(64, -(-int(level(totals).sum()) * BITS_PER_ENTRY // 8) * 8)
        table = np.frombuffer(filter_slice(keys, totals, i, bits, ranges), np.uint8)
        found = probe_levels(table, keys, bits, ranges, i).astype(np.uint8)
        at = np.cumsum([0, *map(len, own)])
        return pa.table({
            "block": part["block"], "range": part["range"],
            "levels": pa.array([pack(found[place[a:b]]) for a, b in zip(at, at[1:])], pa.binary()),
        })

    return levels


def _in_order(answers: list[dict], name: str, dtype) -> np.ndarray:
    """A block's answers, one for each hash range, as one array."""
    return np.concatenate([unpack(a[name], dtype) for a in sorted(answers, key=lambda a: a["range"])]).astype(np.int64)


def _score(tokens: int, distinct: int, estimated: float):
    floor = tokens + ALPHA * (distinct + 1)
    spread = estimated + ALPHA * (distinct + 1)

    def score(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        for batch in batches:
            for ids, held, lens, seq, words, answers, levels in zip(*(c.to_pylist() for c in batch.columns)):
                own = _Block(held, lens, seq, words)
                lens, words, seq, starts = own.lens, own.words, own.seq, own.starts
                counts = _in_order(answers, "counts", np.uint64)
                base = np.add.reduceat(np.log10((counts + ALPHA) / floor)[seq], starts)
                known = np.add.reduceat((counts > 0)[seq].astype(np.int64), starts)
                _, by, place = own.grams(own.before(words, _END_HASH))
                grams = np.empty(len(by))
                grams[by] = estimate(_in_order(levels, "levels", np.uint8))
                one, two = grams[: len(words)], grams[len(words) :][place]
                single = ((one + ALPHA) / spread)[seq]
                history_count = own.before(one, one[np.searchsorted(words, _END_HASH)])  # each text has its end
                two = np.minimum(two, np.minimum(history_count, one[seq]))  # no pair is more frequent than its words
                double = (two + PRIOR * single) / (history_count + PRIOR)
                n_runs = -(-lens // RUN)
                doc = np.repeat(np.arange(len(lens)), n_runs)
                at = starts[doc] + RUN * (np.arange(len(doc)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs))
                a, b = np.add.reduceat(np.log10(single), at), np.add.reduceat(np.log10(double), at)
                both = np.logaddexp2((a / np.log10(2)) + np.log2(1 - BIGRAM_SHARE), (b / np.log10(2)) + np.log2(BIGRAM_SHARE)) * np.log10(2)
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), pa.array(own.held),
                    pa.array(lens), pa.array(known), pa.array(np.full(len(lens), tokens, np.int64)), pa.array(base),
                    pa.array(np.add.reduceat(both, np.searchsorted(doc, np.arange(len(lens))))),
                ], schema=schema)

    return score


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: exact base score and the model's log10 probability.

    The model learns from the documents whose crc32 of the id is not divisible by 10.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(True))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = power_of_two(max(2, total / RANGE_BYTES))
    folder = scratch_dir(spark, "lm")
    if source.isEmpty():
        return spark.createDataFrame([], _SCORES)
    source.mapInArrow(_encode, _BLOCKS).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    packed = blocks.select("block", "held", "lens", "seq", "words")
    packed.mapInArrow(_counted("word_counts", 64, ranges), _COUNTED).groupBy("range").applyInArrow(
        _count_words, "block long, range int, counts binary, tokens long, distinct long, estimated double"
    ).write.parquet(f"{folder}/answers")
    answers = spark.read.parquet(f"{folder}/answers")
    tokens, distinct, estimated = answers.agg(F.sum("tokens"), F.sum("distinct"), F.sum("estimated")).first()
    packed.mapInArrow(_counted("gram_counts", _KEY_BITS, ranges), _COUNTED).groupBy("range").applyInArrow(
        _level_grams(ranges), "block long, range int, levels binary"
    ).write.parquet(f"{folder}/levels")
    levels = spark.read.parquet(f"{folder}/levels")
    known = answers.groupBy("block").agg(F.collect_list(F.struct("range", "counts")).alias("answers"))
    known = known.join(levels.groupBy("block").agg(F.collect_list(F.struct("range", "levels")).alias("levels")), "block")
    return (
        blocks.join(known, "block").select("ids", "held", "lens", "seq", "words", "answers", "levels")
        .mapInArrow(_score(tokens, distinct, estimated), _SCORES)
    )
