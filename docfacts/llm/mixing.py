"""Mixing sources to target weights.

Every source is a stream of words, packed into blocks of ``BLOCK`` words. The mix is a
row of slots in output shards; each shard draws how many of its slots go to each source
(the whole part of what is expected, the rest by a multinomial draw), the slots of a
source are numbered over all shards, and slot j of a source takes the block at place
j mod B of a pseudorandom permutation of its B blocks, a new one for each pass.

A source is cut into chunks of about ``CHUNK`` words by a hash of the document, so its
size never decides how much one task holds. A chunk is packed on its own (its last block
may be short), which keeps running sums local. The driver and each task see the list of
sources: one row for each, never documents.

Targets: weights 5, 2, 1 in the order of the sources; none above ``PASSES`` times its
size, the excess shared by weight. Draws beyond ``PASSES`` passes go to sources with room.

Nulls: a null text has size 0, a null source is a source of its own (last in order), null
ids are kept. Repeated rows are rows of their own. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfacts.llm.common import WORD, mix
from docfacts.session import scratch_dir

BLOCK = 128
CHUNK = 1_000_000
SHARD = 65_536
PASSES = 3
WEIGHTS = (5, 2, 1)
SEED = 20_011


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, source_size) with rank, weight and target.

    By ascending room for each unit of weight, a source is at its limit if that is below
    the level that the sources from it on would share; the level of the first that is
    not holds for all others. One row for each source meets in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1))
    room = F.col("source_size") * passes
    order = Window.orderBy((room / F.col("weight")).asc(), "rank")
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = F.sum("source_size").over(everything) - F.coalesce(F.sum(room).over(before), F.lit(0))
    levels = ranked.withColumn("level", shared / F.sum("weight").over(rest))
    levels = levels.withColumn("full", room / F.col("weight") <= F.col("level"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), room.cast("double")).otherwise(common * F.col("weight"))
    return levels.withColumn("target", target).select("source", "source_size", "rank", "weight", "target")


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a Feistel network over the next even power of two, walked until inside."""
    half = max(1, -(-max(1, n - 1).bit_length() // 2))
    low = np.uint64((1 << half) - 1)
    x = np.asarray(index, np.uint64).copy()
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & low
        for turn in range(4):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & (2**64 - 1))
            left, right = right, left ^ (mix(right ^ salt) & low)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def _draw(quota: np.ndarray, total: int, seed: int):
    share = quota / quota.sum()

    def draw(batches):
        for batch in batches:
            for shard, slots in zip(batch["id"], batch["slots"]):
                expected = slots * share
                count = np.floor(expected).astype(np.int64)
                left = int(slots - count.sum())
                if left > 0:
                    part = expected - count
                    count += np.random.default_rng([seed, shard]).multinomial(left, part / part.sum())
                ranks = np.flatnonzero(count)
                yield pd.DataFrame({"shard": shard, "rank": ranks, "slots": count[ranks]})

    return draw


def _blocks_of(seed: int, blocks: np.ndarray):
    def place(batches):
        for batch in batches:
            n = blocks[batch["rank"].to_numpy()]
            own, turn = batch["ordinal"].to_numpy() % n, batch["ordinal"].to_numpy() // n
            out = np.zeros(len(own), np.int64)
            for (rank, t), rows in batch.groupby([batch["rank"], turn]).indices.items():
                key = xxhash.xxh3_64_intdigest(f"{seed}:{rank}:{t}".encode())
                out[rows] = permute(own[rows], int(blocks[rank]), key)
            yield pd.DataFrame({"rank": batch["rank"], "block": out})

    return place


class Mix:
    """Sources, chunks and how often each block is taken; see the module."""

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = SEED):
        spark = docs.sparkSession
        text = F.coalesce(F.col(text_col), F.lit(""))
        sized = docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(text, F.col(id_col)).alias("mark"),
        )
        folder = scratch_dir(spark, "mix")
        sized.write.parquet(f"{folder}/sized")
        self.sized = spark.read.parquet(f"{folder}/sized")
        targets(self.sized.groupBy("source").agg(F.sum("size").alias("source_size"))).write.parquet(f"{folder}/sources")
        self.sources = spark.read.parquet(f"{folder}/sources")
        chunks = self.keyed(self.sized).groupBy("rank", "chunk").agg(F.sum("size").alias("words"))
        chunks.select("rank", "chunk", F.ceil(F.col("words") / BLOCK).alias("blocks")).write.parquet(f"{folder}/chunks")
        chunks = spark.read.parquet(f"{folder}/chunks")
        self.times = self._times(spark, chunks, seed)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with (source, mark) get their source's rank, size and target, and their chunk."""
        sources = self.sources.withColumnRenamed("source", "its_source")
        joined = rows.join(sources, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source", "weight")
        count = F.greatest(F.lit(1), F.ceil(F.col("source_size") / CHUNK))
        return joined.withColumn("chunk", F.pmod(F.xxhash64("mark"), count))

    def _times(self, spark, chunks: DataFrame, seed: int) -> DataFrame:
        """(rank, chunk, local, times) of the blocks that are taken."""
        totals = chunks.groupBy("rank").agg(F.sum("blocks").alias("blocks"))
        listed = self.sources.join(totals, "rank", "left").select("rank", "source_size", "target", F.coalesce("blocks", F.lit(0)).alias("blocks")).toPandas().sort_values("rank")
        schema = "rank int, chunk long, local long, times long"
        blocks, size = listed["blocks"].to_numpy(np.int64), listed["source_size"].to_numpy(np.float64)
        quota = listed["target"].to_numpy(np.float64) * blocks / np.maximum(size, 1)
        total = int(round(quota.sum()))
        if not total:
            return spark.createDataFrame([], schema)
        room = PASSES * blocks
        n_shards = -(-total // SHARD)
        shards = spark.range(n_shards).withColumn("slots", F.least(F.lit(SHARD), F.lit(total) - F.col("id") * SHARD))
        drawn = shards.mapInPandas(_draw(quota, total, seed), "shard long, rank int, slots long")
        by_shard = Window.partitionBy("rank").orderBy("shard")
        drawn = drawn.withColumn("first", F.sum("slots").over(by_shard) - F.col("slots"))
        got = drawn.groupBy("rank").agg(F.sum("slots")).collect()
        counts = np.zeros(len(blocks), np.int64)
        for rank, slots in got:
            counts[rank] = slots
        excess, counts = int(np.maximum(counts - room, 0).sum()), np.minimum(counts, room)
        limit = F.element_at(F.array(*map(F.lit, map(int, room))), F.col("rank") + 1) if len(room) else F.lit(0)
        parts = drawn.select("rank", "first", F.least(F.col("slots"), limit - F.col("first")).alias("slots"))
        if excess:
            more = np.minimum(np.floor(excess * (room - counts) / (room - counts).sum()).astype(np.int64), room - counts)
            for rank in np.argsort(counts - room)[: excess - int(more.sum())]:
                more[rank] += counts[rank] + more[rank] < room[rank]
            added = [(int(r), int(counts[r]), int(more[r])) for r in np.flatnonzero(more)]
            if added:
                parts = parts.unionByName(spark.createDataFrame(added, "rank int, first long, slots long"))
        slots = parts.filter("slots > 0").select("rank", F.explode(F.sequence("first", F.expr("first + slots - 1"))).alias("ordinal"))
        taken = slots.mapInPandas(_blocks_of(seed, blocks), "rank int, block long").groupBy("rank", "block").agg(F.count("*").alias("times"))
        by_chunk = Window.partitionBy("rank").orderBy("chunk")
        first = F.sum("blocks").over(by_chunk) - F.col("blocks")
        own = chunks.withColumn("first", first).filter("blocks > 0").select("rank", "chunk", "first", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("local"))
        own = own.select("rank", "chunk", "local", (F.col("first") + F.col("local")).alias("block"))
        return own.hint("merge").join(taken, ["rank", "block"]).select("rank", "chunk", "local", "times")


def _laid_out(rows: pd.DataFrame, times: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """A chunk's documents in order, where each begins, and how often each of its blocks is taken."""
    rows = rows.sort_values(["doc_id", "mark"], na_position="last", kind="stable")
    size = rows["size"].to_numpy(np.int64)
    starts = np.cumsum(size) - size
    taken = np.zeros(int(size.sum()) // BLOCK + 2, np.int64)
    taken[times["local"].to_numpy(np.int64)] = times["times"].to_numpy(np.int64)
    return rows, starts, taken


def _count(rows: pd.DataFrame, times: pd.DataFrame) -> pd.DataFrame:
    rows, starts, taken = _laid_out(rows, times)
    upto = np.concatenate([[0], np.cumsum(taken * BLOCK)])
    at = lambda words: upto[words // BLOCK] + (words % BLOCK) * taken[words // BLOCK]
    rows["taken"] = at(starts + rows["size"].to_numpy(np.int64)) - at(starts)
    return rows[["doc_id", "size", "source_size", "target", "taken"]]


def report(docs: DataFrame, **columns) -> DataFrame:
    """One row for each document: its size, its source's size and target, and the words the mix takes of it."""
    made = Mix(docs, **columns)
    rows = made.keyed(made.sized).select("rank", "chunk", "doc_id", "mark", "size", "source_size", "target")
    grouped = rows.groupBy("rank", "chunk").cogroup(made.times.groupBy("rank", "chunk"))
    kind = dict(rows.dtypes)["doc_id"]
    return grouped.applyInPandas(_count, f"doc_id {kind}, size long, source_size long, target double, taken long")


def _passes(text: str, start: int, size: int, taken: np.ndarray):
    """The text of each pass over a document: all of it, or its taken runs of words joined by one space."""
    times = taken[np.arange(start, start + size) // BLOCK]
    spans = None
    for turn in range(int(times.max(initial=0))):
        here = times > turn
        if here.all():
            yield turn, text
            continue
        if spans is None:
            spans = _word_spans(text)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], here, [False]]).astype(np.int8)))
        yield turn, " ".join(text[spans[a][0] : spans[b - 1][1]] for a, b in zip(edges[::2], edges[1::2]))


def _word_spans(text: str) -> list[tuple[int, int]]:
    import re

    return [m.span() for m in re.finditer(WORD, text)]


def mixed(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself: ``docs``' columns, a row for each pass over a document with the text taken then.

    Further columns keep their values. ``n_chars``, where present, follows the text.
    """
    made = Mix(docs, id_col, text_col, source_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
        F.xxhash64(text, F.col(id_col)).alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )
    rows = made.keyed(rows).filter("size > 0").select("rank", "chunk", "doc_id", "mark", "size", "row")
    names = docs.columns

    def cut(rows: pd.DataFrame, times: pd.DataFrame) -> pd.DataFrame:
        rows, starts, taken = _laid_out(rows, times)
        out = []
        for row, start, size in zip(rows["row"], starts, rows["size"]):
            row = row.asDict() if hasattr(row, "asDict") else dict(row)
            for _, part in _passes(row[text_col], int(start), int(size), taken):
                out.append(row | {text_col: part} | ({"n_chars": len(part)} if "n_chars" in row else {}))
        return pd.DataFrame(out, columns=names).astype(object).where(lambda x: x.notna(), None)

    return rows.groupBy("rank", "chunk").cogroup(made.times.groupBy("rank", "chunk")).applyInPandas(cut, docs.schema)
