"""Benchmark decontamination by q-gram lemma filtering.

An item of n characters that occurs in a text with k edits at most shares n + 1 - q(k + 1)
of its q-grams with it, all on diagonals (place in the text less place in the item) that
lie within k of one. So shared q-grams are counted in overlapping bands of diagonals, twice
as wide as that reach; a band whose count meets the bound is verified by an alignment that
stays within the band. k is ``EDIT_RATE`` of the item's length.

Both sides are lower-cased and have runs of white space turned into one space. Items come
in blocks of bounded size, each set against all texts where they are; no text moves.

Nulls and empty texts hold nothing; null and empty items are never found. An item shorter
than a q-gram is found in a text that equals it. Repeated rows each get their findings. An
empty table gives no rows. A text with one item at several places gets the best of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import mix, power_of_two, rows_in_blocks, runs, sliced

Q = 8
EDIT_RATE = 0.08
BLOCK_CHARS = 2_000_000
_TEXT_CHARS = 1_000_000
_FOUND = "doc_id long, item_id long, edits int, start long, end long"


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the q-gram at each place."""
    n = len(data) - Q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(Q):
        code = code << np.uint64(8) | data[i : i + n].astype(np.uint64)
    return mix(code)


def align(item: np.ndarray, text: np.ndarray, width: int, anywhere: bool = True) -> tuple[int, int]:
    """(edits, end) of the best place of ``item`` that begins within ``width`` of the text's start.

    Row i of the alignment holds the cells (i, i + d) of the diagonals d = 0..width only.
    ``anywhere``: it may begin at any of them free of charge, else at 0.
    """
    d = np.arange(width + 1)
    padded = np.zeros(len(item) + width + 1, np.int16)
    padded[:] = -1
    padded[: min(len(text), len(padded))] = text[: len(padded)]
    beyond = len(item) + len(padded)
    now = np.zeros(width + 1, np.int64) if anywhere else d.astype(np.int64)
    now[d > len(text)] = beyond
    for i, letter in enumerate(item):
        step = now + (padded[i : i + width + 1] != letter)
        step[:-1] = np.minimum(step[:-1], now[1:] + 1)
        now = np.minimum.accumulate(step - d) + d
        now[i + 1 + d > len(text)] = beyond
    best = int(now.argmin())
    return int(now[best]), len(item) + best


class Items:
    """Benchmark items with an index of their q-grams."""

    def __init__(self, rows: list[tuple[int, str]]):
        pairs = [(i, normalised(text)) for i, text in rows]
        self.whole: dict[bytes, list[int]] = {}
        for i, text in pairs:
            if 0 < len(text) < Q:
                self.whole.setdefault(text, []).append(i)
        pairs = [(i, text) for i, text in pairs if len(text) >= Q]
        self.ids, self.bytes = [i for i, _ in pairs], [text for _, text in pairs]
        self.texts = [np.frombuffer(text, np.uint8) for text in self.bytes]
        lens = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.minimum((EDIT_RATE * lens).astype(np.int64), lens // Q - 1)
        self.least = lens + 1 - Q * (self.edits + 1)
        self.reach = 2 * self.edits + 1
        owner = np.repeat(np.arange(len(lens)), lens - Q + 1)
        codes = np.concatenate([grams(t) for t in self.texts]) if len(lens) else np.zeros(0, np.uint64)
        order = np.argsort(codes, kind="stable")
        self.owner, self.place = owner[order], runs(lens - Q + 1)[order]
        self.codes, self.first, self.many = np.unique(codes[order], return_index=True, return_counts=True)
        self.mask = np.uint64(min(2**26, max(2**16, power_of_two(64 * len(self.codes)))) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)
        self.maybe[self.codes & self.mask] = True

    def bands(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, first diagonal) of the bands that meet the bound of their item."""
        codes = grams(data)
        at = np.flatnonzero(self.maybe[codes & self.mask])
        spot = np.searchsorted(self.codes, codes[at])
        spot[spot == len(self.codes)] = 0
        same = self.codes[spot] == codes[at] if len(self.codes) else np.zeros(len(at), bool)
        at, spot = at[same], spot[same]
        many = self.many[spot]
        entry = np.repeat(self.first[spot], many) + runs(many)
        item = self.owner[entry]
        longest = max(map(len, self.texts), default=0)
        band = (np.repeat(at, many) - self.place[entry] + longest) // self.reach[item]
        span = np.int64(len(data) + 2 * longest + 2)
        # the band before overlaps with this one, and either may hold all of a place's diagonals
        keys, counts = np.unique(np.concatenate([item * span + band, item * span + band - 1]), return_counts=True)
        good = keys[counts >= self.least[keys // span]]
        for i, b in zip((good // span).tolist(), (good % span).tolist()):
            yield i, b * int(self.reach[i]) - longest


def find(items: Items, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item number, edits, start, end): the best place of each item found in each text."""
    data = np.frombuffer(b"\0".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, low in items.bands(data):
        item, width = items.texts[i], 2 * int(items.reach[i])
        low, high = max(low, 0), low + width + len(item) + int(items.edits[i])
        for t in range(int(np.searchsorted(ends, low)), int(np.searchsorted(starts, high))):
            a, b = max(low, int(starts[t])), min(high, int(ends[t]))
            if b - a < len(item) - items.edits[i]:
                continue
            exact = texts[t].find(items.bytes[i], a - int(starts[t]), b - int(starts[t]))
            if exact >= 0:
                found = (0, exact, exact + len(item))
            else:
                edits, end = align(item, data[a:b], min(width, b - a))
                if edits > items.edits[i]:
                    continue
                _, back = align(item[::-1], data[a : a + end][::-1], int(items.edits[i]), anywhere=False)
                found = (edits, a + end - back - int(starts[t]), a + end - int(starts[t]))
            if (t, i) not in best or found < best[t, i]:
                best[t, i] = found
    for (t, i), found in sorted(best.items()):
        yield t, i, *found


def _in(items: Items, raw: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item id, edits, start, end) of all items found in the texts."""
    texts = [normalised(text) for text in raw]
    for t, i, *place in find(items, texts):
        yield t, items.ids[i], *place
    for t, text in enumerate(texts):
        for i in items.whole.get(text, ()):
            yield t, i, 0, 0, len(text)


def _search(shared):
    def search(batches):
        items = Items(shared.value)
        for rows in rows_in_blocks(batches, lambda r: len(r[1] or ""), _TEXT_CHARS):
            found = [(rows[t][0], *rest) for t, *rest in _in(items, [r[1] for r in rows])]
            columns = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(columns[0], pa.int64()), "item_id": pa.array(columns[1], pa.int64()),
                "edits": pa.array(columns[2], pa.int32()), "start": pa.array(columns[3], pa.int64()), "end": pa.array(columns[4], pa.int64()),
            })

    return search


def _drop(shared, at: int):
    def drop(batches):
        items = Items(shared.value)
        for batch in sliced(batches):
            keep = np.ones(batch.num_rows, bool)
            for t, *_ in _in(items, batch.column(at).to_pylist()):
                keep[t] = False
            yield batch.filter(pa.array(keep))

    return drop


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    block, chars = [], 0
    for row in benchmark.select(F.col(id_col).cast("long"), text_col).toLocalIterator():
        size = len(row[1] or "")
        if block and chars + size > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        if size:
            block.append((row[0], row[1]))
            chars += size
    if block:
        yield block


def findings(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, edits, start, end): items found in ``docs``, places in the normalised text's bytes."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    found = spark.createDataFrame([], _FOUND)
    for number, block in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        part = rows.mapInArrow(_search(spark.sparkContext.broadcast(block)), _FOUND)
        found = found.unionByName(part) if number else part
    return found


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_id_col, item_text_col):
        docs = docs.mapInArrow(_drop(docs.sparkSession.sparkContext.broadcast(block), at), docs.schema)
    return docs
