"""Quality rules with compression bands.

zstandard is run over a whole text and over each of its fixed chunks. How many bytes a
text takes for each of its own says how repetitive (few) or incompressible (many) it is;
what is usual depends on the length, since a compressor needs some text to learn from.
So each length class has its own band. A text is rejected if its whole ratio leaves the
band of its length, or if more than ``BAD_SHARE`` of its bytes are in chunks that leave
theirs: the chunk band, or for a last chunk that is not full the band of its length.

The bands are parameters: below a seventh of its size a text repeats itself, and base64 or
other random characters take three quarters and more (0.75 from 4096 bytes on, 0.76 from
1024, 0.80 from 512, 0.85 from 256), where prose of sf0.1 takes 0.5, 0.6, 0.7 and 0.75. The
upper limits lie between. Below 256 bytes prose and base64 take alike, and texts get room.

Base figures of a text: characters in words, symbols, duplicate lines, words in repeated
8-word windows, and the two rules on them. Nulls: a null text has no words and fails the
word count; null ids are kept. Empty table: no rows. Repeated rows each get a row.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import mix, sliced, utf8

LEVEL = 3
CHUNK = 4096
#: From so many bytes on: least and most compressed bytes for each byte.
BANDS = (
    (0, 0.0, 9.0), (64, 0.20, 1.25), (256, 0.15, 0.80), (512, 0.15, 0.76), (1024, 0.14, 0.72), (4096, 0.13, 0.72),
    (16384, 0.12, 0.68),
)
CHUNK_BAND = (0.12, 0.72)
BAD_SHARE = 0.5
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30

_SYMBOLS = b"#*$%&|<>"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("ratio", pa.float64()), ("bad_chunks", pa.float64()),
])
_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunks double"
)


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more in the text."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    windows = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        windows = mix(windows * np.uint64(0x9E3779B97F4A7C15) + numbers[i : i + n].astype(np.uint64))
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[place] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def band(size: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def compression(data: bytes, compressor) -> tuple[float, float]:
    """Compressed bytes a byte of the whole text, and the share of its bytes in chunks outside their band."""
    if not data:
        return 1.0, 0.0
    whole, bad = len(compressor.compress(data)) / len(data), 0
    for i in range(0, len(data), CHUNK):
        chunk = data[i : i + CHUNK]
        ratio = whole if len(data) <= CHUNK else len(compressor.compress(chunk)) / len(chunk)
        low, high = CHUNK_BAND if len(chunk) == CHUNK else band(len(chunk))
        bad += 0 if low <= ratio <= high else len(chunk)
    return whole, bad / len(data)


def within(size: int, ratio: float, bad_chunks: float) -> bool:
    low, high = band(size)
    return low <= ratio <= high and bad_chunks <= BAD_SHARE


def _measure(batches):
    compressor, drop = zstandard.ZstdCompressor(level=LEVEL), re.compile(rb"[\x80-\xBF]+")
    for batch in sliced(batches):
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = utf8(text)
            words = data.split()
            numbers = defaultdict(count().__next__)
            seq = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            again = repeated_words(seq)
            chars = len(b"".join(words)) if data.isascii() else len(drop.sub(b"", b"".join(words)))
            symbols = len(data) - len(data.translate(None, _SYMBOLS))
            failed = len(words) < LEAST_WORDS or 100 * again > REPEATED_PERCENT * len(words)
            ratio, bad = compression(data, compressor)
            out.append((doc_id, len(words), chars, symbols, duplicate_lines(data), again, failed, not failed and within(len(data), ratio, bad), ratio, bad))
        columns = list(zip(*out)) or [()] * len(_SCHEMA)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)], schema=_SCHEMA)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: base figures, verdicts, and what the verdict rests on."""
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_measure, _DDL)
