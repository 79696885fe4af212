"""Token files: one wavelet matrix per shard.

Documents are dealt by ranges of their id, so that partition, shard and place give the
order of all tokens. Each task encodes its documents in order and closes a shard at
``SHARD_TOKENS`` tokens; a longer document is a shard of its own. A shard is one row of
the files: its documents, and its tokens as the bit-planes of a wavelet matrix over the
shard's own alphabet, with a count of ones at every ``STEP`` bits, under zstandard.

The matrix gives a token by place (``access``), the uses of a token before a place
(``rank``), its k-th use (``select``), and all tokens (``decode``), each from the planes.

A byte-level tokenizer encodes each match of its pattern on its own, and no match goes
across the start of a run of white space. So texts are cut there, by their bytes as Arrow
holds them; each different piece of some texts is looked up once. A piece that is new to a
bounded cache is cut into its matches, and those go to the byte-pair model of the
tokenizers library; the ids are those of the whole text. Tokenizers of another kind get
whole texts. From task to task the worker process keeps the pieces it met first, which
are the most frequent.

Nulls: a null text is empty (its one token is the end); null ids come last. Rows with one
id are ordered by a hash of their text. Empty table: no rows.
"""

from __future__ import annotations

import gc
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


END_ID = 2
SHARD_TOKENS = 2**20
PARTITION_BYTES = 32_000_000
STEP = 512
CACHE_PIECES = 600_000
KEPT_PIECES = 250_000
#: Bytes of texts that are encoded at a time, or one text.
CHUNK_BYTES = 2_000_000

# The white space of the tokenizer's pattern, in UTF-8, by single bytes and by the first of several.
_SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_IS_SPACE = np.isin(np.arange(256), [ord(c) for c in _SPACES if c.isascii()])
_LONG_SPACES = {b[0]: [x for x in (c.encode() for c in _SPACES) if x[0] == b[0]] for b in (c.encode() for c in _SPACES) if len(b) > 1}
# Fixed value: the pattern of byte-level tokenizers.
_MATCH = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Marks that are one match together after a word.
_STOPS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_FILES = (
    "part int, seq int, n_tokens long, doc_ids array<long>, lens array<long>, alphabet array<int>, matrix binary"
)
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class WaveletMatrix:
    """Numbers below ``2**depth`` as bit-planes; see the module."""

    def __init__(self, length: int, planes: list[np.ndarray]):
        self.length, self.planes = length, planes  # packed, the highest bit first
        self.ones = [self._directory(plane) for plane in planes]
        self.zeros = [length - int(ones[-1]) for ones in self.ones]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(plane) * 8 // STEP) * STEP // 8, np.uint8)
        padded[: len(plane)] = plane
        each = np.bitwise_count(padded.reshape(-1, STEP // 8)).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(each)])

    @classmethod
    def build(cls, values: np.ndarray, depth: int) -> WaveletMatrix:
        planes, now = [], np.asarray(values, np.uint16 if depth <= 16 else np.uint32)
        for bit in range(depth - 1, -1, -1):
            ones = ((now >> bit) & 1).astype(bool)
            planes.append(np.packbits(ones))
            after, zeros = np.empty_like(now), len(now) - int(np.count_nonzero(ones))
            np.compress(~ones, now, out=after[:zeros])
            np.compress(ones, now, out=after[zeros:])
            now = after
        return cls(len(values), planes)

    def decode(self) -> np.ndarray:
        """All values: from the order below the last plane, each plane puts them back in place."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.length, kind)
        for bit, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.length).view(bool)
            back = np.empty(self.length, kind)
            back[np.flatnonzero(~ones)], back[np.flatnonzero(ones)] = now[:zeros], now[zeros:] | kind(1 << bit)
            now = back
        return now

    def _rank1(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block = i // STEP
        part = self.planes[level][block * STEP // 8 : -(-i // 8)]
        here = np.unpackbits(part, count=i - block * STEP) if i > block * STEP else np.zeros(0, np.uint8)
        return int(self.ones[level][block]) + int(here.sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def _down(self, level: int, bit: int, i: int) -> int:
        ones = self._rank1(level, i)
        return self.zeros[level] + ones if bit else i - ones

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, i)
            value, i = value << 1 | bit, self._down(level, bit, i)
        return value

    def _range(self, value: int, i: int) -> tuple[int, int]:
        low, high = 0, i
        for level in range(len(self.planes)):
            bit = value >> (len(self.planes) - 1 - level) & 1
            low, high = self._down(level, bit, low), self._down(level, bit, high)
        return low, high

    def rank(self, value: int, i: int) -> int:
        """Uses of ``value`` before place ``i``."""
        low, high = self._range(value, i)
        return high - low

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) ``bit`` of a plane, by the directory and within one step."""
        ones = self.ones[level]
        upto = ones if bit else np.minimum(np.arange(len(ones)) * STEP, self.length) - ones
        block = int(np.searchsorted(upto, k, side="right")) - 1
        part = self.planes[level][block * STEP // 8 : (block + 1) * STEP // 8]
        bits = np.unpackbits(part)[: self.length - block * STEP]
        return block * STEP + int(np.flatnonzero(bits == bit)[k - int(upto[block])])

    def select(self, value: int, k: int) -> int:
        """The place of the k-th use (from 0) of ``value``; IndexError if there are fewer."""
        low, high = self._range(value, self.length)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def to_bytes(self) -> bytes:
        head = np.array([self.length, len(self.planes)], np.uint64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(p.tobytes() for p in self.planes))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        length, depth = (int(x) for x in raw[:16].view(np.uint64))
        return cls(length, list(raw[16:].reshape(depth, -1)) if depth else [])


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it is printed, else one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}


def _white(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to white space."""
    white = _IS_SPACE[data]
    for first, spaces in _LONG_SPACES.items():
        at = np.flatnonzero(data == first)
        for space in spaces if len(at) else ():
            here = at[at + len(space) <= len(data)]
            for i in range(1, len(space)):
                here = here[data[here + i] == space[i]]
            for i in range(len(space)):
                white[here + i] = True
    return white


def _cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start, and the end: a text's start, and every start of white space in it."""
    white = _white(data)
    starts = np.zeros(len(data) + 1, bool)
    np.greater(white[1:], white[:-1], out=starts[1:-1])
    starts[offsets] = True
    return np.flatnonzero(starts).astype(np.int32)


class _Numbers(dict):
    """Numbers new keys in order, and lists those since the last look."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class PieceEncoder:
    """Token ids of whole texts by way of their pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before = told.get("pre_tokenizer") or {}
        self.by_pieces = told.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.known, self.matches = _Numbers(), {}
        self.flat, self.lens, self.offsets = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def trim(self, kept: int = KEPT_PIECES) -> None:
        """Forget all but the pieces that came first."""
        first = _Numbers()
        first.update(islice(self.known.items(), kept))
        self.known, self.matches = first, {}
        self.lens, self.offsets = self.lens[:kept].copy(), self.offsets[:kept].copy()
        self.flat = self.flat[: int(self.lens.sum())].copy()

    def _ids(self, match: str) -> list[int]:
        ids = self.matches.get(match)
        if ids is None:
            if match.isascii() and match.isprintable():  # each letter but the space is itself
                spelt = match.replace(" ", self.space)
            else:
                spelt = match.encode("utf-8").decode("latin-1").translate(self.letters)
            ids = self.matches[match] = [token.id for token in self.tokenizer.model.tokenize(spelt)]
        return ids

    def _learn(self) -> None:
        found, ids_of = [], self._ids
        for piece in map(bytes.decode, self.known.fresh):
            body = piece.rstrip(_STOPS)
            if body[1:].isalpha() and (body[0] == " " or body[0].isalpha()):  # a word, and one match for its stops
                stop = piece[len(body) :]
                found.append(ids_of(body) + ids_of(stop) if stop else ids_of(body))
            else:
                found.append(list(chain.from_iterable(map(ids_of, _MATCH.findall(piece)))))
        self.known.fresh = []
        lens = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lens.sum()))
        self.offsets = np.concatenate([self.offsets, len(self.flat) + np.cumsum(lens, dtype=np.int32) - lens])
        self.flat, self.lens = np.concatenate([self.flat, flat]), np.concatenate([self.lens, lens])

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """For each text its ids."""
        if not self.by_pieces:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if len(self.known) > CACHE_PIECES:
            self.trim()
        collects = gc.isenabled()
        gc.disable()  # nothing here refers in circles, and looking for it takes a tenth of the time
        try:
            return self._encode(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        plain = texts.cast(pa.binary())
        offsets = np.frombuffer(plain.buffers()[1], np.int32)[plain.offset : plain.offset + len(plain) + 1]
        if offsets[0] == offsets[-1]:
            return [np.zeros(0, np.uint32)] * len(texts)
        data = np.frombuffer(plain.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = _cut(data, offsets)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        different = pieces.dictionary.to_pylist()
        numbers = np.fromiter(map(self.known.__getitem__, different), np.int32, len(different))
        if self.known.fresh:
            self._learn()
        at = numbers[pieces.indices.to_numpy()]
        lens = self.lens[at]
        ends = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
        ids = self.flat[np.repeat(self.offsets[at] - ends[:-1], lens) + np.arange(ends[-1])]
        bounds = ends[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _shard(part: int, seq: int, docs: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    ids = np.concatenate([x for _, x in docs])
    present = np.bincount(ids) > 0
    alphabet = np.flatnonzero(present)
    place = np.cumsum(present) - 1
    matrix = WaveletMatrix.build(place[ids], max(1, int(len(alphabet) - 1).bit_length()))
    return pa.RecordBatch.from_pydict({
        "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_tokens": pa.array([len(ids)], pa.int64()),
        "doc_ids": pa.array([[d for d, _ in docs]], pa.list_(pa.int64())), "lens": pa.array([[len(x) for _, x in docs]], pa.list_(pa.int64())),
        "alphabet": pa.array([alphabet], pa.list_(pa.int32())), "matrix": [matrix.to_bytes()],
    })


def _encode(tokenizer: str):
    def encoded(batches) -> Iterator[tuple[int, np.ndarray]]:
        encoder = _encoder(tokenizer)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            before = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
            start = 0
            while start < len(texts):  # some texts at a time, so that long ones don't add up
                stop = max(start + 1, int(np.searchsorted(before, before[start] + CHUNK_BYTES, side="right")) - 1)
                for doc_id, ids in zip(doc_ids[start:stop], encoder.encode(texts.slice(start, stop - start))):
                    yield doc_id, np.concatenate([ids, end])
                start = stop
        encoder.trim()

    def encode(batches):
        from pyspark import TaskContext

        part, seq, docs, total = TaskContext.get().partitionId(), 0, [], 0
        for doc_id, ids in encoded(batches):
            if docs and total + len(ids) > SHARD_TOKENS:
                yield _shard(part, seq, docs)
                seq, docs, total = seq + 1, [], 0
            docs.append((doc_id, ids))
            total += len(ids)
        if docs:
            yield _shard(part, seq, docs)

    return encode


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` with the tokenizer file and write their shards below ``path``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(max(1, -(-total // PARTITION_BYTES)), *order).sortWithinPartitions(*order)
    dealt.mapInArrow(_encode(tokenizer), _FILES).write.mode("overwrite").parquet(path)


def _numbers(alphabet: list[int], matrix: bytes) -> np.ndarray:
    return np.array(alphabet, np.uint32)[WaveletMatrix.from_bytes(matrix).decode()]


def _read(batches):
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            doc_ids, lens, alphabet, matrix, start = row
            ids, ends = _numbers(alphabet, matrix), np.cumsum(lens)
            data = memoryview(ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - lens, pa.int64()),
                "n_tokens": pa.array(lens, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens)], pa.int64()),
            })


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the tokens before each: within its part, and of the parts before."""
    shards = spark.read.schema(_FILES).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = sizes.withColumn("inside", inside).join(parts, "part").select("part", "seq", (F.col("inside") + F.col("before")).alias("start"))
    return shards.join(starts, ["part", "seq"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: where it starts, its length, and the crc32 of its ids."""
    shards = placed(spark, path).select("doc_ids", "lens", "alphabet", "matrix", "start")
    return shards.mapInArrow(_read, _ROWS)


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(place) of every use of a token in the corpus; shards without it aren't opened."""

    def find(batches):
        for batch in batches:
            for alphabet, matrix, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                opened, value = WaveletMatrix.from_bytes(matrix), alphabet.index(token)
                places = [start + opened.select(value, k) for k in range(opened.rank(value, opened.length))]
                yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64())})

    shards = placed(spark, path).filter(F.array_contains("alphabet", token))
    return shards.select("alphabet", "matrix", "start").mapInArrow(find, "place long")
