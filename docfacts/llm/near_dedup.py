"""Near-duplicate classes from ProbMinHash signatures of weighted word shingles.

A text's shingles are its runs of ``SHINGLE`` words, weighted by how often they occur.
Each shingle's arrivals are a Poisson process of that rate, seeded by the shingle; an
arrival lands in a random register, which keeps the earliest. A process ends once its
time is past every register of the text. Two texts share a register's shingle with their
probability Jaccard similarity, which for unweighted shingles is the Jaccard similarity.

Texts with the same shingles are one node from the start. ``BANDS`` bands of ``ROWS``
registers bring nodes together; each bucket then compares its members with one hub, the
member that shares most buckets, on the exact shingles. Where a bucket's members are still
in several classes, they get a longer signature with ``FINE_BANDS`` bands of ``FINE_ROWS``
registers, which brings pairs of 0.8 together as surely and others far more rarely; those
of different classes that meet there are compared too, on that signature where they meet
and then on the exact shingles. A large bucket is compared in blocks of ``BLOCK_MEMBERS``
members against each other. So no pair is left out for the size of a bucket, and only
pairs that are like each other leave it.

Linked: an exact similarity, probability Jaccard or plain Jaccard, of ``SIMILAR`` or more.
A class is a connected component; its id is its smallest document id.

Nulls and texts without words form one class. Shorter texts are one shingle. Null ids are
kept and get their class's id (null if all are). Repeated rows each get a row. Words are
compared without regard to the case of A-Z.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import mix, pack, pack_sorted, rows_in_blocks, runs, unpack, unpack_sorted, utf8
from docfacts.session import scratch_dir

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 6
REGISTERS = BANDS * ROWS
FINE_BANDS = 180
FINE_ROWS = 14
BLOCK_MEMBERS = 512
#: Four bits are kept of each register of the longer signature; one in sixteen agrees by chance.
_CHANCE = 1 / 16
_EXPECTED = SIMILAR + (1 - SIMILAR) * _CHANCE
#: A share of equal registers below this, four standard deviations, is not followed up.
LEAST_EQUAL = _EXPECTED - 4 * (_EXPECTED * (1 - _EXPECTED) / (FINE_BANDS * FINE_ROWS)) ** 0.5

_BLOCK_CHARS = 1_000_000
_HASH_BITS = 44
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def weighted_shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight), by text and hash."""
    numbers, pieces = defaultdict(count().__next__), []
    for text in texts:
        words = utf8(text).lower().split()
        pieces.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), np.uint64, len(numbers))
    lens = np.array([len(p) for p in pieces], np.int64)
    seq = hashes[np.concatenate(pieces)] if lens.sum() else np.zeros(0, np.uint64)
    padded = np.concatenate([seq, np.zeros(SHINGLE, np.uint64)])
    many = np.where(lens > 0, np.maximum(lens - SHINGLE + 1, 1), 0)
    starts = np.repeat(np.cumsum(lens) - lens, many) + runs(many)
    owner = np.repeat(np.arange(len(lens)), many)
    mixed = np.zeros(len(starts), np.uint64)
    for i in range(SHINGLE):
        word = padded[starts + i]
        short = lens[owner] <= i
        mixed += np.where(short, np.uint64(0), word * _SPREAD[i])
    mixed = mix(mixed) >> np.uint64(64 - _HASH_BITS)
    keys, weight = np.unique((owner.astype(np.uint64) << np.uint64(_HASH_BITS)) | mixed, return_counts=True)
    return (keys >> np.uint64(_HASH_BITS)).astype(np.int64), keys & np.uint64((1 << _HASH_BITS) - 1), weight


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """n x registers shingle hashes: for each register, the shingle that arrives first."""
    first = np.full(n * registers, np.inf)
    events, time, turn = [], np.zeros(len(owner)), 0
    alive = np.arange(len(owner))
    while len(alive):
        draw = mix(shingle[alive] + np.uint64((turn * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        time[alive] -= np.log(uniform) / weight[alive]
        last = first.reshape(n, registers).max(axis=1)
        alive, kept = (x[time[alive] < last[owner[alive]]] for x in (alive, draw))
        register = owner[alive] * registers + (mix(kept + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, register, time[alive])
        better = time[alive] <= first[register]
        events.append((register[better], time[alive][better], shingle[alive][better]))
        turn += 1
    out = np.zeros(n * registers, np.uint64)
    for register, at, what in events:
        won = first[register] == at
        out[register[won]] = what[won]
    return out.reshape(n, registers)


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """n x bands hashes of ``rows`` registers each."""
    out = np.zeros((len(found), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + found[:, i::rows])
    return out.view(np.int64)


def _sign(batches):
    for rows in rows_in_blocks(batches, lambda r: len(r[1] or ""), _BLOCK_CHARS):
        n = len(rows)
        owner, shingle, weight = weighted_shingles([r[1] for r in rows])
        content = np.zeros(n, np.uint64)
        np.add.at(content, owner, mix(shingle * np.uint64(0x9E3779B97F4A7C15) + weight.astype(np.uint64)))
        found = signatures(owner, shingle, weight, n)
        bands = band_keys(found, BANDS, ROWS)
        some = np.bincount(owner, minlength=n) > 0
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "content": content.view(np.int64),
            "mark": pa.array([r[2] for r in rows], pa.int64()),
            "bands": pa.array([b if s else [] for b, s in zip(bands, some)], pa.list_(pa.int64())),
        })


def _shingled(batches):
    for rows in rows_in_blocks(batches, lambda r: len(r[1] or ""), _BLOCK_CHARS):
        owner, shingle, weight = weighted_shingles([r[1] for r in rows])
        cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
        yield pa.RecordBatch.from_pydict({
            "content": pa.array([r[0] for r in rows], pa.int64()),
            "shingles": [pack_sorted(shingle[a:b]) for a, b in zip(cuts, cuts[1:])],
            "weights": [pack(weight[a:b].astype(np.uint32)) for a, b in zip(cuts, cuts[1:])],
        })


def _fine(batches):
    """Packed shingles to the longer signature: its bands, and four bits of each register."""
    for rows in rows_in_blocks(batches, lambda r: len(r[1]), 200_000):
        parts = [(unpack_sorted(s), unpack(w, np.uint32)) for _, s, w in rows]
        owner = np.repeat(np.arange(len(parts)), [len(s) for s, _ in parts])
        shingle, weight = (np.concatenate([p[i] for p in parts]) for i in range(2))
        found = signatures(owner, shingle, weight, len(parts), FINE_BANDS * FINE_ROWS)
        bits = (mix(found) & np.uint64(15)).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({
            "content": pa.array([r[0] for r in rows], pa.int64()),
            "bands": pa.array(list(band_keys(found, FINE_BANDS, FINE_ROWS)), pa.list_(pa.int64())),
            "sig": [x.tobytes() for x in bits[:, ::2] | bits[:, 1::2] << 4],
        })


def probability_jaccard(a, x, b, y) -> float:
    """Of hashes ``a`` with weights ``x`` and ``b`` with ``y``, both ascending.

    Each shared element d adds 1 / sum over e of max(x_e / x_d, y_e / y_d). Sorted by
    x_e / y_e, the elements whose x side counts for d are those from d's own ratio on.
    """
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    every = np.union1d(a, b)
    u, v = np.zeros(len(every)), np.zeros(len(every))
    u[np.searchsorted(every, a)], v[np.searchsorted(every, b)] = x, y
    ratio = np.where(v > 0, u / np.where(v > 0, v, 1), np.inf)
    order = np.argsort(ratio)
    ordered, upto_v = ratio[order], np.concatenate([[0], np.cumsum(v[order])])
    upto_u = np.concatenate([[0], np.cumsum(u[order])])
    xd, yd = x[i].astype(float), y[j].astype(float)
    k = np.searchsorted(ordered, xd / yd)
    return float((1 / ((upto_u[-1] - upto_u[k]) / xd + upto_v[k] / yd)).sum())


def similarity(a, x, b, y) -> float:
    """The larger of probability Jaccard and plain Jaccard."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return max(probability_jaccard(a, x, b, y), shared / max(1, len(a) + len(b) - shared))


def _compare(batches):
    for batch in batches:
        left, right, *sides = (batch.column(i).to_pylist() for i in range(6))
        exact = [
            similarity(unpack_sorted(s), unpack(w, np.uint32), unpack_sorted(t), unpack(v, np.uint32))
            for s, w, t, v in zip(*sides)
        ]
        yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64()), "similarity": pa.array(exact, pa.float64())})


def _alike(part: pa.Table) -> pa.Table:
    """The pairs of members of different classes whose longer signatures agree enough; see ``_in_blocks``."""
    content, label, own = (part[c].to_numpy() for c in ("content", "label", "own"))
    low, high = part["low"][0].as_py(), part["high"][0].as_py()
    packed = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint8).reshape(len(content), -1)
    sig = np.concatenate([packed & 15, packed >> 4], axis=1)
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(own == low):
        rest = np.flatnonzero((own == high) & (label != label[i]) & ((content > content[i]) | (low != high)))
        near = rest[(sig[rest] == sig[i]).mean(axis=1) >= LEAST_EQUAL]
        out += [(min(content[i], c), max(content[i], c)) for c in content[near]]
    left, right = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _in_blocks(met: DataFrame) -> DataFrame:
    """(a, b) of (band, n, content, label, sig): a bucket of n members is dealt to pairs of blocks by hash."""
    blocks = F.ceil(F.col("n") / BLOCK_MEMBERS)
    met = met.withColumn("own", F.pmod(F.xxhash64("content"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    pairs = met.groupBy("band", "low", "high").applyInArrow(_alike, "a long, b long")
    return pairs.distinct()


def _beside(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with ``columns`` of both their nodes."""
    for side in ("a", "b"):
        own = table.select(F.col("content").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *[f"{c}_{side}" for side in ("a", "b") for c in columns])


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): the smallest node of each component.

    Rounds of the smallest neighbouring label, then of the label's label; each is written.
    """
    spark = edges.sparkSession
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both.distinct().write.parquet(f"{folder}/edges")
    both = spark.read.parquet(f"{folder}/edges")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))
    turn, changed = 0, True
    while changed:
        labels.write.parquet(f"{folder}/labels-{turn}")
        labels = spark.read.parquet(f"{folder}/labels-{turn}")
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("label"))
        upper = step.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        following = step.join(upper, "label", "left").select("node", F.least("label", "upper").alias("label"))
        following.write.parquet(f"{folder}/step-{turn}")
        following = spark.read.parquet(f"{folder}/step-{turn}")
        changed = not following.join(labels, ["node", "label"], "left_anti").isEmpty()
        labels, turn = following, turn + 1
    return labels


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, label), one row for each document; the mark is a hash of its text."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "near")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), mark.alias("mark"))
    signed = saved(source.mapInArrow(_sign, "doc_id long, content long, mark long, bands array<long>"), "signed")
    nodes = signed.groupBy("content").agg(F.min_by(F.struct("mark", "bands"), "mark").alias("x")).select("content", "x.*")
    buckets = nodes.select("content", F.explode("bands").alias("band"))
    several = buckets.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared = saved(buckets.join(several, "band"), "shared")
    central = shared.groupBy("content").agg(F.sum("n").alias("centre"))
    hubs = shared.join(central, "content").groupBy("band").agg(F.max_by("content", F.struct("centre", "content")).alias("hub"))
    spokes = saved(shared.select("band", "content").join(hubs, "band"), "spokes")
    star = saved(spokes.filter("content <> hub").select(F.col("content").alias("a"), F.col("hub").alias("b")).distinct(), "star")

    wanted = spokes.select("content").distinct()
    marked = saved(nodes.select("content", "mark").join(wanted, "content", "left_semi"), "marked")
    # the same plan at every size: few nodes would else be broadcast on small tables only
    texts = source.select("mark", "text").join(marked.select("mark", "content").hint("merge"), "mark").dropDuplicates(["content"])
    shingled = saved(texts.select("content", "text").mapInArrow(_shingled, "content long, shingles binary, weights binary"), "shingled")

    def compared(pairs: DataFrame) -> DataFrame:
        return _beside(pairs, shingled, ["shingles", "weights"]).mapInArrow(_compare, "a long, b long, similarity double")

    measured = saved(compared(star), "measured")
    links = measured.filter(F.col("similarity") >= SIMILAR).select("a", "b")
    labels = components(links, f"{folder}/first")

    labels_of = labels.withColumnRenamed("node", "content")
    members = spokes.select("band", "content").join(labels_of, "content", "left").select("band", "content", F.coalesce("label", "content").alias("label"))
    mixed = members.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("band")
    unsettled = members.join(mixed, "band", "left_semi").select("content", "label").distinct()
    fine = shingled.join(unsettled.select("content"), "content", "left_semi").select("content", "shingles", "weights")
    fine = saved(fine.mapInArrow(_fine, "content long, bands array<long>, sig binary").join(unsettled, "content"), "fine")
    buckets = fine.select("content", "label", F.explode("bands").alias("band"))
    mixed = buckets.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    met = saved(buckets.join(mixed.filter("low < high").select("band", "n"), "band"), "met")
    promising = saved(_in_blocks(met.join(fine.select("content", "sig"), "content")), "promising")
    more = compared(promising).filter(F.col("similarity") >= SIMILAR).select("a", "b")
    labels = components(links.unionByName(more), f"{folder}/second")

    rows = signed.select("doc_id", "mark", "content").join(labels.withColumnRenamed("node", "content"), "content", "left")
    return saved(rows.select("doc_id", "mark", F.coalesce("label", "content").alias("label")), "labelled")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, class_size), one row for each document."""
    rows = labelled(docs, id_col, text_col)
    sizes = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(sizes, "label").select("doc_id", "class_id", "class_size")


def kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (nulls last), then mark."""
    rows = labelled(docs, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = rows.groupBy("label").agg(F.min(order).alias("first")).select("first.doc_id", "first.mark").distinct()
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    same = docs[id_col].cast("long").eqNullSafe(first["doc_id"]) & (mark == first["mark"])
    name = "_mark"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    chosen = docs.join(first, same, "left_semi").withColumn(name, mark)
    return chosen.dropDuplicates([id_col, name]).drop(name)
