"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A topology places every shard in a rack and every rack in a region; a node weighs as much as
the shards below it. A row descends from the root: among the children of a node, each with
draw ``u`` in (0, 1) from the MD5 of seed, child and key, the one with the smallest
``-ln(u) / weight`` wins. A draw depends on its own child alone, so a child's share is its
weight, and after a change of weights the only rows that move are those that enter or leave a
subtree whose weight changed. ``extended`` puts a further shard into a region of its own:
that region is then the only changed subtree, and all rows that move go to the new shard.

The law of ``layout`` is ``key``: document id and number of shards decide. Slots number the
rows of a shard without gaps, by (bucket, id, size, checksum), where the bucket is the
beginning of an MD5 of these. Rows that agree in them are counted first and numbered as one
group, so that neither a hot id nor repeated rows meet in one task; buckets are numbered on
their own and begin after the rows of the buckets before them, a table of one row for each
shard and bucket.

Defined results: a null or empty text has size 1 and checksum 0; a null id is the key of empty
text, ordered last; repeated rows get a slot each; an empty table gives no rows. Other columns
of the input take no part in ``layout``; ``assign`` keeps them and replaces one of its own name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfacts.llm.copies import expanded
from docfacts.session import scratch_dir

#: Draws are the first 13 hexadecimal digits of an MD5: 52 bits, exact in a double.
DIGITS = 13
SEED = "tree"
#: Hexadecimal digits of a bucket: each shard is numbered in 16 ** BUCKET_DIGITS parts.
BUCKET_DIGITS = 3
RACK_SHARDS, REGION_SHARDS = 2, 4
#: Shards that a tree is built with; later ones are added one by one.
BUILT = 8


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def topology(n_shards: int, built: int = BUILT) -> list[Shard]:
    """Shards of equal weight: ``built`` ones at most, two to a rack and two racks to a region,
    and from there on each in a region of its own, so that one more takes rows only into itself."""
    shards = [Shard(i, f"region{i // REGION_SHARDS}", f"rack{i // RACK_SHARDS}") for i in range(min(n_shards, built))]
    for _ in range(n_shards - built):
        shards = extended(shards)
    return shards


def extended(shards: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, alone in a new region."""
    number = max((s.number for s in shards), default=-1) + 1
    return [*shards, Shard(number, f"region-of-{number}", f"rack-of-{number}", weight)]


def tree(shards: Sequence[Shard]) -> dict[str, list[tuple[str, float, int]]]:
    """The children of every node as (path, weight, shard number or -1), by path."""
    if not shards or len({s.number for s in shards}) < len(shards) or min(s.weight for s in shards) <= 0:
        raise ValueError("a topology needs shards with different numbers and positive weights")
    nodes: dict[str, dict[str, list]] = {}
    for s in shards:
        path = ""
        for name, number in ((s.region, -1), (s.rack, -1), (f"shard{s.number}", s.number)):
            child = nodes.setdefault(path, {}).setdefault(f"{path}/{name}", [0.0, number])
            child[0] += s.weight
            path = f"{path}/{name}"
    return {node: sorted((c, w, n) for c, (w, n) in children.items()) for node, children in nodes.items()}


def draw(key: Column, child: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) for a key at a child."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), child, F.lit(":"), key)), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))


def shard_of(key: Column, shards: Sequence[Shard], seed: str = SEED) -> Column:
    """The shard of a key, a text."""
    children = F.create_map(*[
        part
        for node, below in tree(shards).items()
        for part in (
            F.lit(node),
            F.array(*[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight"), F.lit(n).alias("number")) for c, w, n in below]),
        )
    ])
    here = F.lit("")
    for _ in ("region", "rack", "shard"):
        scored = F.transform(
            F.element_at(children, here if isinstance(here, Column) else F.lit(here)),
            lambda c: F.struct((-F.ln(draw(key, c["path"], seed)) / c["weight"]).alias("score"), c["path"], c["number"]),
        )
        chosen = F.array_min(scored)
        here = chosen["path"]
    return chosen["number"]


def key_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def assign(docs: DataFrame, shards: Sequence[Shard], key: str = "doc_id", column: str = "shard") -> DataFrame:
    """``docs`` with the shard of every row. No shuffle."""
    return docs.withColumn(column, shard_of(key_of(F.col(key)), shards))


def write(docs: DataFrame, shards: Sequence[Shard], path: str, key: str = "doc_id") -> None:
    """The rows in a folder for each shard (``shard=0`` and so on); files are balanced by size."""
    assign(docs, shards, key).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def layout(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    now = topology(n_shards)
    text = F.coalesce(F.col("text"), F.lit(""))
    what = ("doc_id", "size", "text_crc32")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    counted = rows.groupBy(*what).agg(F.count("*").alias("n"))
    key = key_of(F.col("doc_id"))
    named = F.concat_ws(":", key, F.col("size").cast("string"), F.col("text_crc32").cast("string"))
    path = scratch_dir(docs.sparkSession, "shards")
    counted.select(
        *what,
        "n",
        shard_of(key, now).alias("shard"),
        shard_of(key, extended(now)).alias("grown_shard"),
        F.substring(F.md5(named), 1, BUCKET_DIGITS).alias("bucket"),
    ).write.parquet(path)
    groups = docs.sparkSession.read.parquet(path)

    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        groups.groupBy("shard", "bucket")
        .agg(F.sum("n").alias("_n"))
        .select("shard", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy("shard", "bucket")
        .orderBy(F.col("doc_id").asc_nulls_last(), "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row for each shard and bucket: 32,768 for eight shards, at any size of the input.
    placed = groups.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        F.broadcast(starts), ["shard", "bucket"]
    )
    first = placed.withColumn("_first", F.col("_start") + F.col("_inside"))
    return expanded(first, "n", "_first", "slot").select(
        *what, F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
