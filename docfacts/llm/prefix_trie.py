"""Prefix trie of rebuilt conversations by composable monoid fingerprints.

Conversation c takes its first h(c) turns from a base conversation and goes on with its own
turns after its first h(c). No rebuilt text is ever put together. A turn is hashed once, where
it is stored. A sequence t1..tn has the fingerprint (n, t1*B + t2*B^2 + ... + tn*B^n) modulo
each of four primes of 31 bits, and two sequences have the product (n + m, F + B^n * G): prefixes
of stored turns are running sums, and a rebuilt prefix is the product of a prefix of the base
and a stretch of the own turns, taken from the running sums and two small powers.

A node is a depth and a fingerprint. Each member refers to the stored turn it ends with, whose
SHA-256 (120 bits of it) is kept beside the reference; members of one node must agree in it and
in their parent's fingerprint, which proves by induction over depth that the prefixes are equal.
Where they don't, the whole is done again with the next base, so no result rests on luck.

Totals of subtrees need no walk through the tree. Let the smallest member of a node own it: the
nodes a conversation owns are a chain that ends at its last turn. What lies below a node is then
all that its members own from its depth on: the sum over its members of what each owns, but for
the owner only from that depth on, a running sum over its chain. Leaves are counted alike.

Scale: rows are numbers only (about 80 bytes for a turn). Members of a node are never gathered;
all of it is sums, with partial sums before the shuffle, so a node that all conversations pass
costs a row per task. Where nodes meet their parent, the parents with most children (above a
thousandth of all, a thousand at most) are broadcast and the others joined. The ids of the
conversations that end at a node are hashed as a sorted stream. A conversation's own turns are
numbered in one task, as sums along a sorted, spilling stream.

Defined results: rows without conv_id are no conversation; null role and text are empty; turns
of equal number go by role, then by their hash; repeated rows are turns of their own; an absent
base gives no turns; an empty table gives no node, not even the root. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfacts.session import scratch_dir

#: The largest primes below 2 ** 31, and how conversations are rebuilt.
MODULI = (2147483647, 2147483629, 2147483587, 2147483579)
GROUP, HEADS = 100, 6
#: Powers are looked up by digits of 6 bits: conversations of up to 2 ** 30 turns.
DIGIT_BITS, DIGITS = 6, 5
KEY = ["depth", "f1", "f2"]
PARENT_SHARE = 1000


def base_of(seed: int, modulus: int) -> int:
    """The B of a modulus: a number from the seed."""
    return 2 + int.from_bytes(hashlib.sha256(f"{seed}:{modulus}".encode()).digest()[:8], "big") % (modulus - 3)


def power(base: int, modulus: int, exponent: Column) -> Column:
    """``base`` to a non-negative exponent, by one factor for each digit of it."""
    result = F.lit(1).cast("long")
    for place in range(DIGITS):
        step = pow(base, 1 << (DIGIT_BITS * place), modulus)
        table = F.array(*[F.lit(pow(step, d, modulus)).cast("long") for d in range(1 << DIGIT_BITS)])
        digit = F.shiftright(exponent, DIGIT_BITS * place).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")
        result = result * F.get(table, digit) % modulus
    return result


def digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the length of the role keeps role and text apart."""
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _number(hexadecimal: Column, start: int) -> Column:
    return F.conv(F.substring(hexadecimal, start, 15), 16, 10).cast("long")


def _packed(values: list[Column]) -> tuple[Column, Column]:
    """Four numbers of 31 bits in two."""
    return tuple(F.shiftleft(values[i], 31) + values[i + 1] for i in (0, 2))


def stored_turns(conversations: DataFrame, seed: int, moduli=MODULI) -> DataFrame:
    """Every stored turn: its place, hash and size, and the running sums of its conversation.

    ``s`` sums the terms from the first turn on, ``u`` those after the first ``h``.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.length(text).alias("size"), digest(role, text).alias("digest"),
    )
    turns = turns.select("conv_id", "turn", "role", "size", _number(F.col("digest"), 1).alias("d1"), _number(F.col("digest"), 16).alias("d2"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "d1", "d2")
    placed = turns.withColumn("place", F.row_number().over(order).cast("long")).withColumn(
        "h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int")
    )
    terms = {
        f"t{k}": F.pmod(F.xxhash64("d1", "d2", F.lit(k)), F.lit(p)) * power(base_of(seed, p), p, F.col("place")) % p
        for k, p in enumerate(moduli)
    }
    up_to_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"s{k}": F.sum(f"t{k}").over(up_to_here) % p for k, p in enumerate(moduli)}
    after = {k: F.when(F.col("place") > F.col("h"), F.col(f"t{k}")).otherwise(0) for k in range(len(moduli))}
    sums |= {f"u{k}": F.sum(after[k]).over(up_to_here) % p for k, p in enumerate(moduli)}
    return placed.withColumns(terms).withColumns(sums).drop("turn", "role")


def members(conversations: DataFrame, seed: int = 0, moduli=MODULI) -> DataFrame:
    """A row for every conversation and depth: the node it is in, that of its parent, the stored
    turn it ends with (``ref_conv``, ``ref_place``, counted from 1) and whether it ends there."""
    own = stored_turns(conversations, seed, moduli)
    numbered = list(enumerate(moduli))
    per_turn = [f"{x}{k}" for x in "ts" for k, _ in numbered]
    heads = (
        own.filter((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "size", "d1", "d2", *per_turn))).alias("head"))
    )
    known = (
        own.groupBy("conv_id")
        .agg(F.max("place").alias("n_own"), F.max("h").alias("h"))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
        .join(heads, "base", "left")
        .withColumn("head", F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1)))))
        .withColumn("n_head", F.coalesce(F.array_size("head"), F.lit(0)).cast("long"))
        .withColumn("length", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    )
    zero = F.lit(0).cast("long")
    root = known.select(
        "conv_id", zero.alias("depth"), *[zero.alias(c) for c in ("f1", "f2", "p1", "p2", "d1", "d2")],
        F.lit(0).alias("size"), zero.cast("long").alias("ref_conv"), zero.alias("ref_place"), (F.col("length") == 0).alias("ends"),
    )

    def row(frame: DataFrame, depth, fingerprint, term, ref_conv, place) -> DataFrame:
        before = [F.pmod(f - t, F.lit(p)) for f, t, (_, p) in zip(fingerprint, term, numbered)]
        return frame.select(
            "conv_id", depth.alias("depth"),
            *[c.alias(n) for n, c in zip(("f1", "f2", "p1", "p2"), (*_packed(fingerprint), *_packed(before)))],
            "d1", "d2", "size", ref_conv.alias("ref_conv"), place.alias("ref_place"), (depth == F.col("length")).alias("ends"),
        )

    from_base = known.select("conv_id", "base", "length", F.inline("head"))
    from_base = row(
        from_base, F.col("place"), [F.col(f"s{k}") for k, _ in numbered], [F.col(f"t{k}") for k, _ in numbered],
        F.col("base"), F.col("place"),
    )
    last = F.get(F.col("head"), (F.col("n_head") - 1).cast("int"))
    joint = known.select(
        "conv_id", "n_head", "length", *[F.coalesce(last[f"s{k}"], zero).alias(f"b{k}") for k, _ in numbered]
    )
    suffix = own.filter(F.col("place") > F.col("h")).join(joint, "conv_id")
    # The own turns move forward by the turns that the base lacks: at most HEADS - 1.
    lacking = (F.col("h") - F.col("n_head")).cast("int")
    shift = [
        F.get(F.array(*[F.lit(pow(pow(base_of(seed, p), -1, p), n, p)).cast("long") for n in range(HEADS)]), lacking)
        for _, p in numbered
    ]
    moved = [F.col(f"u{k}") * shift[k] % p for k, p in numbered]
    term = [F.col(f"t{k}") * shift[k] % p for k, p in numbered]
    product = [(F.col(f"b{k}") + moved[k]) % p for k, p in numbered]
    from_own = row(suffix, F.col("place") - lacking, product, term, F.col("conv_id"), F.col("place"))
    return root.unionByName(from_base).unionByName(from_own)


def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, from a stream sorted by node and id."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for *at, conv in zip(*(column.to_pylist() for column in batch.columns)):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*KEY, "ends_sha256"])
                done = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], [*KEY, "ends_sha256"])

    sorted_rows = rows.filter("ends").select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return sorted_rows.mapInArrow(digests, "depth long, f1 long, f2 long, ends_sha256 string")


def _nodes(rows: DataFrame) -> DataFrame:
    """One row for each node, from its members."""
    same = [f"{end}({c}) AS {end}_{c}" for c in ("d1", "d2", "p1", "p2") for end in ("min", "max")]
    return rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if("ends").alias("n_ends"),
        F.max("size").alias("size"), *[F.expr(e) for e in same],
    )


def verified(conversations: DataFrame, folder: str, seed: int = 0, moduli=MODULI) -> tuple[DataFrame, DataFrame]:
    """Members and nodes, written below ``folder``, in which all members of a node agree."""
    spark = conversations.sparkSession
    while True:
        members(conversations, seed, moduli).write.parquet(f"{folder}/members-{seed}")
        rows = spark.read.parquet(f"{folder}/members-{seed}")
        owned = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
        worth = (F.col("n_convs") - 1) * F.col("size")
        _nodes(rows).withColumns(
            {
                "below": F.sum(worth).over(owned.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                # The nodes a conversation owns follow one another; what is above the first is its parent's.
                "goes_on": F.coalesce(F.lag("depth").over(owned) == F.col("depth") + 1, F.lit(False)),
                "on_top": F.coalesce(F.lead("depth").over(owned) != F.col("depth") - 1, F.lit(True)),
                "agree": F.expr(" AND ".join(f"min_{c} = max_{c}" for c in ("d1", "d2", "p1", "p2"))),
            }
        ).select(*KEY, "conv_id", "n_convs", "n_ends", "size", "below", "goes_on", "on_top", "agree",
                 F.col("min_p1").alias("p1"), F.col("min_p2").alias("p2")).write.parquet(f"{folder}/nodes-{seed}")
        nodes = spark.read.parquet(f"{folder}/nodes-{seed}")
        if nodes.filter("NOT agree").isEmpty():
            return rows, nodes
        seed += 1


def trie(conversations: DataFrame, seed: int = 0, moduli=MODULI) -> DataFrame:
    """A row for every node of the trie."""
    spark = conversations.sparkSession
    folder = scratch_dir(spark, "trie")
    rows, nodes = verified(conversations, folder, seed, moduli)
    leaf = F.col("n_ends") == F.col("n_convs")
    # What a conversation owns: the total of its chain stands at the chain's top.
    owns = nodes.groupBy("conv_id").agg(F.max("below").alias("owned"), F.max(leaf.cast("int")).alias("leaf"))
    owns = owns.filter((F.col("owned") > 0) | (F.col("leaf") > 0))
    zero = F.lit(0).cast("long")
    nothing = {c: F.lit(None).cast("long") for c in ("conv_id", "n_convs", "n_ends", "p1", "p2", "below", "on_top")}
    parts = [
        nodes.select(*KEY, "conv_id", "n_convs", "n_ends", "p1", "p2", "below", F.col("on_top").cast("long").alias("on_top"),
                     F.col("goes_on").cast("long").alias("children"), zero.alias("tops"), zero.alias("owned"), zero.alias("leaves")),
        nodes.filter("on_top AND depth > 0").select(
            (F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"),
            F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("tops"), zero.alias("owned"), zero.alias("leaves"),
        ).withColumns(nothing),
        rows.select(*KEY, F.col("conv_id").alias("member")).join(owns.withColumnRenamed("conv_id", "member"), "member").select(
            *KEY, zero.alias("children"), zero.alias("tops"), "owned", F.col("leaf").cast("long").alias("leaves")
        ).withColumns(nothing),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in nothing], *[F.sum(c).alias(c) for c in ("children", "tops", "owned", "leaves")]
    ).write.parquet(f"{folder}/summed")
    summed = spark.read.parquet(f"{folder}/summed")

    # The owner's share of ``owned`` counts from the node's depth on only.
    own_total = nodes.groupBy("conv_id").agg(F.max("below").alias("own_total"))
    tops = summed.filter("on_top = 1 AND depth > 0").select(
        *KEY, "conv_id", (F.col("depth") - 1).alias("parent_depth"), "p1", "p2"
    )
    many = tops.count() // PARENT_SHARE
    parents = summed.filter("tops > 0").select(
        F.col("depth").alias("parent_depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "tops",
    )
    at = ["parent_depth", "p1", "p2"]
    # No more than PARENT_SHARE parents can have more than that share of all tops.
    busy = F.broadcast(parents.filter(F.col("tops") > many).withColumnRenamed("parent_conv_id", "_busy").drop("tops"))
    sought = tops.join(busy, at, "left")
    found = sought.filter("_busy IS NOT NULL").select(*KEY, F.col("_busy").alias("parent_conv_id")).unionByName(
        sought.filter("_busy IS NULL").drop("_busy").join(parents.filter(F.col("tops") <= many), at, "left").select(*KEY, "parent_conv_id")
    )
    nobody = hashlib.sha256(b"").hexdigest()
    return (
        summed.join(own_total, "conv_id")
        .join(found, KEY, "left")
        .join(_ends(rows), KEY, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("on_top") == 1, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            (F.col("owned") - F.col("own_total") + F.col("below")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
        )
    )
