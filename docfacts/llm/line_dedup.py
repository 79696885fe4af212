"""Line deduplication by pairwise alignment.

A document's lines are hashed where they are; a line is the same as another if the text
without outer white space is. For each line that several documents hold, the first of them
(smallest id, then mark; null ids last) is its owner. A line of ``ANCHOR_WORDS`` words or more
that is rare, in at most ``RARE`` documents, pairs each later document with the owner; the
pairs are aligned by patience diff on all their lines, and runs of aligned lines with
``BLOCK_WORDS`` words or more are deleted from the later document.

An alignment can't see passages without a rare line, passages whose lines each have another
owner, or those that stand in another order. For these the exact way is that of runs: the
shortest runs of lines with ``BLOCK_WORDS`` words, all of them held by several documents, have an
owner by their hash and are deleted from all other documents. So any run of so many words that an
earlier document holds goes, however many documents share it, however short its lines are, and
the number of pairs and runs follows the number of lines.

The first copy of a text always stays: a line is deleted only where an earlier document
holds it with the lines around it.

Nulls: a null text has no lines and stays null; null ids are kept. Rows that repeat an id
and its text are one document and share its result. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.llm.common import WORD
from docfacts.session import computed_once, scratch_dir

RARE = 1000
ANCHOR_WORDS = 3  #: 3 at most, as ``deduplicate`` keeps no higher counts of words beside a line's hash.
BLOCK_WORDS = 10


def _rising(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``places``, ascending in the first number, that ascends in the second."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(places):
        at = bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        tops[at : at + 1], ends[at : at + 1] = [j], [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(places[k])
        k = back[k]
    return out[::-1]


def _by_use(a: list, i: int, k: int, b: list, j: int, m: int) -> list[tuple[int, int]]:
    """Places of the first, second... use of every value in two parts."""
    uses: dict = {}
    for q in range(j, m):
        uses.setdefault(b[q], []).append(q)
    seen: Counter = Counter()
    pairs = []
    for p in range(i, k):
        of = uses.get(a[p], ())
        if seen[a[p]] < len(of):
            pairs.append((p, of[seen[a[p]]]))
        seen[a[p]] += 1
    return pairs


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two sequences, ascending.

    Equal ends are aligned first; then values that occur once in each part, in the longest
    order common to both, divide the rest into parts that are treated alike. In a part without
    such values the k-th use of a value stands for the k-th use in the other.
    """
    aligned, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            aligned.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            aligned.append((k, m))
        if i == k or j == m:
            continue
        left, right = Counter(a[i:k]), Counter(b[j:m])
        place = {b[q]: q for q in range(j, m) if right[b[q]] == 1}
        once = [(p, place[a[p]]) for p in range(i, k) if left[a[p]] == 1 and a[p] in place]
        if not once:
            aligned += _rising(_by_use(a, i, k, b, j, m))
            continue
        for p, q in _rising(once):
            todo.append((i, p, j, q))
            aligned.append((p, q))
            i, j = p + 1, q + 1
        todo.append((i, k, j, m))
    return sorted(aligned)


def common_blocks(early: list[int], late: list[int], words: list[int]) -> list[int]:
    """Places in ``late`` of the lines in aligned runs of enough words; ``words`` are those of its lines."""
    out, run, last = [], [], None
    for i, j in [*patience(early, late), (None, None)]:
        if last is None or i is None or (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[x] for x in run) >= BLOCK_WORDS:
                out += run
            run = []
        run.append(j)
        last = (i, j)
    return out


def _aligned(batches):
    for batch in batches:
        late_id, mark, early, late, words = (batch.column(i).to_pylist() for i in range(5))
        found = []
        for a, b, w in zip(early, late, words):
            # blank lines are no part of the alignment
            own, other = [i for i, n in enumerate(w) if n], [h for h in a if h is not None]
            found.append([own[k] for k in common_blocks(other, [b[i] for i in own], [w[i] for i in own])])
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(late_id, pa.int64()), "mark": pa.array(mark, pa.int64()), "places": pa.array(found, pa.list_(pa.int32())),
        })


def short_runs(hashes: list[int], words: list[int], shared: set[int]) -> list[tuple[int, int]]:
    """(begin, end) of the runs of ``shared`` lines that have enough words and none to spare.

    That is without their last line, or without their first; so the runs inside a passage
    of enough words cover all its lines.
    """
    found = set()
    for at in range(len(hashes)):
        for step in (1, -1):
            k, total = at, 0
            while 0 <= k < len(hashes) and total < BLOCK_WORDS and hashes[k] in shared:
                total += words[k]
                k += step
            if total >= BLOCK_WORDS:
                found.add((at, k) if step == 1 else (k + 1, at + 1))
    return sorted(found)


def _runs(batches):
    """Documents with their shared lines to one row for each run, by its hash."""
    for batch in batches:
        out = []
        for doc_id, mark, hashes, words, shared in zip(*(batch.column(i).to_pylist() for i in range(5))):
            own = [i for i, n in enumerate(words) if n]
            lines = [hashes[i] for i in own]
            known = set(shared)
            held = {h for h, n in zip(hashes, words) if n and (h & ~3 | min(n, 3)) in known}
            for begin, end in short_runs(lines, [words[i] for i in own], held):
                digest = xxhash.xxh3_64_intdigest(np.array(lines[begin:end], np.int64).tobytes())
                out.append((doc_id, mark, digest - 2**63, own[begin:end]))
        columns = list(zip(*out)) or [()] * 4
        types = {"doc_id": pa.int64(), "mark": pa.int64(), "run": pa.int64(), "places": pa.list_(pa.int32())}
        yield pa.RecordBatch.from_pydict({name: pa.array(c, t) for c, (name, t) in zip(columns, types.items())})


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_deleted, text): each document with what is left of it."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "lines")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    lines = F.split("text", "\n", -1)
    trimmed = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
    words = F.transform(lines, lambda line: F.regexp_count(line, F.lit(WORD)))
    hashes = F.transform(lines, lambda line: F.when(line.rlike(WORD), F.xxhash64(F.regexp_replace(line, trimmed, ""))))
    listed = saved(rows.filter("text is not null").select("doc_id", "mark", hashes.alias("hashes"), words.alias("words")), "listed")
    listed_once = listed.dropDuplicates(["doc_id", "mark"])

    # Whole numbers, which are made distinct by hashing; the words of a line stand in the last two bits.
    tagged = F.zip_with("hashes", "words", lambda h, n: h.bitwiseAND(F.lit(~3)).bitwiseOR(F.least(n, F.lit(3)).cast("long")))
    each = listed_once.select("doc_id", "mark", F.explode(F.array_distinct(tagged)).alias("hash")).filter("hash IS NOT NULL")
    each = each.withColumn("n_words", F.col("hash").bitwiseAND(3))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    shared = each.groupBy("hash").agg(F.count("*").alias("in_docs"), F.min(key).alias("owner")).filter("in_docs > 1")
    held = saved(
        each.join(shared, "hash").withColumn("is_later", key > F.col("owner"))
        .select("doc_id", "mark", "hash", "n_words", "in_docs", "is_later", F.col("owner.doc_id").alias("owner_id"), F.col("owner.mark").alias("owner_mark")),
        "held",
    )
    anchors = held.filter(F.col("is_later") & (F.col("in_docs") <= RARE) & (F.col("n_words") >= ANCHOR_WORDS))
    pairs = anchors.select("doc_id", "mark", "owner_id", "owner_mark").distinct()

    def beside(pairs: DataFrame, id_name: str, mark_name: str, columns: dict[str, str]) -> DataFrame:
        own = listed_once.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), *[F.col(c).alias(n) for c, n in columns.items()])
        return pairs.join(own, F.col(id_name).eqNullSafe(F.col("_id")) & (F.col(mark_name) == F.col("_mark"))).drop("_id", "_mark")

    both = beside(beside(pairs, "owner_id", "owner_mark", {"hashes": "early"}), "doc_id", "mark", {"hashes": "late", "words": "late_words"})
    aligned = both.select("doc_id", "mark", "early", "late", "late_words").mapInArrow(_aligned, "doc_id long, mark long, places array<int>")
    aligned = aligned.filter(F.size("places") > 0).select("doc_id", "mark", F.explode("places").alias("place"))

    common = held.groupBy("doc_id", "mark").agg(F.collect_set("hash").alias("shared"))
    common = beside(common, "doc_id", "mark", {"hashes": "hashes", "words": "words"}).select("doc_id", "mark", "hashes", "words", "shared")
    runs = saved(common.mapInArrow(_runs, "doc_id long, mark long, run long, places array<int>"), "runs")
    first = runs.groupBy("run").agg(F.min(key).alias("owner"))
    again = runs.join(first, "run").filter(key > F.col("owner")).select("doc_id", "mark", F.explode("places").alias("place"))
    gone = aligned.unionByName(again).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("place")).alias("places"))

    gone = saved(gone, "gone").withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    joined = computed_once(joined, {"_lines": lines})
    # What is left lies between the places: a slice for each of them, so the work follows the lines.
    lines, ends = F.col("_lines"), F.col("_ends")
    joined = computed_once(joined, {"_ends": F.concat("places", F.array(F.size(lines)))})
    before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(-1)
    left = F.flatten(F.transform(ends, lambda end, i: F.slice(lines, before(i) + 2, end - before(i) - 1)))
    left = F.when(F.col("_mark").isNull(), lines).otherwise(left)
    return joined.select(
        "doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias("n_deleted"),
        F.array_join(left, "\n").alias("text"),
    )
