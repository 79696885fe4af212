"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a document is addressed by the SHA-256 of its text. The ledger holds,
for each blob and each version of the rules, whether it was scanned and what was found.
A run scans only blobs that the ledger lacks under the present version, adds them, and
joins findings back to all paths that carry the blob. Copies are scanned once.

A rule's version is the hash of its pattern and limits, so a changed rule is a new pair.
The spans are code points, end exclusive. A blob's positions come from the pieces between
its matches, so no position is searched for twice.

Nulls: a null text is the empty text; null ids are kept. Repeated rows each get a row.
An empty table gives no rows. Matches of one rule don't overlap; those of several may.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kind, what a text must hold to be searched, pattern, group that is
# measured, characters that it must have.
RULES = (
    ("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
     r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12}", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32}", r"[0-9a-f]{32,}", 0, 32),
    ("hub", r"gh[pousr]_[A-Za-z0-9]{36}", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10}", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+", 0, 30),
    ("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END [A-Z ]*PRIVATE KEY-----", 0, 50),
)
BASE = ("assign", "access", "hex")

#: Matches that are walked through at a time.
BLOCK = 128
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def rule_version(rules=RULES) -> Column:
    return F.sha2(F.lit(repr(rules)), 256)


def _span(start: Column, kind: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, number: int, rule: tuple) -> Column:
    """The spans of one rule: each match begins after all pieces and matches before it."""
    _, needs, pattern, group, least = rule
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), group), F.length)
    steps = F.zip_with(
        F.transform(matches, F.length), F.slice(pieces, 1, F.size(matches)),
        lambda m, before: F.struct(before.alias("before"), m.alias("length")),
    )
    steps = F.zip_with(
        steps, measured, lambda s, n: F.struct(s["before"].alias("before"), s["length"].alias("length"), n.alias("n"))
    )

    def walk(block: Column) -> Column:
        """Where a block of matches ends, and its spans, counted from its own beginning."""
        return F.aggregate(
            block,
            F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found")),
            lambda acc, s: F.struct(
                (acc["at"] + s["before"] + s["length"]).alias("at"),
                F.when(
                    s["n"] >= least,
                    F.concat(acc["found"], F.array(_span(
                        acc["at"] + s["before"], F.lit(number), acc["at"] + s["before"] + s["length"]
                    ))),
                ).otherwise(acc["found"]).alias("found"),
            ),
        )

    def placed(blocks: Column) -> Column:
        """All spans: those of a block begin where the block before it ends."""
        starts = F.aggregate(
            blocks, F.array(F.lit(0)), lambda acc, block: F.concat(acc, F.array(F.element_at(acc, -1) + block["at"]))
        )
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), lambda block, start: F.transform(
            block["found"], lambda s: _span(s["start"] + start, s["kind"], s["end"] + start)
        )))

    # Arrays grow within a block and by block, so many matches cost a block's length each, not all of it.
    in_blocks = lambda all_steps: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / BLOCK).cast("int")),
        lambda b: walk(F.slice(all_steps, b * BLOCK + 1, F.lit(BLOCK))),
    )
    walked = F.when(F.size(matches) > 0, _bound(_bound(steps, in_blocks), placed)).otherwise(F.array().cast(_SPAN))
    return F.when(text.rlike(needs), walked).otherwise(F.array().cast(_SPAN))


def scan(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, text) to (blob, rules, spans), the spans by start, then by rule as listed."""
    found = F.concat(*[_spans(F.col("text"), i, rule) for i, rule in enumerate(rules)])
    return blobs.select("blob", rule_version(rules).alias("rules"), F.array_sort(found).alias("spans"))


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, text), one row for each version of a document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def update(spark: SparkSession, seen: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Scan what the ledger at path ``ledger`` lacks, append it, and return the ledger under these rules.

    ``seen`` is (path, blob, text). A blob enters once, whatever number of paths holds it:
    copies meet within each task before anything moves.
    """
    schema = f"blob string, rules string, spans {_SPAN}"
    try:
        known = spark.read.schema(schema).parquet(ledger)
        known.limit(0).collect()
    except Exception as missing:  # a new ledger
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        known = None
    fresh = seen.select("blob", "text")
    if known is not None:
        done = known.filter(F.col("rules") == rule_version(rules)).select("blob")
        fresh = fresh.join(done, "blob", "left_anti")
    scan(fresh.dropDuplicates(["blob"]), rules).write.mode("append").parquet(ledger)
    return spark.read.schema(schema).parquet(ledger).filter(F.col("rules") == rule_version(rules))


def _joined(spans: Column, names: list[str]) -> Column:
    kinds = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def report(docs: DataFrame, ledger: str, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its base counts, the digest of its base spans, and all spans.

    Blobs without findings, nearly all, take no part in the join back to the paths.
    """
    seen = versions(docs, id_col, text_col)
    known = update(docs.sparkSession, seen, ledger, rules)
    found = known.filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    rows = seen.select("path", "blob").join(found, "blob", "left")
    spans = F.coalesce("spans", F.array().cast(_SPAN))
    names = [rule[0] for rule in rules]
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(BASE)
    ]
    return rows.select(
        F.col("path").alias("doc_id"), *counts,
        F.sha2(_joined(base, names), 256).alias("base_sha256"),
        _joined(spans, names).alias("spans"), "blob",
    )
