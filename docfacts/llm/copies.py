"""Groups of equal rows, counted and numbered as one, back to a row for each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group of more rows than this is cut into pieces that are dealt out before it is expanded.
PIECE = 100_000


def expanded(groups: DataFrame, count: str, first: str, number: str, piece: int = PIECE) -> DataFrame:
    """A row for each of the ``count`` rows of a group, numbered from ``first`` on in ``number``.

    Replaces a column named ``number``. A group that holds most rows is written out by many
    tasks; groups of usual size stay where they are.
    """
    kept = [c for c in groups.columns if c not in (count, first, number)]
    start, n = F.col(first), F.col(count)
    few = groups.filter(n <= piece).select(
        *kept, F.explode(F.sequence(start, start + n - 1)).alias(number)
    )
    pieces = (
        groups.filter(n > piece)
        .select(*kept, (start + n - 1).alias("_last"), F.explode(F.sequence(start, start + n - 1, F.lit(piece).cast("long"))).alias("_from"))
        .repartition("_from")
    )
    last = F.least("_last", F.col("_from") + (piece - 1))
    return few.unionByName(pieces.select(*kept, F.explode(F.sequence("_from", last)).alias(number)))
