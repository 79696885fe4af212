"""A keyed Parquet table whose reads and puts don't grow with its history.

Rows lie in a folder for each put and key prefix (the first hexadecimal digits of the key's MD5).
A manifest, at most a few entries per prefix, says which folders are current. A put writes its
own folders; a prefix that has collected ``FAN_IN`` of them is merged into one at once, so a
read opens a bounded number of folders however many puts there were, and a look-up only those
of its keys. Folders are never changed: a reader goes on with the manifest it has read.

A put may be told which rows to take by their keys alone. They are found where the rows lie after the
one shuffle that deals them out by prefix. A merge deals its rows out by prefix in one shuffle too. The
folder of a put and a merged folder hold each key once, so reading a prefix that has one folder shuffles
nothing.

A put is named by an ascending number. Repeating the last one after a failure starts from the
manifest before it and gives the same table, so streams can use it as an exactly-once sink. The
manifest alternates between two places: the one a put starts from stays valid until the new one
is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.operators.upsert import latest
from docfacts.sources.readers import parquet_or_empty

PREFIX_DIGITS, FAN_IN = 2, 8
_MANIFEST = "number long, prefix string, folder string"
# The ends of the names of folders in which every key has one row, of merges and of puts.
_MERGED, _ONCE = "-merged", "-once"


class PrefixedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        version: Sequence[str] = (),
        digits: int = PREFIX_DIGITS,
        fan_in: int = FAN_IN,
    ) -> None:
        """``version`` orders the rows of a key; among equals the later put wins."""
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.version, self.digits, self.fan_in = list(version), digits, fan_in

    def _prefix(self, key: Column) -> Column:
        return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, self.digits)

    def _manifest(self, before: int | None = None) -> tuple[int, dict[str, list[str]]]:
        """Where the last manifest below ``before`` stands, and the current folders of each prefix
        by it, oldest first."""
        schema = T.StructType.fromDDL(_MANIFEST)
        found: dict[int, tuple[int, list]] = {}
        for place in (0, 1):
            for row in parquet_or_empty(self.spark, f"{self.path}/manifest-{place}", schema).collect():
                if before is None or row["number"] < before:
                    found.setdefault(row["number"], (place, []))[1].append(row)
        place, rows = found[max(found)] if found else (1, [])
        current: dict[str, list[str]] = {}
        for row in sorted(rows, key=lambda r: r["folder"]):
            current.setdefault(row["prefix"], []).append(row["folder"])
        return place, current

    def _open(self, folders: dict[str, list[str]]) -> DataFrame:
        with_put = T.StructType([*self.schema.fields, T.StructField("_put", T.LongType())])
        paths = [f"{self.path}/{folder}/_prefix={prefix}" for prefix, names in sorted(folders.items()) for folder in names]
        if not paths:
            return self.spark.createDataFrame([], with_put)
        return self.spark.read.schema(with_put).parquet(*paths)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with their ``_prefix``, all of a prefix in one task."""
        return rows.withColumn("_prefix", self._prefix(F.col(self.key))).repartition("_prefix")

    def _once(self, placed: DataFrame, *by: str) -> DataFrame:
        """Of rows dealt out by prefix one for each key, the first in the order of ``by``."""
        nth = F.row_number().over(Window.partitionBy("_prefix", self.key).orderBy(*by))
        return placed.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth")

    def _among(self, rows: DataFrame, keys: DataFrame, computed: dict[str, Column]) -> DataFrame:
        """One row of ``rows`` for each row of ``keys`` that it equals in all columns of ``keys``. The
        ``computed`` columns of ``rows`` are made after they were dealt out."""
        marked = rows.drop(*computed).withColumn("_wanted", F.lit(False)).unionByName(
            keys.withColumn("_wanted", F.lit(True)), allowMissingColumns=True
        )
        of_row = {name: F.when(~F.col("_wanted"), column) for name, column in computed.items()}
        of_key = {name: F.when(F.col("_wanted"), F.col(name)).otherwise(of_row[name]) for name in computed if name in keys.columns}
        dealt = self._dealt(marked).withColumns(of_row | of_key)
        same = Window.partitionBy("_prefix", *keys.columns).orderBy(F.desc("_wanted"))  # the key comes first
        after = dealt.withColumn("_after_key", F.lag("_wanted").over(same))
        after = after.filter(F.col("_after_key") & ~F.col("_wanted")).drop("_wanted", "_after_key")
        return after if self.version else self._once(after, *keys.columns)

    def _write(self, placed: DataFrame, folder: str) -> set[str]:
        """Write rows with their ``_put`` and ``_prefix`` and return the prefixes they have."""
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy("_prefix").parquet(f"{self.path}/{folder}")
        written = parquet_or_empty(
            self.spark, f"{self.path}/{folder}", T.StructType([T.StructField("_prefix", T.StringType())])
        )
        return {row[0] for row in written.distinct().collect()}

    def put(
        self, rows: DataFrame, number: int, among: DataFrame | None = None, computed: dict[str, Column] | None = None
    ) -> None:
        """Insert or replace ``rows``. Without ``version`` they must have one row per key; of more, one is put.

        ``among`` has the key and other columns of the table, each row once; for each of its rows one
        of the equal ``rows`` is put, and nothing else. ``computed`` columns, which follow from the
        others, are then not shuffled with the rows but made from them where they lie.
        """
        rows = rows.select(*self.schema.fieldNames())
        if among is not None:
            placed = self._among(rows, among, computed or {})
            if self.version:
                placed = latest(placed, ["_prefix", self.key], self.version)
        elif self.version:
            rows = latest(rows, self.key, self.version)
            placed = rows.withColumn("_prefix", self._prefix(F.col(self.key))).hint("rebalance", "_prefix")
        else:
            placed = self._once(self._dealt(rows), self.key)
        place, folders = self._manifest(before=number)
        name = f"put-{number:012d}{_ONCE}"
        for prefix in self._write(placed.withColumn("_put", F.lit(number).cast("long")), name):
            folders.setdefault(prefix, []).append(name)
        full = {prefix: names for prefix, names in folders.items() if len(names) >= self.fan_in}
        if full:
            merged = f"put-{number:012d}{_MERGED}"
            self._write(self._latest(self._dealt(self._open(full)), "_prefix"), merged)
            folders |= {prefix: [merged] for prefix in full}
        entries = [(number, prefix, folder) for prefix, names in folders.items() for folder in names]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest-{1 - place}"
        )

    def _latest(self, rows: DataFrame, *dealt_by: str) -> DataFrame:
        return latest(rows, [*dealt_by, self.key], [*self.version, "_put"])

    def _current(self, folders: dict[str, list[str]], wanted: Column | None = None) -> DataFrame:
        """The current row of every key, or of the wanted ones, of some prefixes from their folders."""
        keep = lambda rows: rows if wanted is None else rows.filter(wanted)
        once = {prefix: names for prefix, names in folders.items() if len(names) == 1 and names[0].endswith((_MERGED, _ONCE))}
        others = {prefix: names for prefix, names in folders.items() if prefix not in once}
        if not once:
            return self._latest(keep(self._open(others)))
        rows = keep(self._open(once))
        return rows.unionByName(self._latest(keep(self._open(others)))) if others else rows

    def read(self) -> DataFrame:
        """The current row of every key."""
        return self._current(self._manifest()[1]).drop("_put")

    def lookup(self, *keys: object) -> DataFrame:
        """The current rows of some keys; only the folders of their prefixes are opened."""
        asked = self.spark.createDataFrame([(str(k),) for k in keys], "k string").select(self._prefix(F.col("k")))
        prefixes = {row[0] for row in asked.collect()}
        folders = {prefix: names for prefix, names in self._manifest()[1].items() if prefix in prefixes}
        wanted = F.col(self.key).cast("string").isin([str(k) for k in keys])
        return self._current(folders, wanted).drop("_put")
