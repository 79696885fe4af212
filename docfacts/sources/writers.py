"""Sinks. Every writer replaces or appends to its own folder."""

from __future__ import annotations

import os
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfacts.operators import evaluate, quality
from docfacts.operators.resolve import SITE, facts_of, totals, with_site
from docfacts.schemas import NUMBER_FIELDS, RECORD_FIELDS
from docfacts.session import machine_folder

# The folder of rows without a key, and what Spark escapes in a folder's name.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def wrap_stored(records: DataFrame) -> DataFrame:
    """Records in the stored form, every value as text under its type."""
    fields = [
        F.struct(F.col(f).cast("string").alias("N" if f in NUMBER_FIELDS else "S")).alias(f)
        for f in RECORD_FIELDS
    ]
    return records.select(F.struct(F.col("report_id").alias("S")).alias("report_id"), *fields)


def write_stored(records: DataFrame, path: str) -> None:
    wrap_stored(records).write.mode("overwrite").json(path)


def _served(table: DataFrame, path: str) -> None:
    """Rows balanced over the writers by size, which splits a mineral that dominates, in folders by mineral."""
    table.hint("rebalance", *SITE[:1]).write.mode("overwrite").partitionBy("mineral").parquet(path)


def write_occurrences(records: DataFrame, path: str) -> None:
    """Full recompute of the occurrence table and, beside it, of its links to reports.

    The records are computed once: the links are written with the measured values, and
    the occurrences come from what was written.
    """
    sited = with_site(records).select(*SITE, "report_id", "depth_m", "grade_g_t")
    _served(sited, f"{path}/links")
    written = records.sparkSession.read.schema(sited.schema).parquet(f"{path}/links")
    _served(facts_of(totals(written)), f"{path}/occurrences")


def _file_by_file(root: str, folder: str):
    """Writes (name, text) rows in the order of their names, one file for each name of a task.

    A file gets its name when it is whole, the same one if a task is repeated.
    """

    def rows(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                yield from zip(some.column(0).to_pylist(), some.column(1).to_pylist())

    def write(batches):
        from pyspark import TaskContext

        context, written = TaskContext.get(), 0
        part = f"part-{context.partitionId():05d}"
        for name, texts in groupby(rows(batches), lambda row: row[0]):
            at = f"{root}/{folder}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', name)}"
            os.makedirs(at, exist_ok=True)
            open_name = f"{at}/.{part}.{context.taskAttemptId()}"
            with open(open_name, "wb") as file:
                for _, text in texts:
                    file.write((text or b"") + b"\n")
            os.replace(open_name, f"{at}/{part}.txt")
            written += 1
        yield pa.RecordBatch.from_pydict({"n_files": pa.array([written], pa.int64())})

    return write


def write_reports(documents: DataFrame, path: str, folder: str) -> None:
    """One text file for each id in column ``folder``, in a folder ``<folder>=<id>`` below ``path``.

    The layout is that of Spark's partitioned text writer, which other stores get their files from.
    For a folder of the machine Hadoop starts two or three processes for each file, to set its mode
    and that of its folder and its checksum, and the driver moves all folders one after another. There
    the tasks write the files on their own.
    """
    spark = documents.sparkSession
    spread = documents.select(folder, "text").repartition(spark.sparkContext.defaultParallelism, folder)
    root = machine_folder(spark, path)
    if root is None:
        spread.write.mode("append").partitionBy(folder).text(path)
        return
    key = F.nullif(F.col(folder).cast("string"), F.lit(""))
    named = spread.select(F.coalesce(key, F.lit(NO_KEY)).alias("name"), F.col("text").cast("binary").alias("text"))
    files = named.sortWithinPartitions("name").mapInArrow(_file_by_file(root, folder), "n_files long")
    files.agg(F.sum("n_files")).collect()


def write_stage(rows: DataFrame, path: str) -> None:
    """What a stage of a run leaves for the next, packed well: zstd halves the digits of a hash."""
    rows.write.option("compression", "zstd").parquet(path)


def append_registry(new_hashes: DataFrame, path: str) -> None:
    new_hashes.write.mode("append").option("compression", "zstd").parquet(path)


def append_attempts(log: DataFrame, path: str) -> None:
    log.write.mode("append").option("compression", "zstd").parquet(path)


def write_labelled(labelled: DataFrame, path: str) -> None:
    """A synthetic corpus: texts with ids as Parquet, labels as line-delimited JSON."""
    labelled.select("report_id", "text").write.mode("overwrite").parquet(f"{path}/reports")
    labelled.write.mode("overwrite").json(f"{path}/labels")


def write_evaluation(matches: DataFrame, path: str) -> None:
    """The matches, and their summary from what was written."""
    matches.write.mode("overwrite").json(f"{path}/results")
    written = matches.sparkSession.read.schema(matches.schema).json(f"{path}/results")
    evaluate.summary(written).write.mode("overwrite").json(f"{path}/summary")


def write_quality(checks: DataFrame, path: str, pipeline: str = "docfacts") -> None:
    """Checks with their measured values, and the scores from what was written, as JSON."""
    stamped = {"pipeline": F.lit(pipeline), "generated_at": F.current_timestamp()}
    checks.withColumns(stamped).write.mode("overwrite").json(f"{path}/checks")
    written = checks.sparkSession.read.schema(checks.schema).json(f"{path}/checks")
    quality.score(written).withColumns(stamped).write.mode("overwrite").json(f"{path}/score")
