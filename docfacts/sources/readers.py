"""Sources. All schemas are declared, so reading starts no inference job."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.schemas import (
    LABELLED_REPORT,
    NUMBER_FIELDS,
    OCCURRENCE,
    RECORD_FIELDS,
    STORED_EXTRACTION,
    UPLOAD,
)
from docfacts.session import machine_path

# Names sent on at once, and bytes of texts; tasks that read files, for each core.
_NAMES, _BYTES, _READERS = 10_000, 4 << 20, 8


def _names_of(root: str):
    """The names in a folder, passed on some at a time."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = []
            with os.scandir(root) as entries:
                for entry in entries:
                    found.append(os.fsencode(entry.name))
                    if len(found) == _NAMES:
                        yield pa.RecordBatch.from_pydict({"name": pa.array(found, pa.binary())})
                        found = []
            yield pa.RecordBatch.from_pydict({"name": pa.array(found, pa.binary())})

    return names


def _hidden(name: str) -> bool:
    """What Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _text_files(at: str) -> Iterator[str]:
    """Every ``*.txt`` at or below a path, hidden files and folders left out."""
    if _hidden(os.path.basename(at)):
        return
    if os.path.isdir(at):
        with os.scandir(at) as entries:
            names = [entry.name for entry in entries]
        for name in names:
            yield from _text_files(f"{at}/{name}")
    elif at.endswith(".txt"):
        yield at


def _texts_below(root: str, folder: str):
    """The text files at or below each name of a folder, a few MB at a time; the id is in the
    name of the file's own folder."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for name in (name for batch in batches for name in batch.column(0).to_pylist()):
            for path in _text_files(f"{root}/{os.fsdecode(name)}"):
                with open(path, "rb") as file:
                    text = file.read()
                if not text:  # Spark's reader passes over empty files
                    continue
                key, _, escaped = os.fsencode(os.path.basename(os.path.dirname(path))).decode(errors="replace").partition("=")
                ids.append(unquote(escaped) if key == folder else "")
                texts.append(text)
                held += len(text)
                if held >= _BYTES or len(ids) == _NAMES:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())], ["report_id", "text"])
                    ids, texts, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.binary())], ["report_id", "text"])

    return read


def read_reports(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Every ``*.txt`` of a folder as one document; ``report_id`` is the file stem.

    With ``folder`` the files lie one to a folder named ``<folder>=<id>``, as Spark writes them,
    and the id is taken from there. Spark's reader keeps the names of all files on the driver and
    plans every one there. In a folder of the machine one task names the folders, passing them on as
    it goes, and the others open them, so the driver sees no name.
    """
    root = None if folder is None else machine_path(spark, path)
    if root is not None:
        names = spark.range(1).coalesce(1).mapInArrow(_names_of(root), "name binary")
        dealt = names.repartition(_READERS * spark.sparkContext.defaultParallelism, "name")
        read = dealt.mapInArrow(_texts_below(root, folder), "report_id string, text binary")
        return read.select("report_id", F.col("text").cast("string").alias("text"))
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1)
    if folder is not None:
        name = F.regexp_extract(F.col("_metadata.file_path"), rf"/{folder}=([^/]*)/[^/]*$", 1)
        for _ in ("the path as an address", "the value as a folder's name"):  # both are escaped
            name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    files = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", folder is not None)
    return files.text(path, wholetext=True).select(name.alias("report_id"), F.col("value").alias("text"))


def read_labelled(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """Labelled reports with their nested truth.

    ``array_file`` reads files that hold one JSON array each, which Spark cannot split;
    pass False for line-delimited files, the form to use for large corpora.
    """
    reader = spark.read.schema(LABELLED_REPORT)
    return reader.json(path, multiLine=array_file)


def flat_truth(labelled: DataFrame) -> DataFrame:
    """The truth fields as columns."""
    return labelled.select("report_id", "text", "ground_truth.*")


def _bodies(lines: DataFrame) -> DataFrame:
    """Upload bodies of JSON lines: two texts each. What is no object, or has a field that is
    neither a text nor null, keeps its line in ``_corrupt_record``."""
    body = F.try_parse_json("value")
    kinds = [F.schema_of_variant(F.try_variant_get("_body", f"$.{f.name}", "variant")) for f in UPLOAD.fields]
    fits = F.schema_of_variant("_body").startswith("OBJECT")
    for kind in kinds:
        fits = fits & F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))
    return (
        lines.filter(F.trim("value") != "")
        .withColumn("_body", body)
        .withColumn("_fits", F.coalesce(fits, F.lit(False)))
        .select(
            *[F.when(F.col("_fits"), F.try_variant_get("_body", f"$.{f.name}", "string")).alias(f.name) for f in UPLOAD.fields],
            F.when(~F.col("_fits"), F.col("value")).alias("_corrupt_record"),
        )
    )


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    """Upload bodies, one JSON object per line; unreadable ones are kept as rejections."""
    return _bodies(spark.read.text(path))


def stream_uploads(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same source as a stream."""
    return _bodies(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path))


def unwrap_stored(items: DataFrame) -> DataFrame:
    """Typed columns from ``{"S": ..}`` and ``{"N": ..}`` wrappers."""
    fields = [
        F.col(f"{f}.N").cast("double").alias(f) if f in NUMBER_FIELDS else F.col(f"{f}.S").alias(f)
        for f in RECORD_FIELDS
    ]
    return items.select(F.col("report_id.S").alias("report_id"), *fields)


def read_stored(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All stored extractions of an export, unwrapped."""
    return unwrap_stored(spark.read.schema(STORED_EXTRACTION).format(fmt).load(path))


def parquet_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, nested: bool = False
) -> DataFrame:
    """The Parquet files below ``path``; no rows if there is no such path.

    Partition folders (``mineral=Gold``) become columns, so that a filter on them
    prunes folders. ``nested`` looks into folders of any other name as well.
    """
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    try:
        return reader.option("recursiveFileLookup", nested).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def view(
    spark: SparkSession,
    path: str,
    name: str,
    schema: T.StructType = OCCURRENCE,
    nested: bool = False,
) -> DataFrame:
    """Register the Parquet files below ``path`` as a view, an empty one if there are none."""
    df = parquet_or_empty(spark, path, schema, nested)
    df.createOrReplaceTempView(name)
    return df
