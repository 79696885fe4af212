"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str | int = "*", app: str = "docfacts", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter provides one."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(warehouse: str, master: str) -> str:
    """Where scratch data goes if ``spark.checkpoint.dir`` is unset: below the warehouse.

    Under a cluster master that must be a shared folder. A folder of the machine is refused, as
    every executor would write to its own and later reads would miss the others' files.
    """
    if not master.startswith("local") and (":" not in warehouse or warehouse.startswith("file:")):
        raise ValueError(f"{warehouse} is local to each machine; set spark.checkpoint.dir to a shared folder")
    return f"{warehouse.rstrip('/')}/scratch"


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one below the warehouse."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        root = scratch_root(spark.conf.get("spark.sql.warehouse.dir"), context.master)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{_checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def machine_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as a folder of the file system that the machine sees, None if it lies in another store.

    A path need not name its store, so a row is written below it and Spark tells where that is.
    """
    mark = f"{path.rstrip('/')}/_made"
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(mark)
    address = urlsplit(spark.read.parquet(mark).inputFiles()[0])
    return posixpath.dirname(posixpath.dirname(unquote(address.path))) if address.scheme == "file" else None


def machine_path(spark: SparkSession, path: str) -> str | None:
    """``path`` on the machine if it names one folder there, None for other stores and for patterns.

    Nothing is written, so a folder that is only read can be asked about.
    """
    address = urlsplit(path)
    store = address.scheme or urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")).scheme
    at = path.removeprefix(f"{address.scheme}:") if address.scheme else path
    at = "/" + at.lstrip("/") if at.startswith("///") else at
    plain = at.startswith("/") and not at.startswith("//") and not set(at) & set("{}[]*?\\")
    return at if store == "file" and plain and os.path.isdir(at) else None


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """What a job shuffled goes when the job has ended. Otherwise it stays until the driver happens to
    collect its garbage, and the shuffles of a run of many jobs add up on disk.

    For runs that write each stage and go on from the files; a job run again shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the copy.

    Used where recomputing after a lost executor could give other rows than the
    first run did, such as the answers of a remote model.
    """
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace ``columns``, evaluated once per row however often they are used later.

    Catalyst merges a projection into the filters and projections above it, which
    repeats costly expressions such as regexes and JSON parsing for every use. Passing
    them through a one-row generator keeps them where they are, in generated code.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(row)))
