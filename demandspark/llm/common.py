"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from demandspark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_noted: list[list[str]] = []


@contextmanager
def noting_stashes() -> Iterator[list[str]]:
    """Collects the folders that ``stash`` writes meanwhile."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    The written table cuts the lineage and survives lost executors. It is
    removed when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    for noted in _noted:
        noted.append(path)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # lets Spark remove the shuffle files that the written table stands for
    discard_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard_at_end(spark: SparkSession, path: str) -> None:
    """Have the folder removed when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def discard(*stashed: DataFrame) -> None:
    """Remove stashed tables that nothing to come reads."""
    for df in stashed:
        remove(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove folders that ``stash`` has written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if "/llm-" in folder:
            where = jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(conf).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, whatever folder they run in (once per application)."""
    context = spark.sparkContext
    if getattr(context, "_demandspark_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="demandspark-")) / "demandspark_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in package.rglob("*.py"):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive.resolve()))
    context._demandspark_shipped = True


#: What operators remember in a Python worker; each entry forgets one of these.
forgets: list[Callable[[], None]] = []
_tenant = [""]


def settle(operator: str) -> None:
    """Called where a task begins: a worker serves many operators in turn, and keeps only the current one's memory."""
    if _tenant[0] != operator:
        for forget in forgets:
            forget()
        _tenant[0] = operator
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_rows(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one batch (or None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(fn.__module__)
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
        give_back()

    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Texts are long: Spark's default of 10,000 rows to a batch holds too much at once."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
