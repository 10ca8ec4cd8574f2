"""Sources: CSV fact files, snapshots, request records, JSON markers and
artifact listings. Paths may be any Hadoop URI (``file:``, ``s3a:``,
``hdfs:``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from demandspark import schema as S
from demandspark.operators.projection import rename, trim_names


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop FileSystem of the path's scheme."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def first_available(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists (local copy, then remote copies)."""
    for p in paths:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_demand_csv(spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1",
                    schema: T.StructType | None = None) -> DataFrame:
    """Header CSV with the raw column names: trimmed and renamed to the
    fact schema. With a declared schema no inference pass is made.
    A list of paths reads the first that exists."""
    p = first_available(spark, path) if not isinstance(path, str) else path
    r = spark.read.option("header", True).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return rename(trim_names(r.csv(p)), S.RENAME_MAP)


def read_snapshot_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A reference/current snapshot; ``None`` when absent (tolerated)."""
    if not path_exists(spark, path):
        return None
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType = S.REQUEST_SCHEMA) -> DataFrame:
    """Request records (JSON lines) with a declared schema."""
    return spark.read.schema(schema).json(path)


def parse_records(df: DataFrame, col: str, schema: T.StructType | str, out: str = "record") -> DataFrame:
    """Parse a JSON text column into a struct (``from_json``)."""
    from pyspark.sql import functions as F

    return df.withColumn(out, F.from_json(col, schema))


def read_json_marker(spark: SparkSession, path: str) -> DataFrame:
    """One multi-line JSON document (e.g. the best-model marker)."""
    return spark.read.option("multiLine", True).json(path)


def artifact_listing(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """Files under ``path`` (recursive): path, length, modificationTime and
    the key relative to ``prefix``. The content column is not selected, so
    the binary reader never opens the files."""
    from pyspark.sql import functions as F

    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
          .select("path", "length", "modificationTime"))
    import re

    base = (prefix or path).rstrip("/")
    base = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", base)  # drop the scheme
    base = "/" + base.lstrip("/")
    return df.withColumn("key", F.regexp_extract("path", re.escape(base) + r"/(.*)$", 1))
