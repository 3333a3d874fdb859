"""Delimited extracts in and out.

Extracts are read as text under an explicit schema and typed by ``plans``; type inference would
read everything twice and can change between months.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridsight.functions import parsing


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    sep: str = ",",
    settle_seconds: int | None = None,
) -> DataFrame:
    """Read files with a header, every column as text.

    With ``columns`` the header of each file must agree with them, so a month with moved columns
    fails instead of being read askew. Without, the first header names the columns. Folders are
    searched recursively. ``settle_seconds`` leaves out files changed more recently than that.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("enforceSchema", False)
    )
    if columns:
        reader = reader.schema(text_schema(columns))
    if settle_seconds is not None:
        limit = datetime.now(timezone.utc) - timedelta(seconds=settle_seconds)
        reader = reader.option("timeZone", "UTC").option(
            "modifiedBefore", limit.strftime("%Y-%m-%dT%H:%M:%S")
        )
    return reader.csv(path)


def scan_billing(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    """Pipe-delimited billing files, any number at once, with the month named by each file."""
    rows = scan_delimited(spark, path, columns, sep="|")
    return with_billing_month(rows)


def with_billing_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("billing_month", parsing.month_in_path(F.col("_metadata.file_path")))


def split_rejects(rows: DataFrame, required: str) -> tuple[DataFrame, DataFrame]:
    """Rows that have the required value, and the rest."""
    return rows.filter(F.col(required).isNotNull()), rows.filter(F.col(required).isNull())


def export_csv(
    df: DataFrame, path: str, files: int | None = None, spread: bool = False, sep: str = ","
) -> str:
    """Write CSV with a header; ``files`` sets the number of files, ``None`` leaves it.

    Without ``spread`` partitions are merged, which needs no shuffle but also runs the work before
    in as few tasks; it suits small results. With it rows are shuffled into that many even files.
    """
    if files is not None:
        df = df.repartition(files) if spread else df.coalesce(files)
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_extract(df: DataFrame, folder: str, name: str, sep: str = "|", by: str | None = None) -> str:
    """Write ``df`` as an extract: ``folder/name`` or, with ``by``, one folder per value.

    The folder for value v is ``batch=<name>_v``, which keeps the month in the path.
    """
    if by is None:
        path = f"{folder}/{name}"
        df.write.option("header", True).option("sep", sep).csv(path)
        return path
    batches = df.withColumn("batch", F.concat(F.lit(f"{name}_"), F.col(by))).drop(by)
    batches.hint("rebalance", "batch").write.partitionBy("batch").option("header", True).option(
        "sep", sep
    ).csv(folder)
    return folder


def publish_extract(df: DataFrame, landing: str, name: str, sep: str = "|") -> list[str]:
    """Write an extract beside the landing folder and rename its files into it.

    A reader of the landing folder therefore only ever sees finished files. File ``i`` is called
    ``<name>-i.csv``.
    """
    spark = df.sparkSession
    staging = f"{landing.rstrip('/')}-staging/{name}"
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(staging)
    paths = spark._jvm.org.apache.hadoop.fs
    fs = paths.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(paths.Path(landing))
    parts = [s.getPath() for s in fs.listStatus(paths.Path(staging)) if s.getPath().getName().startswith("part-")]
    names = []
    for i, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        target = f"{landing}/{name}-{i}.csv"
        if not fs.rename(part, paths.Path(target)):
            raise OSError(f"could not publish {target}")
        names.append(target)
    return names


def publish_folder(df: DataFrame, landing: str, name: str, sep: str = "|") -> str:
    """Write one extract as the folder ``<name>.csv`` of many files, made by as many tasks, beside the landing
    folder, and rename it into it as a whole."""
    spark = df.sparkSession
    staging, target = f"{landing.rstrip('/')}-staging/{name}.csv", f"{landing.rstrip('/')}/{name}.csv"
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(landing))
    if fs.exists(path(target)) or not fs.rename(path(staging), path(target)):
        raise OSError(f"could not publish {target}")
    return target


def files_of(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Name, time and length of a folder's files, by name, without those that Spark does not read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    lines = [(f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in found]
    return sorted(line for line in lines if not line[0].startswith(("_", ".")))
