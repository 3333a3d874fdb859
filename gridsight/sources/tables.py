"""Parquet tables whose rows carry the load that brought them.

A table is a folder partitioned by ``load_id``. Replacing, undoing and deleting then touch whole
partitions, and a repeated write of the same load changes nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

LOAD = "load_id"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_replace(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Create or replace, as one folder per value where a partition column is given."""
    writer = gather_for_write(df, partition_by).write if partition_by else df.write
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def write_append(df: DataFrame, path: str, partition_by: str = LOAD) -> str:
    gather_for_write(df, partition_by).write.mode("append").partitionBy(partition_by).parquet(path)
    return path


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Overwrite a catalog table; with ``path`` its files live there."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_loads(df: DataFrame, path: str, partition_by: str = LOAD, gather: bool = True) -> str:
    """Replace exactly the partitions that ``df`` has rows for; running it again is harmless.

    ``gather=False`` writes rows where they are, for input whose tasks each hold few loads.
    """
    rows = gather_for_write(df, partition_by) if gather else df
    rows.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition_by).parquet(path)
    return path


def replace_given(df: DataFrame, path: str, given, partition_by: str = LOAD) -> str:
    """``replace_loads`` for the whole-number loads ``given``; those without a row become empty.

    A load that was not rewritten still has the files it had before, and its folder is removed.
    """
    spark = df.sparkSession
    folders = {load: f"{path}/{partition_by}={load}" for load in given}
    before = {load: _files(spark, folder) for load, folder in folders.items()}
    replace_loads(df, path, partition_by)
    drop_folders(spark, [f for load, f in folders.items() if _files(spark, f) == before[load]])
    return path


def idempotent_append(
    new: DataFrame, path: str, keys: list[str], order: list[str] | None = None, partition_by: str = LOAD,
    within: Column | None = None,
) -> int:
    """Append the rows whose keys the table does not hold; returns the number appended.

    NULL keys equal one another. Of several new rows with one key the first by ``order`` (by all
    columns, where none is given) is appended. ``within`` is a condition on the table that holds for
    every row that a new key could repeat, such as a range of partitions; the keys of the rest are
    not read. The rows to append are stored once, beside the table, and counted there.
    """
    table = read_table(new.sparkSession, path)
    present = (table if within is None else table.filter(within)).select(*keys).distinct()
    row, rank = F.struct(*new.columns), F.struct(*(order or new.columns))
    first = new.groupBy(*keys).agg(F.min_by(row, rank).alias("row")).select("row.*")
    same = reduce(lambda a, b: a & b, [first[k].eqNullSafe(present[k]) for k in keys])
    fresh = first.join(present, same, "left_anti")
    batch = f"{path.rstrip('/')}-batch-{uuid.uuid4().hex}"
    try:
        stored = read_table(new.sparkSession, write_replace(fresh, batch))
        write_append(stored, path, partition_by)
        return stored.count()
    finally:
        drop_folders(new.sparkSession, [batch])


def _folder() -> Column:
    """The folder a row was read from; the same for all rows of a load."""
    return F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("folder")


def _path(spark: SparkSession, folder: str):
    """A folder's path and file system; names that Spark read from files are percent-encoded."""
    name = spark._jvm.org.apache.hadoop.fs.Path
    at = name(spark._jvm.java.net.URI(folder)) if "%" in folder else name(folder)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, folder: str) -> set[str]:
    at, fs = _path(spark, folder)
    return {f.getPath().getName() for f in fs.listStatus(at)} if fs.exists(at) else set()


def holds_files(spark: SparkSession, folder: str) -> bool:
    """Whether the folder exists and holds files that Spark would read."""
    return any(not name.startswith(("_", ".")) for name in _files(spark, folder))


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Remove whole partitions by the folders that Spark read them from."""
    for folder in folders:
        at, fs = _path(spark, folder)
        if fs.exists(at) and not fs.delete(at, True):
            raise OSError(f"could not remove {folder}")


def delete_where(spark: SparkSession, path: str, predicate: Column, partition_by: str = LOAD) -> list:
    """Delete matching rows; rows for which the predicate is NULL stay.

    Only partitions with a matching row are rewritten, and those without a survivor are removed.
    What comes to the driver is one line per partition. Returns the rewritten or removed loads. A task
    that fails is repeated safely; if the job fails while it commits, run it again from a copy, since
    the partitions it rewrites are those it reads.
    """
    hit = F.coalesce(predicate, F.lit(False))
    table = read_table(spark, path)
    lines = (
        table.groupBy(partition_by, _folder())
        .agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("kept"))
        .filter("hits > 0")
        .collect()
    )
    rewrite = [r[partition_by] for r in lines if r["kept"] > 0]
    emptied = [r for r in lines if r["kept"] == 0]
    if rewrite:
        replace_loads(table.filter(F.col(partition_by).isin(rewrite) & ~hit), path, partition_by)
    drop_folders(spark, [r["folder"] for r in emptied])
    return sorted([*rewrite, *[r[partition_by] for r in emptied]])


def load_history(table: DataFrame, at: str, limit: int = 100, partition_by: str = LOAD) -> DataFrame:
    """The newest loads first: rows and time span of each."""
    return (
        table.groupBy(partition_by)
        .agg(F.count(F.lit(1)).alias("rows"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
        .orderBy(F.col(partition_by).desc())
        .limit(limit)
    )


def as_of(table: DataFrame, load, partition_by: str = LOAD) -> DataFrame:
    """The table as it stood after ``load``; only those partitions are read."""
    return table.filter(F.col(partition_by) <= load)


def rollback_to(spark: SparkSession, path: str, load, partition_by: str = LOAD) -> list:
    """Drop every load after ``load``; one line per dropped load comes to the driver.

    No column is read: the loads and their folders come from the files' names.
    """
    later = read_table(spark, path).filter(F.col(partition_by) > load)
    lines = later.select(partition_by, _folder()).distinct().collect()
    drop_folders(spark, [r["folder"] for r in lines])
    return sorted(r[partition_by] for r in lines)


def evolve(parts: list[DataFrame], target: StructType) -> DataFrame:
    """Loads of different age under one schema: dropped columns go, narrow types widen, columns a
    load does not have are NULL."""

    def conform(df: DataFrame) -> DataFrame:
        shared = [f for f in target.fields if f.name in df.columns]
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in shared])

    joined = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform(p) for p in parts]
    )
    return joined.select(*target.fieldNames())


def newer_rows(source: DataFrame, target: DataFrame, at: str) -> DataFrame:
    """Source rows after the target's latest time; all of them while the target is empty.

    The mark is fetched first, so that the filter holds a constant and prunes files.
    """
    mark = target.agg(F.max(at).cast("string")).first()[0]
    if mark is None:
        return source
    return source.filter(F.col(at) > F.lit(mark).cast(target.schema[at].dataType))


def gather_for_write(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key come together before a partitioned write, so that few files are made.

    AQE merges small groups and splits one that is too large for a task, which a plain
    ``repartition(key)`` would not. Elsewhere partition counts need no help.
    """
    return df.hint("rebalance", key)
