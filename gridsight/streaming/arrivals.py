"""Arriving extract files as a stream: each file is one load, loaded once, into one table
(``load_arrivals``) or through the monthly load into every table it feeds (``run_arrivals``).

Producers must write a file elsewhere and rename it into the landing folder
(``sources.extracts.publish_extract``); a file in the landing folder is taken to be complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridsight.functions import parsing
from gridsight.plans.complaints import clean_complaints
from gridsight.plans.monthly import load_complaints, load_months, load_outages
from gridsight.plans.outages import clean_outages
from gridsight.sources import extracts, tables
from gridsight.sources.extracts import text_schema


def arriving_files(
    spark: SparkSession,
    landing: str,
    columns: list[str],
    contains: str = "Ageing",
    sep: str = "|",
    one_file_at_a_time: bool = False,
) -> DataFrame:
    """New ``.csv`` files (any case) whose name contains a word, with file name and month.

    A batch takes all files that have arrived, each as a load of its own; ``one_file_at_a_time`` makes
    a batch of each.
    """
    reader = (
        spark.readStream.schema(text_schema(columns))
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", f"*{contains}*.[cC][sS][vV]")
    )
    if one_file_at_a_time:
        reader = reader.option("maxFilesPerTrigger", 1)
    path = F.col("_metadata.file_path")
    return reader.csv(landing).withColumns(
        {
            "billing_month": parsing.month_in_path(path),
            tables.LOAD: F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1),
        }
    )


def load_arrivals(
    files: DataFrame,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    every: str | None = None,
) -> StreamingQuery:
    """Write each batch's loads into the table at ``target``.

    A load's partition is replaced as a whole, so a batch repeated after a failure leaves the
    table as it was. A task reads one file, hence one load, so rows are written without a
    shuffle and a large file by as many tasks as read it. Without ``every`` the query takes what
    has arrived and stops.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        tables.replace_loads(transform(batch), target, gather=False)

    writer = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def wait_until_done(query: StreamingQuery, timeout_seconds: int = 600) -> bool:
    """Whether the query ended in time; a failure in it is raised here."""
    return bool(query.awaitTermination(timeout_seconds))


def finish(query: StreamingQuery, timeout_seconds: int = 600) -> None:
    if not wait_until_done(query, timeout_seconds):
        query.stop()
        raise TimeoutError(f"load still running after {timeout_seconds} s")


#: Word in a file's name and separator of each kind of extract.
KINDS = {"billing": ("Ageing", "|"), "complaints": ("CRM", "|"), "outages": ("OMS", ",")}


def arriving_paths(spark: SparkSession, landing: str, files_per_batch: int = 100) -> DataFrame:
    """New ``.csv`` files of any kind: path, length and time of each; no content is read.

    A folder named ``.csv`` is one ``extract`` of several files (``sources.extracts.publish_folder``).
    """
    inside, folder = F.element_at(F.split("path", "/"), -2), F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    whole = inside.rlike(r"[.][cC][sS][vV]$") & (inside != landing.rstrip("/").rsplit("/", 1)[-1])
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{landing.rstrip('/')}/*.[cC][sS][vV]")
        .select("path", "modificationTime", "length", F.when(whole, folder).alias("extract"))
    )


def load_file(spark: SparkSession, path: str, base: str, batch: str, kinds: dict = KINDS, season: bool = False) -> dict[str, str]:
    """Run the monthly load that a file's name asks for; none for a name of no known kind."""
    name = path.rsplit("/", 1)[1]
    kind, sep = next(((k, sep) for k, (word, sep) in kinds.items() if word in name), (None, None))
    if kind == "billing":
        return load_months(extracts.scan_billing(spark, path), base, batch, season)
    if kind == "complaints":
        return load_complaints(clean_complaints(extracts.scan_delimited(spark, path, sep=sep)), base, None, batch, season)
    if kind == "outages":
        outages = clean_outages(extracts.scan_delimited(spark, path, sep=sep))
        dated = outages.withColumns({"year": F.year("created_at"), "month": F.month("created_at")})
        return load_outages(dated, base, None, batch, season)
    return {}


def run_arrivals(
    paths: DataFrame, base: str, checkpoint: str, kinds: dict = KINDS, season: bool = False, every: str | None = None
) -> StreamingQuery:
    """Run the monthly load for each file that arrives, in the order of their times.

    A file is one load, named by its path, time and length in the journal of ``base``; so is a folder named
    ``.csv``, which arrived as a whole, by those of all its files, whatever batch names them. A batch that is
    repeated, or a checkpoint that is lost, therefore loads nothing twice; a load that stopped half-way is
    finished first. Files of the three kinds may come in any order: each refreshes the dimensions of its
    months. What comes to the driver is a line for each file of a batch (``files_per_batch``).
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        order, folders = ["modificationTime", "path"], set()
        for line in batch.orderBy(*order).collect():
            path = line["path"]
            stamp = f"{path}|{line['modificationTime'].isoformat()}|{line['length']}"
            if folder := line.asDict().get("extract"):
                if folder in folders:
                    continue
                folders.add(folder)
                path, stamp = folder, f"{folder}|{extracts.files_of(batch.sparkSession, folder)}"
            name = path.rsplit("/", 1)[1].rsplit(".", 1)[0]
            digest = hashlib.sha256(stamp.encode()).hexdigest()[:16]
            load_file(batch.sparkSession, path, base, f"{name}-{digest}", kinds, season)

    writer = paths.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
