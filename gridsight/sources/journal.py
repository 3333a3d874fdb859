"""Loads that replace months of several tables and take effect as a whole.

A load first writes all its new months beside the tables, then a plan that lists them, and only then puts
each month in place, keeping what was there. A load that stops before its plan is written has changed
nothing; one that stops later is finished by the next load or by ``resume``. ``undo_after`` puts back what
loads replaced, all tables of a load at once, the last load first. Every step may be repeated.

The journal lies under ``<base>/_loads``, a folder a load: its number gives the order, a plan means that it
is ``staged``, ``PUBLISHED`` and ``UNDONE`` say what followed. One load runs at a time on a base. Months change
places by renaming folders, those of a table one after the other: a job that reads a month meanwhile may fail
and be repeated.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsight.sources import tables

FOLDER, PLAN = "_loads", "plan.json"

#: Tables that a load writes, lists or puts in place at the same time.
WRITERS = 8


def _side_by_side(spark: SparkSession, steps: Iterable[Callable[[], object]]) -> list:
    """What the steps return, none of which needs another. All have ended when one that failed is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [done.result() for done in running]


class _Files:
    """The file system calls that the journal needs."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        # Looked up once: each name on the way to a class is a call to the driver's JVM, and months are moved by the hundred.
        self._name, self._uri = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.java.net.URI
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        return self._name(self._uri(path)) if "%" in path else self._name(path)

    def exists(self, path: str) -> bool:
        at, fs = tables._path(self.spark, path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        return sorted(tables._files(self.spark, path))

    def make(self, path: str) -> None:
        at, fs = tables._path(self.spark, path)
        fs.mkdirs(at)

    def move(self, old: str, new: str) -> None:
        source = self._at(old)
        if not source.getFileSystem(self._conf).rename(source, self._at(new)):
            raise OSError(f"could not move {old} to {new}")

    def write(self, path: str, text: str) -> None:
        """The file appears whole."""
        at, fs = tables._path(self.spark, path + ".part")
        out = fs.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(path + ".part", path)

    def read(self, path: str) -> str:
        at, fs = tables._path(self.spark, path)
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


@dataclass
class Load:
    """One load; ``plan`` maps each table to the months it replaces and whether each has rows."""

    spark: SparkSession
    base: str
    folder: str
    name: str
    plan: dict[str, dict[str, bool]] = field(default_factory=dict)
    _schemas: dict = field(default_factory=dict)

    @property
    def _files(self) -> _Files:
        return _Files(self.spark)

    @property
    def state(self) -> str:
        names = self._files.names(self.folder)
        return next((s.lower() for s in ("UNDONE", "PUBLISHED") if s in names), "staged" if PLAN in names else "open")

    def stage(self, table: str, rows: DataFrame) -> None:
        """Write a table's new rows, which carry their month as ``load_id``."""
        tables.replace_loads(rows, f"{self.folder}/new/{table}")
        self._schemas[table] = rows.schema
        self.plan[table] = {}

    def stage_all(self, made: dict[str, DataFrame], *beside: Callable[[], object]) -> None:
        """``stage`` for tables of which none is made of another, written side by side: most are small and
        leave the cluster's other tasks free. Steps ``beside`` run with them."""
        write = lambda table: tables.replace_loads(made[table], f"{self.folder}/new/{table}")
        _side_by_side(self.spark, [*beside, *(partial(write, table) for table in made)])
        for table, rows in made.items():
            self._schemas[table] = rows.schema
            self.plan[table] = {}

    def staged_months(self, table: str) -> tuple[list[int], str | None]:
        """The months that a staged table has rows for, by its folders, and the folder of its rows without a month."""
        folder = f"{self.folder}/new/{table}"
        found = [name for name in self._files.names(folder) if name.startswith(f"{tables.LOAD}=")]
        none = f"{tables.LOAD}=__HIVE_DEFAULT_PARTITION__"
        return [int(name.split("=")[1]) for name in found if name != none], f"{folder}/{none}" if none in found else None

    def holds(self, table: str) -> bool:
        """Whether the table is staged by this load or has a month in place."""
        return table in self.plan or any(
            n.startswith(f"{tables.LOAD}=") for n in self._files.names(f"{self.base}/{table}"))

    def rows(self, table: str, months: list[int]) -> DataFrame | None:
        """The months as they will be after this load, or nothing where the table is unknown."""
        if not self.holds(table):
            return None
        path = f"{self.folder}/new/{table}" if table in self.plan else f"{self.base}/{table}"
        reader = self.spark.read
        if table in self.plan:
            reader = reader.schema(self._schemas[table])
        return reader.parquet(path).filter(F.col(tables.LOAD).isin(months)).drop(tables.LOAD)

    def rows_of(self, names: Iterable[str], months: list[int]) -> dict[str, DataFrame | None]:
        """``rows`` of several tables. Listing a table of many months is a job of its own, so they are listed
        side by side."""
        names = list(names)
        return dict(zip(names, _side_by_side(self.spark, [partial(self.rows, name, months) for name in names])))

    def publish(self, months: list[int]) -> None:
        """Replace ``months`` in every staged table; those without rows become empty."""
        for table in self.plan:
            made = set(self._files.names(f"{self.folder}/new/{table}"))
            self.plan[table] = {str(m): f"{tables.LOAD}={m}" in made for m in months}
        self._files.write(f"{self.folder}/{PLAN}", json.dumps({"load": self.name, "tables": self.plan}))
        self.finish()

    def _months(self):
        """Each table of the plan with its months' folders and whether they have new rows."""
        for table, months in self.plan.items():
            yield table, [(f"{tables.LOAD}={month}", has_rows) for month, has_rows in months.items()]

    def finish(self) -> None:
        """Put the planned months in place, tables side by side; what is in place already stays. A table is
        listed twice, not looked up month by month."""
        _side_by_side(self.spark, [partial(self._place, table, months) for table, months in self._months()])
        self._files.write(f"{self.folder}/PUBLISHED", "")

    def _place(self, table: str, months: list[tuple[str, bool]]) -> None:
        files = self._files
        live, new, old = f"{self.base}/{table}", f"{self.folder}/new/{table}", f"{self.folder}/old/{table}"
        for folder in (live, old):
            files.make(folder)
        waiting, there = set(files.names(new)), set(files.names(live))
        for month, has_rows in months:
            if has_rows and month not in waiting:
                continue
            if month in there:
                files.move(f"{live}/{month}", f"{old}/{month}")
            if has_rows:
                files.move(f"{new}/{month}", f"{live}/{month}")

    def undo(self) -> None:
        files = self._files
        if not files.exists(f"{self.folder}/UNDOING"):
            files.write(f"{self.folder}/UNDOING", "")
        _side_by_side(self.spark, [partial(self._put_back, table, months) for table, months in self._months()])
        files.write(f"{self.folder}/UNDONE", "")

    def _put_back(self, table: str, months: list[tuple[str, bool]]) -> None:
        files = self._files
        live, old, undone = f"{self.base}/{table}", f"{self.folder}/old/{table}", f"{self.folder}/undone/{table}"
        files.make(undone)
        there, before, gone = (set(files.names(folder)) for folder in (live, old, undone))
        for month, has_rows in months:
            if has_rows and month in there and month not in gone:
                files.move(f"{live}/{month}", f"{undone}/{month}")
            if month in before:
                files.move(f"{old}/{month}", f"{live}/{month}")


def loads(spark: SparkSession, base: str) -> list[Load]:
    """All loads of the base in their order; a line for each, no row of a table."""
    files, out = _Files(spark), []
    for name in files.names(f"{base}/{FOLDER}"):
        folder = f"{base}/{FOLDER}/{name}"
        load = Load(spark, base, folder, name.split("-", 1)[1])
        if files.exists(f"{folder}/{PLAN}"):
            load.plan = json.loads(files.read(f"{folder}/{PLAN}"))["tables"]
        out.append(load)
    return out


def resume(spark: SparkSession, base: str) -> list[str]:
    """Finish what a stopped driver left: staged loads are put in place, begun undoing goes on, loads
    without a plan are removed. Returns the names of the loads finished."""
    files, done = _Files(spark), []
    for load in loads(spark, base):
        state = load.state
        if state == "open":
            tables.drop_folders(spark, [load.folder])
        elif state == "staged":
            load.finish()
            done.append(load.name)
        elif state == "published" and files.exists(f"{load.folder}/UNDOING"):
            load.undo()
    return done


def replace_folder(spark: SparkSession, made: str, path: str) -> None:
    """Put the folder ``made`` in place of what ``path``, a name as Spark's writers take it, holds."""
    files = _Files(spark)
    source, target = files._at(made), files._name(path)
    fs = source.getFileSystem(files._conf)
    if fs.exists(target) and not fs.delete(target, True):
        raise OSError(f"could not remove {path}")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {made} to {path}")


def plain_name(name: str) -> str:
    """A load's name as the journal writes it."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", name)


def begin(spark: SparkSession, base: str, name: str) -> Load | None:
    """A new load, after what earlier ones left is finished; nothing if one of this name is in place."""
    name = plain_name(name)
    resume(spark, base)
    known = loads(spark, base)
    if any(load.name == name and load.state == "published" for load in known):
        return None
    number = 1 + max((int(load.folder.rsplit("/", 1)[1].split("-")[0]) for load in known), default=0)
    load = Load(spark, base, f"{base}/{FOLDER}/{number:08d}-{name}", name)
    load._files.make(load.folder)
    return load


def undo_after(spark: SparkSession, base: str, name: str | None) -> list[str]:
    """Undo every load after the one named (all, for None), the last first; their names."""
    resume(spark, base)
    known, undone = loads(spark, base), []
    if name is not None and name not in [load.name for load in known if load.state == "published"]:
        raise ValueError(f"no load {name} in place")
    for load in reversed(known):
        if load.name == name and load.state == "published":
            break
        if load.state == "published":
            load.undo()
            undone.append(load.name)
    return undone


def forget(spark: SparkSession, base: str, name: str) -> None:
    """Remove what loads up to the one named keep for undoing; the journal's lines stay."""
    for load in loads(spark, base):
        tables.drop_folders(spark, [f"{load.folder}/{kind}" for kind in ("old", "undone", "new")])
        if load.name == name:
            return


def history(spark: SparkSession, base: str) -> DataFrame:
    """(number, load, state, table, month) of all loads, read from the journal alone."""
    lines = [
        (int(load.folder.rsplit("/", 1)[1].split("-")[0]), load.name, load.state, table, int(month))
        for load in loads(spark, base) for table, months in load.plan.items() for month in months
    ]
    return spark.createDataFrame(lines, "number int, load string, state string, table string, month int")
