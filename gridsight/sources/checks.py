"""Rules on rows, counted by the job that writes them.

A row that breaks a rule goes to the quarantine beside the kept rows, with the names of the rules it
breaks. The counts come from the writing job itself (``Observation``), so the source is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

STATE, KEPT, QUARANTINED = "check_state", "kept", "quarantined"
BROKEN = "broken_rules"


@dataclass(frozen=True)
class Rule:
    """``holds`` is true for a good row (NULL counts as broken); ``most`` is the largest share of the rows
    that may break it before the load as a whole is refused."""

    name: str
    holds: Column
    most: float = 1.0


@dataclass(frozen=True)
class Checked:
    """A checked write: where it lies, and how many rows there were and broke each rule."""

    spark: SparkSession
    path: str
    rules: tuple[Rule, ...]
    rows: int
    broken: dict[str, int]
    quarantined_rows: int

    def kept(self) -> DataFrame:
        return self._part(KEPT).drop(BROKEN)

    def quarantined(self) -> DataFrame:
        """Rows that broke a rule, with the names of all they broke in ``broken_rules``."""
        return self._part(QUARANTINED)

    def _part(self, state: str) -> DataFrame:
        return self.spark.read.parquet(self.path).filter(F.col(STATE) == state).drop(STATE)

    def refused(self) -> list[str]:
        """Rules that more rows broke than their bound allows."""
        return [r.name for r in self.rules if self.broken[r.name] > r.most * self.rows]

    def report(self) -> DataFrame:
        """One row per rule."""
        refused = set(self.refused())
        lines = [(r.name, self.rows, self.broken[r.name], float(r.most), r.name not in refused) for r in self.rules]
        return self.spark.createDataFrame(
            lines, "rule string, rows bigint, broken bigint, most double, within_bound boolean")


class TooManyBroken(ValueError):
    """A load of which too many rows break a rule."""


def checked_write(df: DataFrame, path: str, rules: list[Rule], refuse: bool = True) -> Checked:
    """Write ``df`` to the new folder ``path``, good rows and quarantined ones apart, in one job.

    Where a rule's bound is exceeded, ``TooManyBroken`` is raised after the write unless ``refuse`` is
    False: the rows then lie at ``path`` to be looked at, and the caller has published nothing. An empty table keeps every
    bound. Rows stay where they are, so neither state's files are gathered.
    """
    names = [r.name for r in rules]
    if len(set(names)) < len(names):
        raise ValueError("two rules of one name")
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.name)) for r in rules]))
    good = F.size(BROKEN) == 0
    counts = Observation()
    observed = df.withColumn(BROKEN, broken).observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~good).alias("quarantined"),
        *[F.count_if(F.array_contains(BROKEN, name)).alias(f"rule{i}") for i, name in enumerate(names)],
    )
    placed = observed.withColumn(STATE, F.when(good, KEPT).otherwise(QUARANTINED))
    placed.write.partitionBy(STATE).parquet(path)
    try:
        found = counts.get
    except Py4JJavaError:  # Spark left out the reading of a table it knew to be empty
        found = {"rows": 0, "quarantined": 0} | {f"rule{i}": 0 for i in range(len(rules))}
    spark = df.sparkSession
    if not found["rows"]:  # no partition folder tells the columns of an empty table
        placed.write.mode("overwrite").parquet(path)
    checked = Checked(
        spark, path, tuple(rules), found["rows"], {n: found[f"rule{i}"] for i, n in enumerate(names)},
        found["quarantined"])
    if refuse and checked.refused():
        raise TooManyBroken(f"{path}: more rows than allowed break {', '.join(checked.refused())}")
    return checked
