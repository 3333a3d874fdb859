"""Scaling, encoding, segments, and the fault classifier, on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DoubleType

from gridsight.session import new_folder, shared_dir
from gridsight.sources import tables


@dataclass(frozen=True)
class MinMaxScale:
    """Ranges learned on one table (the training part) and applied to any other."""

    ranges: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, train: DataFrame, columns: list[str]) -> "MinMaxScale":
        ends = [F.min(c).alias(f"lo#{c}") for c in columns] + [F.max(c).alias(f"hi#{c}") for c in columns]
        row = train.agg(*ends).first()
        return cls({c: (row[f"lo#{c}"], row[f"hi#{c}"]) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        """Each column to [0, 1] by its range; a constant column becomes 0."""

        def scaled(c: str) -> Column:
            lo, hi = self.ranges[c]
            if lo is None or lo == hi:
                return F.when(F.col(c).isNotNull(), F.lit(0.0))
            return (F.col(c) - F.lit(float(lo))) / F.lit(float(hi) - float(lo))

        return df.withColumns({c: scaled(c) for c in self.ranges})


ROW_BITS = 33  # monotonically_increasing_id() keeps the row within its partition in these bits


def _positions(df: DataFrame, order: list, name: str) -> DataFrame:
    """Rows with their place from 0 in the given order, found by a distributed sort.

    Spark sorts by range, so a row's place is its place within its partition plus the sizes of
    the partitions before. The sorted rows are checkpointed: computed anew, they could be cut
    into other ranges. Only one line per partition is broadcast.
    """
    shared_dir(df.sparkSession)
    numbered = df.orderBy(*order).withColumn("slot", F.monotonically_increasing_id()).checkpoint()
    rows = numbered.withColumns(
        {
            "part": F.shiftright("slot", ROW_BITS),
            "inside": F.col("slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
        }
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    )
    placed = rows.join(F.broadcast(before), "part")
    return placed.select(*df.columns, (F.col("start") + F.col("inside")).alias(name))


BROADCAST_BYTES = 32 << 20
ROW_BYTES = 16


def _bytes(text: str) -> Column:
    """Size of a table of labels with their codes."""
    return F.coalesce(F.sum(F.octet_length(text) + ROW_BYTES), F.lit(0))


def _join_codes(df: DataFrame, codes: DataFrame, on: str, size: int) -> DataFrame:
    """Broadcast the codes when their measured size allows; else adaptive execution splits the
    rows of a frequent value."""
    return df.join(F.broadcast(codes) if size <= BROADCAST_BYTES else codes, on, "left")


def encode_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column's text by its place among the column's sorted distinct values.

    NULL is the category ``nan``. The distinct values of all columns are found in one pass and
    sorted by Spark.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns}
    labels = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("field"), text[c].alias("label")) for c in columns])
        ).alias("entry")
    ).select("entry.*").distinct()
    codes = _positions(labels, ["field", "label"], "place")
    first = codes.groupBy("field").agg(F.min("place").alias("first"), _bytes("label").alias("size"))
    starts = {r["field"]: r for r in first.collect()}  # one row per column
    out = df.withColumns({c: text[c] for c in columns})
    for c in columns:
        if c not in starts:
            continue
        table = codes.filter(F.col("field") == c).select(
            F.col("label").alias(c), (F.col("place") - starts[c]["first"]).alias(f"{c}#code")
        )
        out = _join_codes(out, table, c, starts[c]["size"]).drop(c).withColumnRenamed(f"{c}#code", c)
    return out.select(*df.columns)


CODES = "field string, label string, code bigint"


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """The code table at ``path``, empty before the first ``extend_codes``."""
    if not tables.holds_files(spark, path):
        return spark.createDataFrame([], CODES)
    return spark.read.schema(CODES).parquet(path)


def _labels(df: DataFrame, columns: list[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("field"), _label(c).alias("label")) for c in columns])
    return df.select(F.explode(entries).alias("entry")).select("entry.*")


def _label(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def extend_codes(df: DataFrame, columns: list[str], path: str, by_count: bool = False) -> str:
    """Give the values that the code table at ``path`` lacks the next codes of their column.

    The first call fits the table (codes from 0, in the order of the values, or by falling frequency with
    ``by_count``). Later calls only append: a code once given stays, whatever table comes next. A call
    repeated, or begun again after a loss, adds what is missing. One call runs at a time. Values are
    found and sorted by Spark; one row a column reaches the driver.
    """
    spark = df.sparkSession
    known = read_codes(spark, path)
    counted = _labels(df, columns).groupBy("field", "label").agg(F.count(F.lit(1)).alias("n"))
    new = counted.join(known, ["field", "label"], "left_anti")
    order = ["field", F.col("n").desc(), "label"] if by_count else ["field", "label"]
    placed = _positions(new, order, "place")
    starts = placed.groupBy("field").agg(F.min("place").alias("first"))
    used = known.groupBy("field").agg((F.max("code") + 1).alias("used"))
    shifts = starts.join(used, "field", "left").select(
        "field", (F.coalesce("used", F.lit(0)) - F.col("first")).alias("shift"))
    coded = placed.join(F.broadcast(shifts), "field").select(
        "field", "label", (F.col("place") + F.col("shift")).alias("code"))
    coded.write.mode("append").parquet(path)
    return path


def apply_codes(df: DataFrame, columns: list[str], path: str, unseen: int = -1) -> DataFrame:
    """Each column's values replaced by their codes; a value that the table lacks becomes ``unseen``."""
    codes = read_codes(df.sparkSession, path).filter(F.col("field").isin(columns))
    sizes = {r["field"]: r["size"] for r in codes.groupBy("field").agg(_bytes("label").alias("size")).collect()}
    out = df.withColumns({c: _label(c) for c in columns})
    for c in columns:
        table = codes.filter(F.col("field") == c).select(F.col("label").alias(c), F.col("code").alias(f"{c}#code"))
        out = _join_codes(out, table, c, sizes.get(c, 0)).withColumn(c, F.coalesce(f"{c}#code", F.lit(unseen).cast("bigint")))
        out = out.drop(f"{c}#code")
    return out.select(*df.columns)


def index_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """Index of each key by falling frequency, ties by the key's text, starting at 0.

    There may be as many keys as accounts, so they are never collected.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.select(column, "n", F.col(column).cast("string").alias("text"))
    placed = _positions(ordered, [F.col("n").desc(), "text"], name)
    size = placed.agg(_bytes("text")).first()[0]
    return _join_codes(df, placed.select(column, name), column, size)


@dataclass(frozen=True)
class Segments:
    scaling: PipelineModel
    clusters: KMeansModel
    measures: tuple[str, ...]

    def assign(self, df: DataFrame) -> DataFrame:
        placed = self.clusters.transform(self.scaling.transform(df.filter(_present(self.measures))))
        return placed.unionByName(df.filter(~_present(self.measures)), allowMissingColumns=True)

    def centres(self, spark) -> DataFrame:
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.clusters.clusterCenters())]
        return spark.createDataFrame(rows, "segment int, centre array<double>")


def fit_segments(df: DataFrame, features: list[str], k: int = 3, seed: int = 1) -> Segments:
    """KMeans over standardised billing measures (not over an id, which has no distance), fitted on the
    rows that have all of them; a row without one is kept by ``assign`` and has no segment."""
    scaling = Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="measures", handleInvalid="error"),
            StandardScaler(inputCol="measures", outputCol="features", withMean=True),
        ]
    ).fit(df.filter(_present(features)))
    clusters = KMeans(k=k, seed=seed, maxIter=100, featuresCol="features", predictionCol="segment")
    return Segments(scaling, clusters.fit(scaling.transform(df.filter(_present(features)))), tuple(features))


def _present(features) -> Column:
    """Whether a row has every feature, as a number."""
    return reduce(lambda a, b: a & b, [
        F.col(c).isNotNull() & ~F.isnan(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in features])


def silhouette(assigned: DataFrame) -> float:
    """Over the rows that have a segment."""
    rows = assigned.filter(F.col("segment").isNotNull())
    return ClusteringEvaluator(featuresCol="features", predictionCol="segment").evaluate(rows)


def flat_features(sequences: DataFrame, column: str = "sequence") -> DataFrame:
    """A sequence of feature arrays as one vector, oldest period first."""
    return sequences.withColumn("features", array_to_vector(F.flatten(column)))


def fit_fault_classifier(sequences: DataFrame, label: str = "label", **settings):
    """Probability that the feeder faults, from its flattened history."""
    model = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=settings.pop("maxIter", 25), **settings
    )
    rows = flat_features(sequences).withColumn(label, F.col(label).cast("double"))
    # The training summary refers to the session, which tasks cannot take once rows were observed in it.
    path = new_folder(sequences.sparkSession, "model")
    model.fit(rows.select("features", label)).save(path)
    return LogisticRegressionModel.load(path)


def fit_boosted_trees(sequences: DataFrame, label: str = "label", **settings):
    """The same probability from boosted trees, which see thresholds and pairs of features."""
    settings = {"maxIter": 15, "maxDepth": 3, "seed": 1} | settings
    model = GBTClassifier(featuresCol="features", labelCol=label, **settings)
    rows = flat_features(sequences).withColumn(label, F.col(label).cast("double"))
    return model.fit(rows.select("features", label))


def rolling_scores(
    sequences: DataFrame, at: str, cuts: list[str], fits: dict[str, Callable], gap_months: int = 2
) -> DataFrame:
    """Every model's score of the rows of each fold, fitted on what was known before it.

    Fold ``i`` holds the sequences that end from ``cuts[i]`` to before ``cuts[i + 1]``. Its training rows
    end ``gap_months`` earlier, so that their labels lie before the cut. ``fits`` maps a name to a function of the
    training rows, which gives a model of Spark ML. A model is fitted once a fold.
    """
    parts = []
    for fold, (start, end) in enumerate(zip(cuts, cuts[1:])):
        known = sequences.filter(F.col(at) < F.add_months(F.lit(start).cast("date"), -gap_months))
        held = sequences.filter((F.col(at) >= F.lit(start).cast("date")) & (F.col(at) < F.lit(end).cast("date")))
        for name, fit in fits.items():
            scored = score_batch(fit(known), held)
            parts.append(scored.withColumns({"model": F.lit(name), "fold": F.lit(fold)}))
    return reduce(DataFrame.unionByName, parts)


def score_batch(model, sequences: DataFrame) -> DataFrame:
    """One probability per input row, beside the ids the row came with."""
    scored = model.transform(flat_features(sequences))
    probability = F.get(vector_to_array("probability"), F.lit(1)).alias("predicted_probability")
    return scored.select(*[c for c in sequences.columns if c != "sequence"], probability)


MODEL_BYTES = 256 << 20


def store_linear(spark: SparkSession, weights: dict[str, float], intercept: float, path: str) -> str:
    """A linear model as one JSON line a feature, to be scored by ``score_with`` and ``linear_model``."""
    lines = [(name, float(w)) for name, w in weights.items()] + [(None, float(intercept))]
    spark.createDataFrame(lines, "feature string, weight double").coalesce(1).write.json(path)
    return path


def linear_model(content: bytes, features: list[str]) -> Callable[[np.ndarray], np.ndarray]:
    """The model that ``store_linear`` wrote, over features in the given order."""
    lines = [json.loads(line) for line in content.decode().splitlines()]
    weights = {line.get("feature"): line["weight"] for line in lines}
    if set(weights) - {None} != set(features):
        raise ValueError(f"the model takes {sorted(set(weights) - {None})}, not {sorted(features)}")
    along, intercept = np.array([weights[f] for f in features]), weights[None]
    return lambda rows: rows @ along + intercept


def score_with(
    df: DataFrame,
    features: list[str],
    path: str,
    load: Callable[[bytes, list[str]], Callable[[np.ndarray], np.ndarray]] = linear_model,
    name: str = "score",
    batch: int = 4096,
) -> DataFrame:
    """``name``: the score of a stored model from outside Spark, NULL where a feature is missing.

    ``load`` makes the model of the bytes stored at ``path``, once a Python worker; the model maps a
    batch of rows (a matrix, one column a feature) to one number each. The bytes reach the
    executors by broadcast, up to ``MODEL_BYTES``.
    """
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    size, count = files.agg(F.sum("length"), F.count("*")).first()
    if count != 1 or size > MODEL_BYTES:
        raise ValueError(f"{path} holds {count} files of {size} bytes, not one model of {MODEL_BYTES} at most")
    content = spark.sparkContext.broadcast(bytes(files.select("content").first()[0]))
    names = list(features)
    score = predict_batch_udf(
        lambda: load(content.value, names), return_type=DoubleType(), batch_size=batch,
        input_tensor_shapes=[[len(names)]])
    inputs = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])
    return df.withColumn(name, F.when(_present(names), score(inputs)))
