"""Predictions against actual faults: labels, confusion counts, threshold search, scoreboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The term kept in every denominator, and the searched thresholds in hundredths.
EPSILON = 1e-9
FIRST_THRESHOLD, LAST_THRESHOLD = 10, 89


def threshold_label(df: DataFrame, probability: str, threshold: float, name: str = "predicted") -> DataFrame:
    """1 where the probability is above the threshold; a missing one is not."""
    p = F.col(probability)
    above = (p > F.lit(threshold)) & ~F.isnan(p)
    return df.withColumn(name, F.coalesce(above, F.lit(False)).cast("int"))


def merge_predictions(predicted: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Each prediction beside the actual value of the same feeder and period."""
    return predicted.join(actual, keys, "inner")


def outcomes(predicted: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """One row per predicted or actual fault: ``correct``, ``missed`` or ``false_alarm``.

    Both inputs hold the keys of positive cases only, each at most once.
    """
    a = predicted.select(*keys, F.lit(1).alias("p"))
    b = actual.select(*keys, F.lit(1).alias("t"))
    outcome = (
        F.when(F.col("p").isNull(), "missed").when(F.col("t").isNull(), "false_alarm").otherwise("correct")
    )
    return a.join(b, keys, "full").select(*keys, outcome.alias("outcome"))


def scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision = tp / (tp + fp + F.lit(EPSILON))
    recall = tp / (tp + fn + F.lit(EPSILON))
    f1 = F.lit(2.0) * (precision * recall) / (precision + recall + F.lit(EPSILON))
    return {"precision": precision, "recall": recall, "f1_score": f1}


def confusion(classified: DataFrame, by: list[str]) -> DataFrame:
    """Counts and precision, recall and F1 per group of an ``outcomes`` table."""
    counts = classified.groupBy(*by).agg(
        F.count_if(F.col("outcome") == "correct").alias("correct_predictions"),
        F.count_if(F.col("outcome") == "missed").alias("missed_failures"),
        F.count_if(F.col("outcome") == "false_alarm").alias("incorrect_predictions"),
    )
    tp, fn, fp = (
        F.col(c) for c in ("correct_predictions", "missed_failures", "incorrect_predictions")
    )
    return counts.withColumns(scores(tp, fp, fn))


def threshold_table(df: DataFrame, probability: str, label: str, by: list[str]) -> DataFrame:
    """Confusion counts and scores at all 80 thresholds, reading every row once.

    A row counts as predicted for each threshold below its probability, so it is enough to know
    the highest such threshold. Rows are counted per group and highest threshold (at most 81 small
    rows a group, combined map-side), and a running total from the top gives every threshold. The
    table is never multiplied by the thresholds, and what produced it runs once.
    """
    p = F.col(probability)
    near = F.floor(p * 100).cast("int")
    highest = (
        F.when(p > (near + 1) / F.lit(100.0), near + 1).when(p > near / F.lit(100.0), near).otherwise(near - 1)
    )
    step = F.least(F.greatest(highest, F.lit(FIRST_THRESHOLD - 1)), F.lit(LAST_THRESHOLD))
    hits = df.groupBy(*by, step.alias("step")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    group = by or [F.lit(1)]
    every = Window.partitionBy(*group)
    above = every.orderBy(F.col("step").desc())
    found = F.map_from_entries(F.collect_list(F.struct("step", F.struct("pos", "neg"))))
    steps = F.explode(F.sequence(F.lit(FIRST_THRESHOLD - 1), F.lit(LAST_THRESHOLD)))
    listed = hits.groupBy(*by).agg(found.alias("found")).select(*by, "found", steps.alias("step"))
    at_step = F.try_element_at("found", F.col("step"))
    counted = listed.select(
        *by, "step", *[F.coalesce(at_step[c], F.lit(0)).alias(c) for c in ("pos", "neg")]
    )
    totals = counted.select(
        *by,
        "step",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        (F.sum("pos").over(every) - F.sum("pos").over(above)).alias("fn"),
    ).filter(F.col("step") >= FIRST_THRESHOLD)
    return totals.select(
        *by, (F.col("step") / F.lit(100.0)).alias("threshold"), "tp", "fp", "fn",
        *[c.alias(n) for n, c in scores(F.col("tp"), F.col("fp"), F.col("fn")).items()],
    )


def best_threshold(df: DataFrame, probability: str, label: str, by: list[str] | None = None) -> DataFrame:
    """The threshold with the best F1, overall or per group; the lowest wins a tie."""
    by = by or []
    table = threshold_table(df, probability, label, by)
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.col("f1_score").desc(), "threshold")
    return table.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def choose_by_folds(scored: DataFrame, probability: str, label: str, held_out: int) -> DataFrame:
    """One row per model: the threshold of the best mean F1 over all folds but ``held_out``, that mean, and
    the F1 which the model at this threshold has on the fold held out.

    ``chosen`` marks the model of the best mean; the held-out fold has no part in the choice. Ties go to the
    lowest threshold and to the first name. All but the first count works on 80 rows a model and fold.
    """
    table = threshold_table(scored, probability, label, ["model", "fold"])
    means = table.filter(F.col("fold") != held_out).groupBy("model", "threshold").agg(
        F.avg("f1_score").alias("mean_f1"))
    order = Window.partitionBy("model").orderBy(F.col("mean_f1").desc(), "threshold")
    best = means.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")
    later = table.filter(F.col("fold") == held_out).select(
        "model", "threshold", F.col("f1_score").alias("held_out_f1"))
    first = Window.orderBy(F.col("mean_f1").desc(), "model")
    return best.join(later, ["model", "threshold"], "left").withColumn("chosen", F.row_number().over(first) == 1)


def mean_f1(evaluation: DataFrame) -> DataFrame:
    return evaluation.agg(F.avg("f1_score").alias("mean_f1"))


def scoreboard(classified: DataFrame, by: list[str]) -> DataFrame:
    """Confusion table with the score (TP - FP) / (TP + FN) in percent."""
    tp, fn, fp = (
        F.col(c) for c in ("correct_predictions", "missed_failures", "incorrect_predictions")
    )
    return confusion(classified, by).withColumn(
        "score_percent", F.try_divide((tp - fp) * 100, tp + fn)
    )
