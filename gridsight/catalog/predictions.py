"""Evaluation of scores, segments, the fault classifier and forecasts on the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsight.catalog.bindings import Tables, billing, sql_total, weekly_scores, with_views
from gridsight.catalog.features import labelled, panel_of, panel_sql, sequence_sql, service_rows
from gridsight.catalog.registry import query
from gridsight.functions.measures import Measure, aggregate
from gridsight.operators import evaluation as ev, learning, panel
from gridsight.operators.joins import stored
from gridsight.session import new_folder
from gridsight.sources import extracts

SCORES_SQL = """CAST(tp AS DOUBLE) / (tp + fp + CAST(1e-9 AS DOUBLE)) AS precision,
  CAST(tp AS DOUBLE) / (tp + fn + CAST(1e-9 AS DOUBLE)) AS recall"""


def scored_sql(source: str, keys: str) -> str:
    """Precision, recall and F1 of a table with keys, tp, fp and fn."""
    return f"""SELECT {keys}tp, fp, fn, precision, recall,
  CAST(2 AS DOUBLE) * (precision * recall) / (precision + recall + CAST(1e-9 AS DOUBLE)) AS f1_score
FROM (SELECT *, {SCORES_SQL} FROM ({source}))"""


OUTCOMES_SQL = """SELECT feeder, week, CASE WHEN probability > CAST({t} AS DOUBLE) AND fault = 1 THEN 'correct'
  WHEN fault = 1 THEN 'missed' ELSE 'false_alarm' END AS outcome FROM weekly_scores
  WHERE probability > CAST({t} AS DOUBLE) OR fault = 1"""

CONFUSION_SQL = """SELECT {keys}count(*) FILTER (WHERE outcome = 'correct') AS tp,
  count(*) FILTER (WHERE outcome = 'false_alarm') AS fp,
  count(*) FILTER (WHERE outcome = 'missed') AS fn FROM ({outcomes}) GROUP BY ALL"""


def confusion_sql(outcomes: str, keys: str) -> str:
    return f"""SELECT {keys}tp AS correct_predictions, fn AS missed_failures, fp AS incorrect_predictions,
  precision, recall, f1_score FROM ({scored_sql(CONFUSION_SQL.format(keys=keys, outcomes=outcomes), keys)})"""


def outcomes_at(scores: DataFrame, threshold: float) -> DataFrame:
    flagged = ev.threshold_label(scores, "probability", threshold)
    return ev.outcomes(flagged.filter("predicted = 1"), scores.filter("fault = 1"), ["feeder", "week"])


@query("threshold_label", with_views(["weekly_scores"], """SELECT feeder, week, probability, fault,
  CASE WHEN probability > CAST(0.24 AS DOUBLE) THEN 1 ELSE 0 END AS predicted FROM weekly_scores"""))
def _(t):
    return ev.threshold_label(weekly_scores(t), "probability", 0.24)


@query("merge_pred_actual", with_views(["weekly_scores"],
    "SELECT feeder, week, probability, fault FROM weekly_scores"))
def _(t):
    scores = weekly_scores(t)
    return ev.merge_predictions(
        scores.select("feeder", "week", "probability"), scores.select("feeder", "week", "fault"),
        ["feeder", "week"],
    )


@query("pred_actual_membership", with_views(["weekly_scores"], OUTCOMES_SQL.format(t=0.24)))
def _(t):
    return outcomes_at(weekly_scores(t), 0.24)


@query("comparison_lists", with_views(["weekly_scores"], f"""
SELECT DISTINCT outcome, feeder FROM ({OUTCOMES_SQL.format(t=0.31)})"""))
def _(t):
    return outcomes_at(weekly_scores(t), 0.31).select("outcome", "feeder").distinct()


@query("confusion_metrics", with_views(["weekly_scores"], confusion_sql(OUTCOMES_SQL.format(t=0.24), "week, ")))
def _(t):
    return ev.confusion(outcomes_at(weekly_scores(t), 0.24), ["week"])


@query("mean_weekly_f1", with_views(["weekly_scores"], f"""
SELECT avg(f1_score) AS mean_f1 FROM ({confusion_sql(OUTCOMES_SQL.format(t=0.24), "week, ")})"""))
def _(t):
    return ev.mean_f1(ev.confusion(outcomes_at(weekly_scores(t), 0.24), ["week"]))


def sweep_sql(by: str) -> str:
    counts = f"""SELECT {by}hundredths / CAST(100 AS DOUBLE) AS threshold,
  count(*) FILTER (WHERE probability > hundredths / CAST(100 AS DOUBLE) AND fault = 1) AS tp,
  count(*) FILTER (WHERE probability > hundredths / CAST(100 AS DOUBLE) AND fault = 0) AS fp,
  count(*) FILTER (WHERE probability <= hundredths / CAST(100 AS DOUBLE) AND fault = 1) AS fn
  FROM weekly_scores, range(10, 90) r(hundredths) GROUP BY ALL"""
    return scored_sql(counts, f"{by}threshold, ")


@query("threshold_table", with_views(["weekly_scores"], sweep_sql("")))
def _(t):
    return ev.threshold_table(weekly_scores(t), "probability", "fault", [])


@query("threshold_sweep_global", with_views(["weekly_scores"],
    f"SELECT * FROM ({sweep_sql('')}) ORDER BY f1_score DESC, threshold LIMIT 1"))
def _(t):
    return ev.best_threshold(weekly_scores(t), "probability", "fault")


@query("threshold_sweep_weekly", with_views(["weekly_scores"], f"""
SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY week ORDER BY f1_score DESC, threshold)
  AS place FROM ({sweep_sql('week, ')})) WHERE place = 1"""))
def _(t):
    return ev.best_threshold(weekly_scores(t), "probability", "fault", ["week"])


# Decision thresholds of three model variants.
VARIANTS = {"low": 0.24, "middle": 0.31, "high": 0.5}


@query("model_scoreboard", with_views(["weekly_scores"], f"""
SELECT *, CAST((correct_predictions - incorrect_predictions) * 100 AS DOUBLE)
  / nullif(correct_predictions + missed_failures, 0) AS score_percent FROM ({confusion_sql(
  " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({OUTCOMES_SQL.format(t=v)})"
                     for m, v in VARIANTS.items()), "model, ")})"""))
def _(t):
    """One row per model; a model here is the same score cut at another threshold."""
    variants = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(v).alias("cut")) for m, v in VARIANTS.items()
    ])
    rows = weekly_scores(t).select("*", F.inline(variants))
    keys = ["model", "feeder", "week"]
    classified = ev.outcomes(
        rows.filter("probability > cut"), rows.filter("fault = 1"), keys
    )
    return ev.scoreboard(classified, ["model"])


# --- forecasts --------------------------------------------------------------------------------


@query("forecast_scan", f"""SELECT CAST(c_nationkey AS INTEGER) AS ibc, CAST(o_orderdate AS DATE) AS date,
  {sql_total('o_totalprice')} AS billed, {sql_total('floor(o_totalprice)', 0)} AS revenue,
  {sql_total('floor(o_totalprice / 100)', 0)} AS units
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def _(t):
    """Three forecast extracts per centre and day are written, read back as text, and joined."""
    daily = aggregate(
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("c_nationkey").alias("IBC"), F.col("o_orderdate").cast("date").alias("Date"),
            F.col("o_totalprice").alias("a"), F.floor("o_totalprice").alias("b"),
            F.floor(F.col("o_totalprice") / 100).alias("c"),
        ),
        ["IBC", "Date"],
        [Measure("billed", "sum", "a", 2), Measure("revenue", "sum", "b", 0), Measure("units", "sum", "c", 0)],
    )
    folder = new_folder(t.spark, "forecast")
    parts = []
    for kind, value in (("billed", "Predicted Payment"), ("revenue", "Predicted Payment"), ("units", "Predicted Units")):
        path = extracts.export_csv(daily.select("IBC", "Date", F.col(kind).alias(value)), f"{folder}/{kind}")
        rows = extracts.scan_delimited(t.spark, path, ["IBC", "Date", value])
        parts.append(rows.select(
            F.col("IBC").try_cast("int").alias("ibc"), F.col("Date").try_cast("date").alias("date"),
            F.col(f"`{value}`").try_cast("double").alias(kind),
        ))
    return parts[0].join(parts[1], ["ibc", "date"]).join(parts[2], ["ibc", "date"])


# --- models (no SQL twin) ---------------------------------------------------------------------

SEGMENT_FEATURES = ["amount", "units", "bills", "sanctioned_load"]


def consumers(t: Tables) -> DataFrame:
    return aggregate(
        billing(t), ["account"],
        [Measure("amount", "avg", "current_amount", 2), Measure("units", "avg", "current_units", 0),
         Measure("bills", "count", "document"), Measure("sanctioned_load", "min", "sanctioned_load")],
    ).withColumn("bills", F.col("bills").cast("double"))


@query("kmeans_segments")
def _(t):
    """Each consumer's segment out of three, by billing measures."""
    rows = consumers(t)
    fitted = learning.fit_segments(rows, SEGMENT_FEATURES)
    return fitted.assign(rows).select("account", *SEGMENT_FEATURES, "segment")


@query("kmeans_centres")
def _(t):
    return learning.fit_segments(consumers(t), SEGMENT_FEATURES).centres(t.spark)


@query("silhouette")
def _(t):
    rows = consumers(t)
    value = learning.silhouette(learning.fit_segments(rows, SEGMENT_FEATURES).assign(rows))
    return rows.groupBy().agg(F.count("account").alias("consumers")).withColumn("silhouette", F.lit(value))


CUT = "2000-07-01"


def _model(t: Tables, length: int = 12):
    """A classifier trained on the months before the cut, and the scaler fitted on them."""
    rows = labelled(t, "month").withColumn("month_number", F.month("period"))
    features = ["n", "amount", "fault", "month_number"]
    scaler = learning.MinMaxScale.fit(rows.filter(F.col("period") < CUT), features)
    sequences = panel.sliding_sequences(
        scaler.transform(rows), "feeder", "period", features, "target", length
    )
    # The label lies two periods after the last input, so the cut leaves room for it.
    train = sequences.filter(F.col("last_period") < F.add_months(F.lit(CUT).cast("date"), -2))
    return learning.fit_fault_classifier(train), scaler, features, sequences


@query("fault_classifier")
def _(t):
    """Probability and actual label for every sequence after the training months."""
    model, _, _, sequences = _model(t)
    return learning.score_batch(model, sequences.filter(F.col("last_period") >= CUT))


@query("batch_scoring")
def batch_scoring(t):
    """One probability per feeder for each of three target months, from its latest history."""
    model, scaler, features, _ = _model(t)
    rows = panel_of(service_rows(t), "month").withColumn("month_number", F.month("period"))
    targets = ["2001-01-01", "2001-02-01", "2001-03-01"]
    latest = panel.latest_sequences(
        scaler.transform(rows), "feeder", "period", features, targets, 12
    )
    return learning.score_batch(model, latest)


FOLDS = ["1999-07-01", "2000-01-01", "2000-07-01", "2001-01-01"]
MODELS = {"regression": learning.fit_fault_classifier, "trees": learning.fit_boosted_trees}


def _rules(held: DataFrame) -> DataFrame:
    """What a model must beat: the last period's flag, and a fault in every period."""
    folds = F.element_at(F.filter(F.array(*[
        F.struct(F.lit(i).alias("fold"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b"))
        for i, (a, b) in enumerate(zip(FOLDS, FOLDS[1:]))]),
        lambda f: (F.col("last_period") >= f["a"]) & (F.col("last_period") < f["b"])), 1)["fold"]
    rows = held.filter((F.col("last_period") >= FOLDS[0]) & (F.col("last_period") < FOLDS[-1])).withColumn("fold", folds)
    rules = F.array(
        F.struct(F.lit("last_flag").alias("model"), F.element_at("sequence", -1)[2].alias("predicted_probability")),
        F.struct(F.lit("always").alias("model"), F.lit(1.0).alias("predicted_probability")))
    return rows.select("feeder", "last_period", "label", "fold", F.inline(rules))


def _histories(t: Tables) -> DataFrame:
    rows = labelled(t, "month").withColumn("month_number", F.month("period"))
    features = ["n", "amount", "fault", "month_number"]
    scaler = learning.MinMaxScale.fit(
        rows.filter(F.col("period") < FOLDS[0]), ["n", "amount", "month_number"])
    return stored(panel.sliding_sequences(
        scaler.transform(rows), "feeder", "period", features, "target", 12), "sequences")


@query("rolling_evaluation")
def _(t):
    """Two models and two simple rules over three half years, the last of them held out of the choice."""
    sequences = _histories(t)
    scored = stored(learning.rolling_scores(sequences, "last_period", FOLDS, MODELS).unionByName(_rules(sequences)), "scored")
    return ev.choose_by_folds(scored, "predicted_probability", "label", len(FOLDS) - 2)


@query("rolling_rules", f"""WITH {panel_sql('service', 'month')},
ended AS (SELECT feeder, period AS last_period, fault, {sequence_sql(12)} AS s,
  lead(target) OVER (PARTITION BY feeder ORDER BY period) AS label FROM labelled),
held AS (SELECT *, CASE WHEN last_period < DATE '{FOLDS[1]}' THEN 0 WHEN last_period < DATE '{FOLDS[2]}' THEN 1 ELSE 2 END AS fold
  FROM ended WHERE len(s) = 12 AND label IS NOT NULL AND last_period >= DATE '{FOLDS[0]}' AND last_period < DATE '{FOLDS[3]}'),
told AS (SELECT 'last_flag' AS model, fold, fault AS p, label FROM held
  UNION ALL SELECT 'always', fold, 1, label FROM held),
counts AS (SELECT model, fold, count(*) FILTER (WHERE p = 1 AND label = 1) AS tp,
  count(*) FILTER (WHERE p = 1 AND label = 0) AS fp, count(*) FILTER (WHERE p = 0 AND label = 1) AS fn FROM told GROUP BY 1, 2),
means AS (SELECT model, avg(f1_score) FILTER (WHERE fold <> 2) AS mean_f1, max(f1_score) FILTER (WHERE fold = 2) AS held_out_f1
  FROM ({scored_sql('SELECT * FROM counts', 'model, fold, ')}) GROUP BY 1)
SELECT model, CAST(0.1 AS DOUBLE) AS threshold, mean_f1, held_out_f1,
  row_number() OVER (ORDER BY mean_f1 DESC, model) = 1 AS chosen FROM means""")
def _(t):
    """The two rules alone, which SQL can follow."""
    return ev.choose_by_folds(_rules(_histories(t)), "predicted_probability", "label", len(FOLDS) - 2)


@query("outside_model", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN CAST(
  3 * l_quantity - 2 * l_linenumber + floor(l_extendedprice) / 4 + 7 AS DOUBLE) END AS score FROM lineitem""")
def _(t):
    """A stored model from outside Spark over every line; lines without a price have no score."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_linenumber") != 3, F.floor("l_extendedprice")).alias("price"))
    path = learning.store_linear(t.spark, {"quantity": 3, "line": -2, "price": 0.25}, 7, new_folder(t.spark, "model"))
    return learning.score_with(rows, ["price", "quantity", "line"], path).drop("quantity", "line", "price")


# --- what SQL can know of the models' results -------------------------------------------------

CONSUMERS_SQL = f"""SELECT account, {sql_total('current_amount')} / count(current_amount) AS amount,
  {sql_total('current_units', 0)} / count(current_units) AS units, CAST(count(document) AS DOUBLE) AS bills,
  CASE WHEN CAST(account AS BIGINT) % 40 <> 7 THEN min(sanctioned_load) END AS sanctioned_load
FROM billing GROUP BY account"""


def _gappy_consumers(t: Tables) -> DataFrame:
    """Consumers of whom some have no sanctioned load."""
    missing = F.col("account").cast("bigint") % 40 == 7
    return consumers(t).withColumn("sanctioned_load", F.when(~missing, F.col("sanctioned_load")))


@query("kmeans_segments_facts", with_views(["billing"], f"SELECT *, TRUE AS placed FROM ({CONSUMERS_SQL})"))
def _(t):
    """Every consumer once; a segment from 0 to 2 for those with all measures, none for others."""
    rows = _gappy_consumers(t)
    assigned = learning.fit_segments(rows, SEGMENT_FEATURES).assign(rows)
    placed = F.when(F.col("sanctioned_load").isNull(), F.col("segment").isNull()).otherwise(
        F.col("segment").between(0, 2))
    return assigned.select("account", *SEGMENT_FEATURES, placed.alias("placed"))


@query("kmeans_centres_facts", "SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS segment, TRUE AS is_mean")
def _(t):
    """Each centre is the mean of its members' scaled measures."""
    rows = _gappy_consumers(t)
    fitted = learning.fit_segments(rows, SEGMENT_FEATURES)
    members = fitted.assign(rows).filter("segment IS NOT NULL").select(
        "segment", F.posexplode(learning.vector_to_array("features")).alias("place", "value"))
    means = members.groupBy("segment", "place").agg(F.avg("value").alias("mean"))
    centres = fitted.centres(t.spark).select("segment", F.posexplode("centre").alias("place", "value"))
    return centres.join(means, ["segment", "place"]).groupBy("segment").agg(
        F.every(F.abs(F.col("value") - F.col("mean")) < 0.01).alias("is_mean"))


@query("silhouette_facts", with_views(["billing"],
    f"SELECT count(sanctioned_load) AS consumers, TRUE AS in_range FROM ({CONSUMERS_SQL})"))
def _(t):
    rows = _gappy_consumers(t)
    assigned = learning.fit_segments(rows, SEGMENT_FEATURES).assign(rows)
    value = learning.silhouette(assigned)
    return assigned.agg(F.count("segment").alias("consumers")).withColumn("in_range", F.lit(-1 <= value <= 1))


def _in_range():
    return F.col("predicted_probability").between(0, 1).alias("in_range")


@query("fault_classifier_facts", f"""WITH {panel_sql('service', 'month')}
SELECT feeder, last_period, label, TRUE AS in_range FROM (
  SELECT feeder, period AS last_period, {sequence_sql(12)} AS s,
    lead(target) OVER (PARTITION BY feeder ORDER BY period) AS label FROM labelled)
WHERE len(s) = 12 AND label IS NOT NULL AND last_period >= DATE '{CUT}'""")
def _(t):
    """Every sequence after the training months is scored once."""
    model, _, _, sequences = _model(t)
    scored = learning.score_batch(model, sequences.filter(F.col("last_period") >= CUT))
    return scored.select("feeder", "last_period", "label", _in_range())


BATCH_TARGETS = ["2001-01-01", "2001-02-01", "2001-03-01"]


@query("batch_scoring_facts", f"""WITH {panel_sql('service', 'month')},
targets AS (SELECT CAST(unnest({BATCH_TARGETS}) AS DATE) AS target_period),
history AS (SELECT feeder, target_period, period AS last_period, s, row_number() OVER (
    PARTITION BY feeder, target_period ORDER BY period DESC) AS back
  FROM (SELECT *, {sequence_sql(12)} AS s FROM panel) JOIN targets ON period < target_period)
SELECT feeder, target_period, last_period, TRUE AS in_range FROM history WHERE back = 1 AND len(s) = 12""")
def _(t):
    """Every feeder with a history is scored once for each target month."""
    return batch_scoring(t).select("feeder", "target_period", "last_period", _in_range())
