"""Named model queries.  Metric, per-group regression, routing and AR(1)
forecast queries have DuckDB twins.  Queries that fit ``pyspark.ml`` models store
their predictions; what they return (rows, labels, whether recomputed metrics
agree, whether a stated bound holds) is known to SQL, the fitted splits aren't."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from millrace.operators import grouped as G
from millrace.operators import models as M
from millrace.operators.artefact import DeviceFeatureFit
from millrace.plans import anomaly as A
from millrace.plans import device as D
from millrace.plans.common import round_doubles
from millrace.plans.q_anomaly import _WITH as _ANOM_WITH
from millrace.plans.q_device import (FACTORIES, FIXTURE_PRESSURE_MAX, FIXTURE_TEMP_RULES, MODELS, _DEFECT_SQL,
                                     _FEATURE_COLS, _FEATURES_WITH)
from millrace.plans.registry import register
from millrace.session import scratch_path
from millrace.sources.fixtures import duck_with, table as view_table, view
from millrace.sources.io import materialize

ANOMALY_NUMERIC = ["sensor_1", "sensor_2", "sensor_3", "sensor_1_rolling_avg", "sensor_2_rolling_avg",
                   "sensor_3_rolling_avg", "sensor_1_diff", "sensor_2_diff", "sensor_3_diff",
                   "hour_of_day", "day_of_week"]
ANOMALY_CATEGORICAL = ["device_model", "site_name"]


def _features(spark, sf_dir):
    return A.anomaly_feature_table(view(spark, sf_dir, "telemetry"))


@register("classifier_metrics_threshold", _ANOM_WITH + """,
s AS (SELECT CAST(anomaly AS DOUBLE) AS y, CASE WHEN sensor_1 > 80 OR sensor_1 < 10 THEN 1.0 ELSE 0.0 END AS p FROM feat),
c AS (SELECT CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS BIGINT) AS fn,
             CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS BIGINT) AS tn FROM s)
SELECT tp, fp, fn, tn, tp + fp AS predicted_positives,
       round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1,
       round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy FROM c""")
def q_classifier_metrics_threshold(spark, sf_dir):
    """M6: F1 / recall / precision / predicted positives of the hard
    threshold rule against the anomaly label (one aggregate)."""
    f = _features(spark, sf_dir)
    scored = f.select(F.col("anomaly").alias("label"),
                      F.when((F.col("sensor_1") > 80) | (F.col("sensor_1") < 10), 1.0)
                       .otherwise(0.0).alias("prediction"))
    return round_doubles(M.classification_metrics(scored))


_AR1_SQL = duck_with("device") + """,
l AS (SELECT device_id, temperature AS y,
             lag(temperature) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id) AS x FROM device),
f AS (SELECT device_id, regr_count(y, x) AS n_used, regr_intercept(y, x) AS intercept,
             regr_slope(y, x) AS slope FROM l GROUP BY device_id)"""


@register("forecast_ar1", _AR1_SQL + """
SELECT f.device_id, f.n_used, round(f.intercept, 6) AS intercept, round(f.slope, 6) AS slope,
       round(sqrt(avg(power(l.y - (f.intercept + f.slope * l.x), 2))), 6) AS rmse,
       count(l.y - (f.intercept + f.slope * l.x)) AS n_scored
FROM l JOIN f USING (device_id) GROUP BY ALL""")
def q_forecast_ar1(spark, sf_dir):
    """M13 + M7: AR(1) one-step temperature forecast per device, fitted by
    per-device least squares, with its RMSE."""
    dv = view(spark, sf_dir, "device")
    fit = G.forecast_fit(dv, "device_id", D.ORDER, "temperature", p=1, d=0, segment=D.day_segment())
    return round_doubles(fit.select("device_id", "n_used", "intercept", F.col("a1").alias("slope"), "rmse", "n_scored"))


_REG_SQL = _DEFECT_SQL + """,
r AS (SELECT d.model_id, CAST(lab.defect AS DOUBLE) AS y, d.temperature AS x1, CAST(d.density AS DOUBLE) AS x2
      FROM lab JOIN device d USING (event_id)),
m AS (SELECT model_id, count(*) AS n_used, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
             var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12,
             covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM r GROUP BY model_id),
coef AS (SELECT model_id, n_used,
   (s22 * c1 - s12 * c2) / (s11 * s22 - s12 * s12) AS b1,
   (s11 * c2 - s12 * c1) / (s11 * s22 - s12 * s12) AS b2, my, m1, m2 FROM m),
fit AS (SELECT model_id, n_used, my - b1 * m1 - b2 * m2 AS intercept, b1, b2 FROM coef)"""


def _model_fit(spark, sf_dir):
    dv = view(spark, sf_dir, "device")
    lab = D.defects(dv, temp_rules=FIXTURE_TEMP_RULES, pressure_max=FIXTURE_PRESSURE_MAX)
    return lab, G.grouped_least_squares(lab, "model_id", ["temperature", "density"], "defect")


@register("device_model_regression", _REG_SQL + """
SELECT model_id, n_used, round(intercept, 6) AS intercept, round(b1, 6) AS coef_temperature,
       round(b2, 6) AS coef_density FROM fit""")
def q_device_model_regression(spark, sf_dir):
    """One least-squares model per model_id (defect ~ temperature +
    density), from one grouped moment aggregate."""
    _, fit = _model_fit(spark, sf_dir)
    return round_doubles(fit.select("model_id", "n_used", "intercept", "coef_temperature", "coef_density"))


@register("device_model_scores", _REG_SQL + """
SELECT d.event_id, d.model_id, round(f.intercept + f.b1 * d.temperature + f.b2 * CAST(d.density AS DOUBLE), 6) AS prediction,
       CASE WHEN f.intercept + f.b1 * d.temperature + f.b2 * CAST(d.density AS DOUBLE) >= 0.5 THEN 1.0 ELSE 0.0 END
         AS prediction_class
FROM device d LEFT JOIN fit f USING (model_id)""")
def q_device_model_scores(spark, sf_dir):
    """Each reading scored by the model of its model_id, cut at 0.5."""
    lab, fit = _model_fit(spark, sf_dir)
    dv = view(spark, sf_dir, "device")
    s = G.route_and_score(dv, fit, "model_id", ["temperature", "density"], threshold=0.5)
    return round_doubles(s.select("event_id", "model_id", "prediction", "prediction_class"))


def _order_sql() -> str:
    """Closed normal equations for p 0-2 on the d-th differences; one row set for all orders."""
    lagged = ", ".join(f'lag(temperature, {k}) OVER w AS x{k}' for k in range(1, 6))
    diffs = {0: [1], 1: [1, -1], 2: [1, -2, 1], 3: [1, -3, 3, -1]}
    parts = []
    for d, c in diffs.items():
        z = [" + ".join(f"({w}) * x{j + k}" for k, w in enumerate(c)) for j in range(3)]
        parts.append(f"SELECT {d} AS d, device_id, {z[0]} AS z, {z[1]} AS z1, {z[2]} AS z2 FROM l WHERE x5 + x4 + x3 + x2 + x1 + x0 IS NOT NULL")
    return duck_with("device") + f""",
l AS (SELECT device_id, temperature AS x0, {lagged} FROM device WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", event_id)),
zs AS ({" UNION ALL ".join(parts)}),
m AS (SELECT d, device_id, count(*) AS n, var_pop(z) AS v, var_pop(z1) AS s11, var_pop(z2) AS s22, covar_pop(z1, z2) AS s12,
             covar_pop(z, z1) AS c1, covar_pop(z, z2) AS c2 FROM zs GROUP BY d, device_id),
o AS (SELECT *, CASE WHEN s11 > 0 THEN c1 / s11 ELSE 0 END AS b1, CASE WHEN s11 > 0 THEN s12 / s11 ELSE 0 END AS g FROM m),
r AS (SELECT *, s22 - g * s12 AS r22, c2 - g * c1 AS rc FROM o),
e AS (SELECT d, n, v AS e0, v - b1 * c1 AS e1, v - b1 * c1 - CASE WHEN r22 > 1e-9 * s22 THEN rc * rc / r22 ELSE 0 END AS e2 FROM r),
t AS (SELECT 0 AS p, d, n, e0 AS err FROM e UNION ALL SELECT 1, d, n, e1 FROM e UNION ALL SELECT 2, d, n, e2 FROM e)
SELECT CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d, round(sqrt(sum(n * greatest(err, 0)) / sum(n)), 6) AS rmse, CAST(sum(n) AS BIGINT) AS n_scored
FROM t GROUP BY p, d"""


@register("forecast_order_search", _order_sql())
def q_forecast_order_search(spark, sf_dir):
    """RMSE of AR(p) on d-times differenced temperature for p 0-2,
    d 0-3, all series, from one set of moments."""
    dv = view(spark, sf_dir, "device")
    return round_doubles(G.order_search(dv, "device_id", D.ORDER, "temperature",
                                        segment=D.day_segment()))


def _anomaly_split(spark, sf_dir):
    """Training and test rows of the feature table, which is computed once and stored: a fit reads it many times."""
    f = materialize(_features(spark, sf_dir), "anomaly-features")
    return M.hash_split(f, "event_id", 70)


_TEST = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 >= 70"


def _gate(spark, scored, bound, kind: str = "binary"):
    """One row on a model's stored predictions: number of test rows, sum of their labels,
    whether the metrics of ``pyspark.ml``'s evaluators and those recomputed from the
    stored table in one aggregate agree, and whether ``bound`` (SQL on them) holds."""
    stored = materialize(scored.select(F.col("label").cast("double"), F.col("prediction").cast("double")), "predictions")
    direct = (M.classification_metrics(stored) if kind == "binary" else M.regression_metrics(stored)).first()
    ml = M.evaluator_metrics(stored, "label", kind)
    pairs = {"accuracy": "accuracy", "recall_1": "recall", "f1_1": "f1"} if kind == "binary" else {m: m for m in ("mae", "mse", "rmse", "r2")}
    agree = all(abs(ml[a] - (direct[b] or 0.0)) <= 1e-6 * max(1.0, abs(ml[a])) for a, b in pairs.items())
    metrics = {k: v for k, v in direct.asDict().items() if v is not None}
    out = stored.agg(F.count(F.lit(1)).alias("test_rows"), F.sum("label").alias("label_sum"))
    held = spark.createDataFrame([tuple(float(v) for v in metrics.values())], ", ".join(f"{k} double" for k in metrics)).selectExpr(f"({bound}) AS held").first()[0]
    return round_doubles(out.withColumn("metrics_agree", F.lit(agree)).withColumn("bound_held", F.lit(bool(held))))


def _gate_sql(rows: str, label: str) -> str:
    return f"""
SELECT count(*) AS test_rows, round(sum(CAST({label} AS DOUBLE)), 6) AS label_sum, true AS metrics_agree, true AS bound_held FROM {rows}"""


@register("anomaly_tree_scored", _ANOM_WITH + f"""
SELECT event_id, device_id, round(CAST(anomaly AS DOUBLE), 6) AS anomaly, true AS scored FROM feat WHERE {_TEST}""")
def q_anomaly_tree_scored(spark, sf_dir):
    """M9 + E9: every test row scored once by a decision tree with one of the two
    classes; label never among the features."""
    train, test = _anomaly_split(spark, sf_dir)
    pipe = M.make_pipeline("tree_classifier", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL,
                           maxDepth=4, seed=42)
    model = M.fit(pipe, train, "anomaly")
    s = M.score(model, test, ["event_id", "device_id", "anomaly"])
    return round_doubles(s.withColumn("scored", F.col("prediction").isin(0.0, 1.0)).drop("prediction"))


@register("anomaly_tree_metrics", _ANOM_WITH + _gate_sql(f"feat WHERE {_TEST}", "anomaly"))
def q_anomaly_tree_metrics(spark, sf_dir):
    """M1 + M6: decision tree (depth 4), hold-out metrics from stored predictions; F1 above 0.8."""
    train, test = _anomaly_split(spark, sf_dir)
    pipe = M.make_pipeline("tree_classifier", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL, maxDepth=4, seed=42)
    return _gate(spark, M.score(M.fit(pipe, train, "anomaly"), test, [F.col("anomaly").alias("label")]), "f1 > 0.8")


@register("anomaly_logistic_metrics", _ANOM_WITH + _gate_sql(f"feat WHERE {_TEST}", "anomaly"))
def q_anomaly_logistic_metrics(spark, sf_dir):
    """M4 + M6: logistic regression, hold-out metrics from stored predictions;
    at least as accurate as always saying the more frequent class, less 5 %."""
    train, test = _anomaly_split(spark, sf_dir)
    pipe = M.make_pipeline("logistic", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL, maxIter=50)
    model = M.fit(pipe, train, "anomaly")
    s = M.score(model, test, [F.col("anomaly").alias("label")])
    return _gate(spark, s, "accuracy >= greatest(tp + fn, fp + tn) / (tp + fn + fp + tn) - 0.05")


@register("anomaly_tree_search", _ANOM_WITH + f"""
SELECT CAST(20 AS BIGINT) AS evaluations, true AS best_is_highest, true AS f1_recomputed, true AS in_grid, true AS bound_held""")
def q_anomaly_tree_search(spark, sf_dir):
    """M8 + M10 + T3: 20 evaluations over depth 1-19 and leaf size 4-127 on one
    stored feature table, every one recorded as a run; the best run has the
    highest F1, and its F1 on all training features is recomputed from stored
    predictions by one aggregate."""
    train, _ = _anomaly_split(spark, sf_dir)
    pipe = M.make_pipeline("tree_classifier", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL, seed=42)
    model, features, rows = M.tree_search(pipe, train, "anomaly")
    runs = None
    for i, r in enumerate(rows):
        run = M.new_run(spark, "anomaly_tree", {k: v for k, v in r.items() if k != "metric"},
                        {"f1": r["metric"]}, {"search": "grid"}, run_id=f"run{i:02d}")
        runs = run if runs is None else runs.unionByName(run)
    runs = materialize(runs, "runs")
    best = M.best_run(runs, "f1", "search", "grid").first()
    stored = materialize(model.stages[-1].transform(features).select(F.col("anomaly").alias("label"), "prediction"), "predictions")
    direct, ml = M.classification_metrics(stored).first(), M.evaluator_metrics(stored, "label")
    depth, leaf = float(best["params"]["maxDepth"]), float(best["params"]["minInstancesPerNode"])
    return runs.agg(F.count(F.lit(1)).alias("evaluations"), (F.max(F.col("metrics")["f1"]) == F.lit(best["metrics"]["f1"])).alias("best_is_highest")) \
        .withColumn("f1_recomputed", F.lit(abs(direct["f1"] - ml["f1_1"]) < 1e-9)) \
        .withColumn("in_grid", F.lit(1 <= depth <= 19 and 4 <= leaf <= 127)).withColumn("bound_held", F.lit(best["metrics"]["f1"] > 0.8))


ENGINE_FEATURES = ["Cycle", "OpSet1", "OpSet2", "SensorMeasure1", "SensorMeasure2"]
_ENGINE_TEST = duck_with("engine") + _gate_sql(
    "engine WHERE CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '|' || CAST(Cycle AS VARCHAR)), 1, 8)) AS BIGINT) % 100 >= 70", "RemainingUsefulLife")


def _engine_split(spark, sf_dir):
    from millrace.sources.fixtures import stored
    e = stored(spark, sf_dir, "engine")
    return M.hash_split(e, ["id", "Cycle"], 70)


@register("rul_tree_metrics", _ENGINE_TEST)
def q_rul_tree_metrics(spark, sf_dir):
    """M2 + M7: decision-tree regressor of remaining useful life (the target
    is not a feature), hold-out MAE / MSE / RMSE / R^2 from stored predictions; R^2 above 0.5."""
    train, test = _engine_split(spark, sf_dir)
    pipe = M.make_pipeline("tree_regressor", "RemainingUsefulLife", ENGINE_FEATURES, maxDepth=6, seed=42)
    model = M.fit(pipe, train, "RemainingUsefulLife")
    return _gate(spark, M.score(model, test, [F.col("RemainingUsefulLife").alias("label")]), "r2 > 0.5", "regression")


@register("rul_gbt_metrics", _ENGINE_TEST)
def q_rul_gbt_metrics(spark, sf_dir):
    """M5 + M7: gradient-boosted trees for remaining useful life; R^2 above 0.5."""
    train, test = _engine_split(spark, sf_dir)
    model = M.fit_cells("gbt_regressor", train, "RemainingUsefulLife", ENGINE_FEATURES, maxIter=20, maxDepth=4, seed=42)
    return _gate(spark, M.score(model, test, [F.col("RemainingUsefulLife").alias("label")]), "r2 > 0.5", "regression")


def _device_artefact(spark, sf_dir, trees: int):
    """Labelled readings, and the artefact: learned device features and a forest on them, in one model.

    Features are computed on all readings and split afterwards, so that a
    training row's earlier readings are those it has when it is scored."""
    dv = view(spark, sf_dir, "device")
    labelled = materialize(D.defects(dv, temp_rules=FIXTURE_TEMP_RULES, pressure_max=FIXTURE_PRESSURE_MAX), "labelled")
    stage = DeviceFeatureFit(factories=FACTORIES, models=MODELS).fit(labelled)
    feats = materialize(stage.transform(labelled), "device-features")  # a fit reads them many times
    train, test = M.hash_split(feats, "event_id", 70)
    pipe = M.make_pipeline("forest_classifier", "defect", stage.feature_columns(), numTrees=trees, seed=42)
    return labelled, feats, test, PipelineModel([stage, *M.fit(pipe, train, "defect").stages])


@register("defect_forest_metrics", _DEFECT_SQL + _gate_sql(f"lab WHERE {_TEST}", "defect"))
def q_defect_forest_metrics(spark, sf_dir):
    """M3 + M11 + M6: random forest (100 trees, seed 42) on the device features
    with the forecast, hold-out metrics from stored predictions; precision above 0.5."""
    _, _, test, model = _device_artefact(spark, sf_dir, 100)
    scored = test
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    return _gate(spark, scored.select(F.col("defect").alias("label"), "prediction"), "precision > 0.5")


@register("device_artefact_features", _FEATURES_WITH + """,
l AS (SELECT event_id, device_id, temperature AS y,
             lag(temperature) OVER (PARTITION BY device_id ORDER BY "timestamp", event_id) AS x FROM device),
f AS (SELECT device_id, regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope FROM l GROUP BY device_id)
SELECT """ + _FEATURE_COLS + """, round(coalesce(f.intercept + f.slope * l.x, 0.0), 6) AS predicted_temp, true AS scored
FROM trips t JOIN et_r USING (event_id) JOIN ed_r USING (event_id) JOIN l USING (event_id) JOIN f ON f.device_id = t.device_id""")
def q_device_artefact_features(spark, sf_dir):
    """M11 + M13 + E3-E5: the saved and loaded artefact (device features with
    the forecast, and a forest) scores the raw readings; its features equal
    those that SQL recomputes, and every reading gets a class."""
    _, _, _, model = _device_artefact(spark, sf_dir, 5)
    path = M.save_model(model, scratch_path(spark, f"device-artefact-{uuid.uuid4().hex[:12]}"))
    served = M.load_model(path).transform(view(spark, sf_dir, "device"))
    return round_doubles(served.select("event_id", "device_id", F.col("trip_id").cast("int").alias("trip_id"), "rolling_mean_temp", "temp_difference",
                                       "rolling_mean_density", *[f"ohe_{v}" for v in FACTORIES + MODELS], "predicted_temp",
                                       F.col("prediction").isin(0.0, 1.0).alias("scored")))


# The feature SQL travels inside the model artefact (training / serving
# parity).  Window features over __THIS__ are ordinary Spark SQL.
ANOMALY_FEATURE_SQL = """
SELECT *,
  CAST(avg(sensor_1) OVER w1 AS FLOAT) AS s1_rolling_avg,
  CAST(coalesce(sensor_1 - lag(sensor_1) OVER w0, 0.0) AS FLOAT) AS s1_diff,
  CAST(hour(`timestamp`) AS FLOAT) AS hour_of_day_f
FROM __THIS__
WINDOW w0 AS (PARTITION BY device_id ORDER BY `timestamp`, event_id),
       w1 AS (PARTITION BY device_id ORDER BY `timestamp`, event_id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
"""


def _anomaly_artefact(spark, sf_dir):
    """Labelled readings, and the artefact (feature SQL, encoders, tree) saved, promoted, resolved and loaded."""
    step = SQLTransformer(statement=ANOMALY_FEATURE_SQL)
    labelled = A.label_anomaly(view(spark, sf_dir, "telemetry"))
    # features on all readings, split afterwards: a training row's previous reading is the one it is scored with
    train, _ = M.hash_split(step.transform(labelled), "event_id", 70)
    pipe = M.make_pipeline("tree_classifier", "anomaly",
                           ["sensor_1", "sensor_2", "sensor_3", "s1_rolling_avg", "s1_diff", "hour_of_day_f"],
                           ["device_model"], maxDepth=4, seed=42)
    model = PipelineModel([step, *M.fit(pipe, train, "anomaly").stages])
    root = scratch_path(spark, f"models-{uuid.uuid4().hex[:12]}")
    M.save_model(model, f"{root}/anomaly_tree_v1")
    M.promote(spark, f"{root}/aliases", "anomaly_tree", "Production", f"{root}/anomaly_tree_v1")
    return labelled, M.load_model(M.resolve_alias(spark, f"{root}/aliases", "anomaly_tree", "Production"))


@register("anomaly_feature_parity", _ANOM_WITH + """
SELECT CAST(count(*) AS BIGINT) AS readings, CAST(0 AS BIGINT) AS differing FROM feat""")
def q_anomaly_feature_parity(spark, sf_dir):
    """Readings, and those where the features that the loaded artefact makes
    from raw readings differ from those of the feature table that training code
    makes by the series scan."""
    labelled, served = _anomaly_artefact(spark, sf_dir)
    names = {"s1_rolling_avg": "sensor_1_rolling_avg", "s1_diff": "sensor_1_diff", "hour_of_day_f": "hour_of_day"}
    made = served.transform(labelled).select("event_id", *names)
    table = _features(spark, sf_dir).select("event_id", *names.values())
    differs = ~F.lit(True)
    for a, b in names.items():
        differs = differs | ~F.col(a).eqNullSafe(F.col(b))
    return made.join(table, "event_id").agg(F.count("*").alias("readings"), F.count(F.when(differs, 1)).alias("differing"))


@register("anomaly_model_artefact", _ANOM_WITH + """
SELECT event_id, device_id, round(CAST(anomaly AS DOUBLE), 6) AS anomaly, true AS scored FROM feat""")
def q_anomaly_model_artefact(spark, sf_dir):
    """M11 + M10: one artefact = feature SQL + encoders + tree; saved to the
    shared folder, promoted to the ``Production`` alias, resolved and loaded
    back, then used to score every labelled reading."""
    labelled, served = _anomaly_artefact(spark, sf_dir)
    s = M.score(served, labelled, ["event_id", "device_id", "anomaly"])
    return round_doubles(s.withColumn("scored", F.col("prediction").isin(0.0, 1.0)).drop("prediction"))


@register("alias_history", """
WITH r AS (SELECT event_type, round(avg(CAST(value AS DOUBLE)), 6) AS metric FROM events GROUP BY event_type)
SELECT row_number() OVER (ORDER BY event_type) AS version, 'runs/' || event_type AS path, metric, event_type = max(event_type) OVER () AS current FROM r""")
def q_alias_history(spark, sf_dir):
    """The runs of a table promoted in turn (its ids reach the driver: one a run);
    every version stays in the history, the last one is what the alias resolves to."""
    runs = view_table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg(F.col("value").cast("double")).alias("metric"))
    root = scratch_path(spark, f"aliases-{uuid.uuid4().hex[:12]}")
    for r in runs.select("event_type").orderBy("event_type").collect():
        M.promote(spark, root, "plant_model", "Production", f"runs/{r['event_type']}")
    now = M.resolve_alias(spark, root, "plant_model", "Production")
    history = M.alias_history(spark, root, "plant_model", "Production")
    named = runs.withColumn("path", F.concat(F.lit("runs/"), "event_type"))
    return round_doubles(history.join(named, "path").select("version", "path", "metric", (F.col("path") == F.lit(now)).alias("current")))
