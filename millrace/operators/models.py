"""Models and scoring with ``pyspark.ml``.

Training runs on the DataFrame (no ``toPandas``); scoring is
``PipelineModel.transform`` which stays in the JVM.  Metrics are single
aggregate jobs over (label, prediction) columns, so they are testable in SQL.
"""

from __future__ import annotations

import json
import uuid
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import Bucketizer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, MapType, StringType, StructField, StructType,
                               TimestampType)

from millrace.functions.scalar import md5_bucket
from millrace.sources.io import materialize

ESTIMATORS = {
    "tree_classifier": lambda label, **kw: DecisionTreeClassifier(labelCol=label, **kw),
    "forest_classifier": lambda label, **kw: RandomForestClassifier(labelCol=label, **kw),
    "logistic": lambda label, **kw: LogisticRegression(labelCol=label, **kw),
    "gbt_classifier": lambda label, **kw: GBTClassifier(labelCol=label, **kw),
    "tree_regressor": lambda label, **kw: DecisionTreeRegressor(labelCol=label, **kw),
    "gbt_regressor": lambda label, **kw: GBTRegressor(labelCol=label, **kw),
}


# ------------------------------------------------------------------ E9
def hash_split(df: DataFrame, key, train_pct: int = 70, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """Reproducible random split by the md5 bucket of the row key
    (independent of partitioning, unlike ``randomSplit``)."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    b = md5_bucket(*keys, *([F.lit(seed)] if seed else []), buckets=100)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


# ------------------------------------------------------------------ M1-M5, M11
def feature_pipeline(numeric: list[str], categorical: list[str] | None = None,
                     sql_features: str | None = None) -> list:
    """Stages that turn raw columns into a ``features`` vector: optional SQL
    feature step (M11: window features inside the model artefact), string
    indexing (unseen values kept), one-hot, assembly."""
    stages = []
    if sql_features:
        stages.append(SQLTransformer(statement=sql_features))
    cats = categorical or []
    for c in cats:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"))
    if cats:
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cats],
                                    outputCols=[f"{c}__ohe" for c in cats], handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + [f"{c}__ohe" for c in cats],
                                  outputCol="features", handleInvalid="keep"))
    return stages


def make_pipeline(kind: str, label: str, numeric: list[str], categorical=None,
                  sql_features: str | None = None, **params) -> Pipeline:
    """Feature stages + one estimator."""
    est = ESTIMATORS[kind](label, featuresCol="features", **params)
    return Pipeline(stages=feature_pipeline(numeric, categorical, sql_features) + [est])


def fit(pipeline: Pipeline, train: DataFrame, label: str) -> PipelineModel:
    return pipeline.fit(train.withColumn(label, F.col(label).cast("double")))


def fit_cells(kind: str, train: DataFrame, label: str, numeric: list[str], bins: int = 32, **params) -> PipelineModel:
    """M5: trees grown from the cells of the binned features instead of from rows.

    Squared-error trees see a row only through its bins, and the rows of a cell only
    through their number and mean label: what labels vary inside a cell is the same
    on both sides of every cut.  So rows with equal bins are one weighted row, at most
    ``bins`` ** features of them whatever the table, and every row counts.  The
    boosting rounds read those, the table itself is read twice (quantiles, cells).
    A null feature or label is an error, as it is in a fit on rows."""
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in numeric], F.col(label).cast("double").alias(label))
    cuts = rows.approxQuantile(list(numeric), [i / (bins - 1) for i in range(1, bins - 1)], 0.1 / bins)
    splits = [[-float("inf"), *sorted({c for c in q if c not in (float("inf"), -float("inf"))}), float("inf")] for q in cuts]
    binned = Bucketizer(inputCols=list(numeric), outputCols=[f"{c}__bin" for c in numeric],
                        splitsArray=[s if len(s) > 2 else [s[0], 0.0, s[1]] for s in splits], handleInvalid="keep")
    by = [f"{c}__bin" for c in numeric]
    ordered = [(F.col(c) + F.lit(0.0)).alias(c) for c in by]  # a sum has no metadata, which would make the bins categories
    cells = materialize(binned.transform(rows).groupBy(*ordered).agg(F.count(F.lit(1)).cast("double").alias("__weight"), F.when(F.count(label) == F.count(F.lit(1)), F.avg(label)).alias(label)), "cells")
    *stages, est = make_pipeline(kind, label, by, maxBins=bins, weightCol="__weight", **params).getStages()
    return PipelineModel([binned, *Pipeline(stages=[*stages, est]).fit(cells).stages])


def score(model: PipelineModel, df: DataFrame, keep: list[str],
          prediction: str = "prediction") -> DataFrame:
    """M9: batch scoring as a column, fixed output projection."""
    return model.transform(df).select(*keep, F.col("prediction").alias(prediction))


# ------------------------------------------------------------------ M6 / M7
def classification_metrics(df: DataFrame, label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """M6: confusion counts, precision, recall, F1 and accuracy for the
    positive class (1), in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    agg = df.agg(
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("bigint").alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (agg.withColumn("predicted_positives", tp + fp)
               .withColumn("precision", F.try_divide(tp.cast("double"), tp + fp))
               .withColumn("recall", F.try_divide(tp.cast("double"), tp + fn))
               .withColumn("f1", F.try_divide((2 * tp).cast("double"), 2 * tp + fp + fn))
               .withColumn("accuracy", F.try_divide((tp + tn).cast("double"), tp + fp + fn + tn)))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by=None) -> DataFrame:
    """M7: MAE, MSE, RMSE, R^2 (and row count) in one aggregate, optionally
    per group."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    aggs = [F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
            F.sum(e * e).alias("__sse"), F.var_pop(y).alias("__vy")]
    g = df.groupBy(*(by if isinstance(by, (list, tuple)) else [by])) if by else df
    out = g.agg(*aggs)
    return (out.withColumn("rmse", F.sqrt("mse"))
               .withColumn("r2", F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("__vy") * F.col("n")))
               .drop("__sse", "__vy"))


def evaluator_metrics(scored: DataFrame, label: str, kind: str = "binary") -> dict:
    """Metrics through the ``pyspark.ml`` evaluators (same numbers, as a
    dict; runs one job per metric)."""
    if kind == "regression":
        ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
        return {m: ev.evaluate(scored, {ev.metricName: m}) for m in ("mae", "mse", "rmse", "r2")}
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    out = {m: ev.evaluate(scored, {ev.metricName: m}) for m in ("f1", "accuracy")}
    out["recall_1"] = ev.evaluate(scored, {ev.metricName: "recallByLabel", ev.metricLabel: 1.0})
    out["f1_1"] = ev.evaluate(scored, {ev.metricName: "fMeasureByLabel", ev.metricLabel: 1.0, ev.beta: 1.0})
    if "rawPrediction" in scored.columns:
        out["auc"] = BinaryClassificationEvaluator(labelCol=label).evaluate(scored)
    return out


# ------------------------------------------------------------------ M8
SEARCH_DEPTHS = (1, 4, 8, 13, 19)
SEARCH_LEAVES = (4, 16, 64, 127)


def tree_search(pipeline: Pipeline, train: DataFrame, label: str,
                depths=SEARCH_DEPTHS, min_instances=SEARCH_LEAVES,
                regression: bool = False, parallelism: int = 4, seed: int = 42):
    """M8: grid search over tree depth and minimum rows per leaf (20
    evaluations by default), one train/validation split, models fitted in
    parallel on the cluster.  Maximises the positive class's F1 (classifier) or
    minimises RMSE (regressor).

    The feature stages are fitted and applied once; the assembled features are
    written, and all evaluations read that table.  Returns (feature stages +
    best tree as one model, the features, a row of parameters and metric for
    each evaluation)."""
    *stages, est = pipeline.getStages()
    rows = train.withColumn(label, F.col(label).cast("double"))
    prepared = Pipeline(stages=stages).fit(rows)
    features = materialize(prepared.transform(rows).select(label, est.getFeaturesCol()), "search-features")
    grid = (ParamGridBuilder().addGrid(est.maxDepth, list(depths))
                              .addGrid(est.minInstancesPerNode, list(min_instances)).build())
    ev = (RegressionEvaluator(labelCol=label, metricName="rmse") if regression else
          MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0))
    drawn = features.withColumn("__rand", F.rand(seed))
    fitted, held = drawn.where("__rand < 0.8").drop("__rand").cache(), drawn.where("__rand >= 0.8").drop("__rand").cache()

    def evaluation(pm):
        # every evaluation has local properties of its own: TrainValidationSplit's threads share one set, in which
        # one thread clears the id of the query that another is starting
        return inheritable_thread_target(features.sparkSession)(lambda: ev.evaluate(est.fit(fitted, pm).transform(held)))

    try:
        with ThreadPool(min(parallelism, len(grid))) as pool:
            metrics = pool.map(lambda run: run(), [evaluation(pm) for pm in grid], chunksize=1)
    finally:
        fitted.unpersist()
        held.unpersist()
    best = (max if ev.isLargerBetter() else min)(range(len(grid)), key=metrics.__getitem__)
    runs = [{p.name: float(v) for p, v in pm.items()} | {"metric": float(m)} for pm, m in zip(grid, metrics)]
    return PipelineModel([*prepared.stages, est.fit(features, grid[best])]), features, runs


# ------------------------------------------------------------------ M10
RUNS_SCHEMA = StructType([
    StructField("run_id", StringType()), StructField("name", StringType()),
    StructField("created", TimestampType()),
    StructField("params", MapType(StringType(), StringType())),
    StructField("metrics", MapType(StringType(), DoubleType())),
    StructField("tags", MapType(StringType(), StringType())),
])


def new_run(spark: SparkSession, name: str, params: dict, metrics: dict, tags: dict | None = None,
            run_id: str | None = None) -> DataFrame:
    """One run record as a DataFrame row (append it to a ``runs``
    table with ``write_table(..., mode='append')``)."""
    import datetime as _dt
    row = (run_id or uuid.uuid4().hex, name, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
           {k: json.dumps(v) if not isinstance(v, str) else v for k, v in params.items()},
           {k: float(v) for k, v in metrics.items()}, dict(tags or {}))
    return spark.createDataFrame([row], RUNS_SCHEMA)


def best_run(runs: DataFrame, metric: str, tag: str | None = None, tag_value: str | None = None,
             ascending: bool = False) -> DataFrame:
    """Best run by a metric, optionally among runs with a tag
    (descending for F1 / recall, ascending for MSE); ties broken by run id."""
    r = runs
    if tag is not None:
        r = r.filter(F.col("tags")[tag] == tag_value)
    m = F.col("metrics")[metric]
    return r.filter(m.isNotNull()).orderBy(m.asc() if ascending else m.desc(), F.col("run_id")).limit(1)


def save_model(model: PipelineModel, path: str) -> str:
    """Model artefact to a (shared) folder."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


class PromotionConflict(RuntimeError):
    """Somebody else moved the alias first."""


def _alias_folder(spark: SparkSession, root: str, name: str, alias: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/{alias}")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def alias_version(spark: SparkSession, root: str, name: str, alias: str) -> int:
    """The alias's latest version (0: never promoted)."""
    folder, fs = _alias_folder(spark, root, name, alias)
    if not fs.exists(folder):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return max([int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")], default=0)


def promote(spark: SparkSession, root: str, name: str, alias: str, path: str, expected: int | None = None) -> int:
    """Point ``alias`` (e.g. ``Production``) of model ``name`` at an artefact.

    Every promotion is a new version, a file that is created only if it does not
    exist yet.  ``expected`` is the version the caller saw (the latest one if
    not given): if another promotion has made the next version already, this
    one raises :class:`PromotionConflict`, so of two at once one wins, whatever
    the clocks say.  Returns the new version."""
    version = (alias_version(spark, root, name, alias) if expected is None else expected) + 1
    folder, fs = _alias_folder(spark, root, name, alias)
    record = json.dumps({"name": name, "alias": alias, "version": version, "path": path})
    jvm = spark.sparkContext._jvm
    try:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(folder, f"v{version:08d}.json"), False)
    except Exception as e:  # py4j wraps the file system's exception
        if "FileAlreadyExists" in str(e):
            raise PromotionConflict(f"{name}/{alias} already has version {version}") from e
        raise
    out.write(bytearray(record.encode()))
    out.close()
    return version


def alias_history(spark: SparkSession, root: str, name: str, alias: str) -> DataFrame:
    """Every version of the alias (name, alias, version, path)."""
    return spark.read.schema("name string, alias string, version long, path string").json(f"{root}/{name}/{alias}")


def resolve_alias(spark: SparkSession, root: str, name: str, alias: str) -> str | None:
    """Current artefact path of an alias."""
    if not alias_version(spark, root, name, alias):
        return None
    return alias_history(spark, root, name, alias).orderBy(F.col("version").desc()).first()["path"]
