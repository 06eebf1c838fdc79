"""Tables that a job reads many times are stored once; tasks stay small; evaluations don't share a thread's properties."""

import time
from datetime import datetime, timedelta

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F


def _events(spark, folder):
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=7 * i), i % 5, f"m{i % 2}", float(i * 37 % 100), f'{{"k": {i % 100}}}') for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.write.parquet(f"{folder}/events.parquet")
    return folder


def test_fits_read_stored_features(spark, scratch):
    from millrace.plans import q_learning, q_models

    sf = _events(spark, scratch)
    for part in (*q_models._anomaly_split(spark, sf), q_models._device_artefact(spark, sf, 2)[1], q_learning._train(spark, sf)):
        files = part.inputFiles()
        assert files and not any("events.parquet" in f for f in files)
        assert all(f.endswith(".zstd.parquet") for f in files)


def test_defaults_bound_what_a_task_reads(spark):
    from millrace.session import ensure_session_defaults

    fresh = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        fresh.conf.unset(name)
    ensure_session_defaults(fresh)
    assert int(fresh.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) == 32 << 20
    assert int(fresh.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("b")) == 32 << 20


class _Probe(DecisionTreeClassifier):
    same: list = []

    def fit(self, dataset, params=None):
        sc = dataset.sparkSession.sparkContext
        mine = str(time.perf_counter_ns())
        sc.setLocalProperty("probe", mine)
        time.sleep(0.3)
        _Probe.same.append(sc.getLocalProperty("probe") == mine)
        return super().fit(dataset, params)


def test_evaluations_of_a_search_have_properties_of_their_own(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from millrace.operators.models import tree_search

    df = spark.range(300).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3 == 0).cast("double").alias("y"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), _Probe(labelCol="y", seed=1)])
    model, features, runs = tree_search(pipe, df, "y", depths=(1, 5), min_instances=(1, 4))
    assert len(_Probe.same) == 5 and all(_Probe.same)
    assert [(r["maxDepth"], r["minInstancesPerNode"]) for r in runs] == [(1.0, 1.0), (1.0, 4.0), (5.0, 1.0), (5.0, 4.0)]
    assert features.count() == 300 and model.transform(df).count() == 300


def test_numbered_rows_travel_with_one_copy_of_the_key(spark):
    from millrace.operators.windows import row_number_by

    df = spark.createDataFrame([(k, t, t // 10) for k in ("a", None) for t in range(30)], "id string, t int, seg int")
    out = row_number_by(df, "id", ["t"], segment=F.col("seg"), with_count="n")
    assert out.columns == ["id", "t", "seg", "row_num", "n"]
    assert all(r.row_num == r.t + 1 and r.n == 30 for r in out.collect()) and out.count() == 60
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [row_number()" in line)
    below = plan.splitlines()[plan.splitlines().index(window) + 1]
    assert "Project [" in below and " AS __ks" in below and "id#" not in below.split("[", 1)[1].split("named_struct")[0].split("struct(")[0]
