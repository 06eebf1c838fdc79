"""The saved device features, model aliases, the scored stream and sketches."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.operators import aggregates as G
from millrace.operators import models as M
from millrace.operators.artefact import DeviceFeatureFit, DeviceFeatures
from millrace.sources.fixtures import view
from tests.conftest import SF_SMALL

LAYOUT = {"factories": ["F0", "F1"], "models": ["click"]}


def features(stage, rows):
    cols = stage.feature_columns()
    return {r.event_id: tuple(round(r[c] or 0.0, 9) for c in cols) for r in stage.transform(rows).collect()}


def test_loaded_features_are_those_of_training_and_a_changed_stage_is_seen(spark, scratch):
    rows = view(spark, SF_SMALL, "device")
    stage = DeviceFeatureFit(p=2, d=1, **LAYOUT).fit(rows)
    trained = features(stage, rows)
    path = M.save_model(PipelineModel([stage]), os.path.join(scratch, "artefact"))
    loaded = M.load_model(path).stages[0]
    assert isinstance(loaded, DeviceFeatures) and features(loaded, rows) == trained
    for change in ({"tempCom": 4.0}, {"densitySpan": 300.0}, {"factories": ["F1", "F0"]}):
        other = M.load_model(path).stages[0]
        other._set(**change)
        assert features(other, rows) != trained
    other = M.load_model(path).stages[0]
    other.coefficients = other.coefficients.withColumn("a1", F.col("a1") + 0.5)
    assert features(other, rows) != trained


def test_layout_is_learned_and_unseen_devices_have_no_forecast(spark):
    rows = view(spark, SF_SMALL, "device")
    stage = DeviceFeatureFit().fit(rows.where("factory_id <> 'F4'"))
    assert stage.getOrDefault("factories") == ["F0", "F1", "F2", "F3"]
    new = rows.withColumn("device_id", F.concat(F.lit("new"), "device_id"))
    assert stage.transform(new).agg(F.max(F.abs("predicted_temp"))).first()[0] == 0.0


def test_of_two_promotions_at_once_one_wins(spark, scratch):
    root = os.path.join(scratch, "aliases")
    assert M.alias_version(spark, root, "m", "Production") == 0 and M.resolve_alias(spark, root, "m", "Production") is None
    assert M.promote(spark, root, "m", "Production", "a") == 1
    seen = M.alias_version(spark, root, "m", "Production")
    assert M.promote(spark, root, "m", "Production", "b", expected=seen) == 2
    with pytest.raises(M.PromotionConflict):  # saw version 1 too
        M.promote(spark, root, "m", "Production", "c", expected=seen)
    assert M.resolve_alias(spark, root, "m", "Production") == "b"
    assert sorted((r.version, r.path) for r in M.alias_history(spark, root, "m", "Production").collect()) == [(1, "a"), (2, "b")]
    assert M.resolve_alias(spark, root, "m", "Staging") is None


def test_sketches_roll_up(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("day"), (F.col("id") % 20_000).alias("x"))
    daily = G.distinct_sketches(df, "x", ["g", "day"])
    whole = G.rolled_up_distinct(daily).first()[0]
    assert abs(whole - 20_000) < 20_000 * 0.065
    exact = {r.g: r.n for r in G.distinct_count(df, "x", "g", out="n").collect()}
    for r in G.rolled_up_distinct(daily, "g").collect():
        assert abs(r.n_distinct - exact[r.g]) < exact[r.g] * 0.065
