"""Device features as a pipeline stage that is saved with the model.

``DeviceFeatureFit`` learns what the features need: the values of the one-hot
layout and every device's temperature forecast (M13).  ``DeviceFeatures`` holds
them, together with the smoothing parameters, and turns raw readings into
features; saved inside a ``PipelineModel`` it makes training and serving use the
same features.  The forecasts are a table of one row for a device and are saved
as such, so the artefact grows with the devices, not the driver.
"""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import functions as F

from millrace.operators.features import category_values, device_features
from millrace.operators.grouped import forecast_fit
from millrace.operators.scan import Lag
from millrace.sources.io import materialize

KEY, ORDER = "device_id", ["timestamp", "event_id"]


class _DeviceParams(Params):
    factories = Param(Params._dummy(), "factories", "values of factory_id in the one-hot layout", TypeConverters.toListString)
    models = Param(Params._dummy(), "models", "values of model_id in the one-hot layout", TypeConverters.toListString)
    tempCom = Param(Params._dummy(), "tempCom", "centre of mass of the temperature smoothing", TypeConverters.toFloat)
    densitySpan = Param(Params._dummy(), "densitySpan", "span of the density smoothing", TypeConverters.toFloat)
    p = Param(Params._dummy(), "p", "lags of the forecast", TypeConverters.toInt)
    d = Param(Params._dummy(), "d", "differences of the forecast", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(tempCom=5.0, densitySpan=600.0, p=1, d=0)


class DeviceFeatureFit(_DeviceParams, Estimator):
    """Learns the layout (where ``factories`` and ``models`` aren't set) and the forecasts."""

    def __init__(self, **values):
        super().__init__()
        self._set(**values)

    def _fit(self, dataset):
        stage = DeviceFeatures()
        for name, column in (("factories", "factory_id"), ("models", "model_id")):
            given = self.getOrDefault(name) if self.isDefined(name) else category_values(dataset, column)
            stage._set(**{name: given})
        stage._set(**{name: self.getOrDefault(name) for name in ("tempCom", "densitySpan", "p", "d")})
        p, d = stage.getOrDefault("p"), stage.getOrDefault("d")
        fit = forecast_fit(dataset, KEY, ORDER, "temperature", p, d, segment=F.to_date(ORDER[0]))
        stage.coefficients = materialize(fit.select(KEY, "intercept", *[f"a{j + 1}" for j in range(p)]), "forecasts")
        return stage


class DeviceFeatures(_DeviceParams, Transformer, MLWritable, MLReadable):
    """Raw readings with smoothed temperature and density, their deviation, one-hot columns
    and ``predicted_temp``, the forecast of the reading from those before it (nought
    where there is none: the first readings, devices not seen in training)."""

    def __init__(self):
        super().__init__()
        self.coefficients = None

    def feature_columns(self) -> list[str]:
        return ["temperature", "air_pressure", "rotation_speed", "delay", "density", "rolling_mean_temp", "temp_difference",
                "rolling_mean_density", "predicted_temp"] + [f"ohe_{v}" for v in (*self.getOrDefault("factories"), *self.getOrDefault("models"))]

    def _transform(self, dataset):
        p, d = self.getOrDefault("p"), self.getOrDefault("d")
        rows = device_features(dataset, factories=self.getOrDefault("factories"), models=self.getOrDefault("models"),
                               temp_com=self.getOrDefault("tempCom"), density_span=self.getOrDefault("densitySpan"),
                               segment=F.to_date(ORDER[0]), lags=[Lag("temperature", k, f"__lag{k}") for k in range(1, p + d + 1)])
        lag = {k: F.col(f"__lag{k}").cast("double") for k in range(1, p + d + 1)}
        step = F.col("__f.intercept")
        for j in range(1, p + 1):
            step = step + F.col(f"__f.a{j}") * sum(((-1) ** k * math.comb(d, k)) * lag[j + k] for k in range(d + 1))
        for k in range(1, d + 1):  # x_t less its d-th difference, which the earlier values give
            step = step - float((-1) ** k * math.comb(d, k)) * lag[k]
        fits = self.coefficients.select(F.struct(KEY).alias("__k"), F.struct("intercept", *[f"a{j + 1}" for j in range(p)]).alias("__f"))
        joined = rows.withColumn("__k", F.struct(KEY)).join(fits, "__k", "left")
        return joined.withColumn("predicted_temp", F.coalesce(step, F.lit(0.0))).drop("__k", "__f", *[f"__lag{k}" for k in lag])

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.coefficients.write.parquet(f"{path}/coefficients")


class _Reader(MLReader):
    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = DeviceFeatures()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.coefficients = self.sparkSession.read.parquet(f"{path}/coefficients")
        return stage
