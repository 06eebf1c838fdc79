"""Feature engineering.

All features are column expressions or window / join compositions; nothing
is computed per row in Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import day_of_week, hour_of_day, md5_coin
from millrace.operators.scan import Smooth, series_scan
from millrace.operators.windows import ewm_alpha, ewma, fill_forward, rolling_avg_and_diff


# ------------------------------------------------------------------ E1 / E2
def label_anomaly(df: DataFrame, sensor: str = "sensor_1", hard=(10, 80), soft=(25, 65),
                  coin_key=("event_id",), out: str = "anomaly") -> DataFrame:
    """1 above ``hard[1]`` or below ``hard[0]``; a reproducible coin flip
    (md5 of ``coin_key``) above ``soft[1]`` or below ``soft[0]``; else 0.
    First matching condition wins; result FLOAT."""
    s = F.col(sensor)
    coin = md5_coin(*[F.col(k) for k in coin_key])
    lab = (F.when(s > hard[1], F.lit(1.0)).when(s < hard[0], F.lit(1.0))
             .when(s > soft[1], coin).when(s < soft[0], coin).otherwise(F.lit(0.0)))
    return df.withColumn(out, lab.cast("float"))


def anomaly_features(df: DataFrame, sensors=("sensor_1", "sensor_2", "sensor_3"),
                     key: str = "device_id", order=("timestamp", "event_id"),
                     ts: str = "timestamp", segment: Column | None = None) -> DataFrame:
    """Per device in time order, for each sensor the mean of the current
    and previous reading (``_rolling_avg``) and the change from the previous
    reading (``_diff``), both FLOAT; hour of day and day of week (FLOAT);
    nulls of all numeric features, the readings included, filled with 0.

    The previous reading is fetched once for all sensors (one window sort, or
    one series scan when ``segment`` is given)."""
    sensors = list(sensors)
    d = rolling_avg_and_diff(df, sensors, key, list(order), segment=segment)
    d = d.withColumn("hour_of_day", hour_of_day(ts)).withColumn("day_of_week", day_of_week(ts))
    made = [f"{s}_rolling_avg" for s in sensors] + [f"{s}_diff" for s in sensors] + ["hour_of_day", "day_of_week"]
    return d.select(*df.columns, *made).na.fill(0.0, subset=[*sensors, *made])


# ------------------------------------------------------------------ E3 / E4
def category_values(df: DataFrame, col: str) -> list:
    """Distinct non-null values of a categorical column, sorted: one small
    aggregate.  They become the layout's columns, so there are as many as the
    caller is willing to encode."""
    return [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, values: list | None = None, prefix: str = "ohe",
            dtype: str = "double", drop: bool = True) -> DataFrame:
    """One dummy column per value (``{prefix}_{value}``), 1 where the row
    has that value.  ``values`` fixed by the caller (training / serving
    parity), or read from the data (one small job)."""
    values = values if values is not None else category_values(df, col)
    dummies = [(F.col(col) == F.lit(v)).cast(dtype).alias(f"{prefix}_{v}") for v in values]
    out = df.select("*", *dummies)
    return out.drop(col) if drop else out


def align_columns(df: DataFrame, columns: list[str], fill=0.0, dtype: str = "double") -> DataFrame:
    """Add missing columns as ``fill`` and return exactly ``columns`` in
    order (serving rows get the training feature layout)."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).cast(dtype).alias(c)
                       for c in columns])


# ------------------------------------------------------------------ E5
def device_features(df: DataFrame, key: str = "device_id", trip: str = "trip_id",
                    order=("timestamp", "event_id"), factories: list | None = None,
                    models: list | None = None, temp_com: float = 5.0,
                    density_span: float = 600.0, temp_shift: int = 1,
                    segment: Column | None = None, one_hot_cols=("factory_id", "model_id"), lags=()) -> DataFrame:
    """E5: CNC device features.

    * one-hot of factory and model (``ohe_<value>``)
    * ``rolling_mean_temp``: EWMA of temperature (com=5) per device and trip,
      over the previous reading (``temp_shift=1``, no leakage)
    * ``temp_difference`` = rolling_mean_temp - temperature
    * ``rolling_mean_density``: EWMA of the previous density (span=600) per
      device
    * feature nulls forward-filled per series, then 0

    With ``segment`` (the day), everything comes from one series scan, the trip
    number too where the readings don't have it, and any further ``lags``.
    ``temp_shift`` is 0 or 1."""
    order = list(order)
    if segment is not None:
        has_trip = trip in df.columns
        d = series_scan(df, key, order, segment, within=F.col(trip) if has_trip else None, rank=None if has_trip else trip, lags=lags, smooth=[
            Smooth("temperature", "rolling_mean_temp", ewm_alpha(com=temp_com), temp_shift, restart=True, deviation="temp_difference"),
            Smooth("density", "rolling_mean_density", ewm_alpha(span=density_span), 1)])
    else:
        d = ewma(df, "temperature", [key, trip], order, out="rolling_mean_temp", com=temp_com, shift=temp_shift)
        d = d.withColumn("temp_difference", F.col("rolling_mean_temp") - F.col("temperature"))
        d = ewma(d, "density", [key], order, out="rolling_mean_density", span=density_span, shift=1)
        d = fill_forward(d, ["temp_difference"], [key, trip], order)
    # a smoothed value is missing only before its series' first observation
    d = d.na.fill(0.0, subset=["rolling_mean_temp", "temp_difference", "rolling_mean_density"])
    if "factory_id" in one_hot_cols:
        d = one_hot(d, "factory_id", factories)
    if "model_id" in one_hot_cols:
        d = one_hot(d, "model_id", models)
    return d


# ------------------------------------------------------------------ E6
# Defect rules of the device data (ordered; first match wins).
# (temperature deviation threshold, column, value, per-device quantile)
DEFECT_TEMP_RULES = [
    (1.8, "factory_id", "A06", 0.89),
    (1.8, "model_id", "SkyJet234", 0.89),
    (1.9, "model_id", "SkyJet334", 0.93),
]
DEFECT_DELAY_MIN = 39.0
DEFECT_ROTATION_MIN = 590.0
DEFECT_DENSITY_MIN = 4.2
DEFECT_PRESSURE_MAX = 780.0
# probability offsets of the five outcomes: round(u + offset) with u ~ U[0,1)
DEFECT_OUTCOME_OFFSETS = [0.2, 0.2, 0.2, 0.2, 0.15]


def label_defects(df: DataFrame, key: str = "device_id", order=("timestamp", "event_id"),
                  temp_rules=None, delay_min: float = DEFECT_DELAY_MIN,
                  rotation_min: float = DEFECT_ROTATION_MIN,
                  density_min: float = DEFECT_DENSITY_MIN,
                  pressure_max: float = DEFECT_PRESSURE_MAX,
                  offsets=None, segment: Column | None = None,
                  out: str = "defect") -> DataFrame:
    """Defect label from five ordered rules.

    rules 1-3: temperature minus the EWMA (com=5) of the previous
    temperatures of the device above a threshold, for one factory / model,
    with temperature above a per-device exact quantile (0.89 / 0.93, linear
    interpolation); rule 4: delay and rotation speed both high; rule 5:
    density high and air pressure low.  The outcome of each rule is a
    reproducible coin drawn once per (device, rule) with
    P(1) = offset + 0.5 (md5 of device and rule), i.e. ``round(u + offset)``.

    Per-device quantiles come from the skew-safe exact ranking of
    ``profile.group_quantiles`` (one row per device), joined back on the
    device."""
    temp_rules = temp_rules or DEFECT_TEMP_RULES
    offsets = offsets or DEFECT_OUTCOME_OFFSETS
    if segment is None:
        d = ewma(df, "temperature", [key], list(order), out="__temp_ewma", com=5.0, shift=1)
    else:
        d = series_scan(df, key, list(order), segment, smooth=[Smooth("temperature", "__temp_ewma", ewm_alpha(com=5.0), 1)])
    d = d.withColumn("__temp_dev", F.col("temperature") - F.col("__temp_ewma"))
    qs = sorted({q for *_, q in temp_rules})
    qcols = {q: f"__q{int(round(q * 100))}" for q in qs}
    from millrace.operators.profile import group_quantiles
    quant = group_quantiles(df, key, "temperature", qs, prefix="__q")
    d = d.join(quant, key, "left")

    def coin(i):
        u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(f"rule{i}"))),
                                1, 8), 16, 10).cast("double") / F.lit(4294967296.0))
        return F.when(u + F.lit(offsets[i]) >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))

    conds = [(F.col("__temp_dev") > th) & (F.col(c) == v) & (F.col("temperature") > F.col(qcols[q]))
             for th, c, v, q in temp_rules]
    conds.append((F.col("delay") > delay_min) & (F.col("rotation_speed") > rotation_min))
    conds.append((F.col("density") > density_min) & (F.col("air_pressure") < pressure_max))
    lab = F.lit(0.0)
    for i in reversed(range(len(conds))):
        lab = F.when(F.coalesce(conds[i], F.lit(False)), coin(i)).otherwise(lab)
    return d.withColumn(out, lab.cast("float")).drop("__temp_ewma", "__temp_dev", *qcols.values())


# ------------------------------------------------------------------ E12
# Failure-mode thresholds of the milling-machine data.
TOOL_WEAR_FAILURE_MIN = 200.0
TOOL_WEAR_FAILURE_MAX = 240.0
HEAT_TEMP_DIFF_MAX = 8.6
HEAT_RPM_MAX = 1380.0
POWER_MIN_W = 3500.0
POWER_MAX_W = 9000.0
OVERSTRAIN_LIMITS = {"L": 11000.0, "M": 12000.0, "H": 13000.0}


def failure_mode_flags(df: DataFrame, air: str = "air_temp", process: str = "process_temp",
                       rpm: str = "rpm", torque: str = "torque", wear: str = "tool_wear",
                       typ: str = "Type") -> DataFrame:
    """Tool-wear (TWF), heat-dissipation (HDF), power (PWF) and
    overstrain (OSF) failure flags (INT 0/1) and ``machine_failure`` = any."""
    power = F.col(torque) * F.col(rpm) * F.lit(2.0 * 3.141592653589793 / 60.0)
    limit = F.when(F.col(typ) == "L", OVERSTRAIN_LIMITS["L"]) \
             .when(F.col(typ) == "M", OVERSTRAIN_LIMITS["M"]) \
             .when(F.col(typ) == "H", OVERSTRAIN_LIMITS["H"])
    twf = F.col(wear).between(TOOL_WEAR_FAILURE_MIN, TOOL_WEAR_FAILURE_MAX)
    hdf = ((F.col(process) - F.col(air)) < HEAT_TEMP_DIFF_MAX) & (F.col(rpm) < HEAT_RPM_MAX)
    pwf = (power < POWER_MIN_W) | (power > POWER_MAX_W)
    osf = (F.col(wear) * F.col(torque)) > limit
    flags = {"TWF": twf, "HDF": hdf, "PWF": pwf, "OSF": osf}
    out = df.select("*", *[F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in flags.items()])
    return out.withColumn("machine_failure", F.greatest(*[F.col(n) for n in flags]))
