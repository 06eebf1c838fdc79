"""Named queries for operators that no pipeline query reaches, each over whole
tables and with its DuckDB twin.  The ``odd`` view nulls keys, times and values
of ``events`` by an md5 bucket of the row id, so that window operators meet null
series, null times and gaps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions.scalar import array_lookup, md5_bucket
from millrace.operators import aggregates as G
from millrace.operators import features as E
from millrace.operators import models as M
from millrace.operators import profile as P
from millrace.operators import quality as Q
from millrace.operators import select as S
from millrace.operators import windows as W
from millrace.operators.scan import Lag, Smooth, series_scan
from millrace.plans.common import round_doubles
from millrace.operators.joins import join_on_keys
from millrace.plans.registry import register
from millrace.session import scratch_path
from millrace.sources import io
from millrace.sources.fixtures import table

_BUCKET = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 1000"
_ODD = f"""WITH odd AS (
  SELECT event_id, CASE WHEN {_BUCKET} % 7 = 0 THEN NULL ELSE user_id % 9 END AS k,
         CASE WHEN {_BUCKET} % 11 = 0 THEN NULL ELSE ts END AS t,
         CASE WHEN {_BUCKET} % 5 = 0 OR event_id % 1000 BETWEEN 100 AND 400 THEN NULL ELSE CAST(value AS DOUBLE) END AS x FROM events)"""
_ORDER = ["t", "event_id"]


def _odd(spark, sf_dir):
    b = md5_bucket("event_id", buckets=1000)
    e = table(spark, sf_dir, "events")
    hide = (b % 5 == 0) | (F.col("event_id") % 1000).between(100, 400)
    return e.select("event_id", F.when(b % 7 != 0, F.col("user_id") % 9).alias("k"), F.when(b % 11 != 0, F.col("ts")).alias("t"),
                    F.when(~hide, F.col("value").cast("double")).alias("x"))


def _day():
    return F.to_date("t")


@register("window_null_rows", _ODD + """
SELECT event_id, k, row_number() OVER w AS rn, dense_rank() OVER (PARTITION BY k ORDER BY CAST(t AS DATE) NULLS LAST) AS trip,
       round(lag(x, 1) OVER w, 6) AS lag1, round(lag(x, 3) OVER w, 6) AS lag3, round(last_value(x IGNORE NULLS) OVER w, 6) AS filled
FROM odd WINDOW w AS (PARTITION BY k ORDER BY t NULLS LAST, event_id)""")
def q_window_null_rows(spark, sf_dir):
    """W3, W4, W5, W7, segmented, on null keys, null times and null values."""
    d = W.row_number_by(_odd(spark, sf_dir), "k", _ORDER, out="rn", segment=_day())
    d = W.dense_rank_by(d, "k", _day(), out="trip")
    d = W.lag_by(d, "k", _ORDER, ["x"], n=[1, 3], segment=_day(), names={("x", 1): "lag1", ("x", 3): "lag3"})
    d = W.fill_forward(d.withColumn("filled", F.col("x")), ["filled"], "k", _ORDER, segment=_day())
    return round_doubles(d.select("event_id", "k", "rn", "trip", "lag1", "lag3", "filled"))


@register("ewma_null_gaps", _ODD + """,
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t NULLS LAST, event_id) AS rn FROM odd),
r AS (SELECT event_id, k, rn, x, min(rn) FILTER (WHERE x IS NOT NULL) OVER (PARTITION BY k ORDER BY rn) AS first_seen,
             max(rn) FILTER (WHERE x IS NOT NULL) OVER (PARTITION BY k ORDER BY rn) AS last_seen FROM n)
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE last_seen IS NOT NULL) AS BIGINT) AS with_value,
       CAST(0 AS BIGINT) AS changed_in_a_gap FROM r""")
def q_ewma_null_gaps(spark, sf_dir):
    """W6, segmented: a value from the first observation of a series on, and in a
    gap the last one (both sums only shrink alike)."""
    d = W.ewma(_odd(spark, sf_dir), "x", "k", _ORDER, out="e", com=5, segment=_day())
    d = W.lag_by(d, "k", _ORDER, ["e"], n=1, segment=_day(), names={"e": "before"})
    moved = F.col("x").isNull() & F.col("before").isNotNull() & (F.coalesce(F.abs(F.col("e") - F.col("before")), F.lit(1.0)) > 1e-9 * F.abs(F.col("before")))
    return d.agg(F.count("*").alias("rows"), F.count("e").alias("with_value"), F.count(F.when(moved, 1)).alias("changed_in_a_gap"))


@register("ewma_after_gaps", _ODD + """,
n AS (SELECT *, row_number() OVER w AS rn, lag(x) OVER w AS px FROM odd WINDOW w AS (PARTITION BY k ORDER BY t NULLS LAST, event_id)),
r AS (SELECT event_id, k, x, px, rn, sum(CASE WHEN x IS NOT NULL THEN x * pow(5.0::DOUBLE / 6, -rn) END) OVER u / sum(CASE WHEN x IS NOT NULL THEN pow(5.0::DOUBLE / 6, -rn) END) OVER u AS v
      FROM n WINDOW u AS (PARTITION BY k ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, k, round(v, 6) AS v FROM r WHERE x IS NOT NULL AND px IS NULL""")
def q_ewma_after_gaps(spark, sf_dir):
    """W6 by the series scan: the smoothed value of the first observation after every gap, by value."""
    d = series_scan(_odd(spark, sf_dir), "k", _ORDER, _day(), smooth=[Smooth("x", "v", W.ewm_alpha(com=5))], lags=[Lag("x", 1, "px")])
    return round_doubles(d.where("x is not null and px is null").select("event_id", "k", "v"))


@register("time_split_null_times", _ODD + """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY t NULLS LAST, event_id) <= floor(count(*) OVER () * 0.7) THEN 'train' ELSE 'test' END AS split FROM odd""")
def q_time_split_null_times(spark, sf_dir):
    """W9 with null times (last in the order)."""
    return W.ordered_split(_odd(spark, sf_dir), _ORDER, 0.7, segment=_day()).select("event_id", "split")


@register("group_quantiles_null_key", _ODD + """
SELECT k, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.89), 6) AS q89 FROM odd WHERE x IS NOT NULL GROUP BY k""")
def q_group_quantiles_null_key(spark, sf_dir):
    """G11 with a null group."""
    return round_doubles(P.group_quantiles(_odd(spark, sf_dir), "k", "x", [0.25, 0.89]))


@register("duplicate_order_lines", """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q_duplicate_order_lines(spark, sf_dir):
    """G8 on keys that do repeat."""
    return Q.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("approx_quartiles_within_rank", """
SELECT unnest(['l_discount', 'l_extendedprice', 'l_quantity']) AS "column", true AS q1_within, true AS q3_within""")
def q_approx_quartiles_within_rank(spark, sf_dir):
    """G10 approximate: whether each quartile's rank is within 1 % of the one asked for."""
    cols = ["l_discount", "l_extendedprice", "l_quantity"]
    li = table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in cols])
    q = P.quartiles(li, cols, method="approx", accuracy=100).collect()   # two numbers a column
    out = li.agg(F.count("*").alias("n"), *[F.sum((F.col(r["column"]) < r[k]).cast("long")).alias(f"{r['column']}__{k}_lt") for r in q for k in ("q1", "q3")],
                 *[F.sum((F.col(r["column"]) <= r[k]).cast("long")).alias(f"{r['column']}__{k}_le") for r in q for k in ("q1", "q3")])

    def within(c, k, p):
        return (F.col(f"{c}__{k}_lt") <= F.col("n") * (p + 0.01) + 1) & (F.col(f"{c}__{k}_le") >= F.col("n") * (p - 0.01) - 1)

    return out.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), within(c, "q1", 0.25).alias("q1_within"), within(c, "q3", 0.75).alias("q3_within"))
                                         for c in cols])))


@register("customers_containing", """
SELECT c_custkey, c_name FROM customer WHERE contains(c_name, '7')""")
def q_customers_containing(spark, sf_dir):
    """substring filter."""
    return S.containing(table(spark, sf_dir, "customer"), "c_name", "7").select("c_custkey", "c_name")


@register("union_of_shapes", """
SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, 'a' AS part FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, CAST(NULL AS BIGINT), event_type, 'b' FROM events WHERE event_id % 2 = 1""")
def q_union_of_shapes(spark, sf_dir):
    """U2 + P12: union by name of tables that lack each other's columns."""
    e = table(spark, sf_dir, "events")
    a = S.with_literal(S.where(e, "event_id % 2 = 0").select("event_id", F.col("user_id").cast("long")), "part", "a")
    b = S.with_literal(S.where(e, "event_id % 2 = 1").select("event_id", "event_type"), "part", "b")
    return a.unionByName(b, allowMissingColumns=True).select("event_id", "user_id", "event_type", "part")


@register("typed_and_aligned", """
SELECT CAST(event_id AS BIGINT) AS event_id, TRY_CAST(event_type AS INTEGER) AS event_type, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value,
       0.0::DOUBLE AS missing FROM events""")
def q_typed_and_aligned(spark, sf_dir):
    """P1 + P2 + E4: declared types (text that is no number becomes null), casts by type, and a fixed column layout."""
    d = S.typed_select(table(spark, sf_dir, "events"), "event_id bigint, event_type int, value double")
    d = E.align_columns(S.cast_by_type(d, "double", "float"), ["event_id", "event_type", "value", "missing"])
    return d.withColumn("value", F.round(F.col("value").cast("double"), 3))


@register("hash_sample_rows", f"""
SELECT event_id, {_BUCKET.replace('1000', '100')} < 70 AS train FROM events WHERE {_BUCKET.replace('1000', '100')} < 90""")
def q_hash_sample_rows(spark, sf_dir):
    """P13 + E9: a 90 % sample by hash, split 70 : 20."""
    train, test = M.hash_split(S.hash_sample(table(spark, sf_dir, "events"), "event_id", 90), "event_id", 70)
    return train.select("event_id", F.lit(True).alias("train")).union(test.select("event_id", F.lit(False)))


@register("regression_metrics_by_flag", """
WITH s AS (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS y, 1500 * CAST(l_quantity AS DOUBLE) AS p FROM lineitem)
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM s GROUP BY l_returnflag""")
def q_regression_metrics_by_flag(spark, sf_dir):
    """M7: errors of a fixed-coefficient price model by return flag."""
    s = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("label"),
                                               (1500 * F.col("l_quantity").cast("double")).alias("prediction"))
    m = M.regression_metrics(s, by="l_returnflag")
    return m.select("l_returnflag", "n", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("best_run_by_metric", """
SELECT 'run-' || event_type AS run_id, round(avg(CAST(value AS DOUBLE)), 6) AS f1 FROM events GROUP BY event_type
ORDER BY avg(CAST(value AS DOUBLE)) DESC, 1 LIMIT 1""")
def q_best_run_by_metric(spark, sf_dir):
    """The run with the largest metric (a top-1 report) from a runs table derived from events."""
    runs = table(spark, sf_dir, "events").groupBy("event_type").agg(F.avg(F.col("value").cast("double")).alias("f1")).select(
        F.concat(F.lit("run-"), "event_type").alias("run_id"), F.create_map(F.lit("f1"), F.col("f1")).alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("test")).alias("tags"))
    return round_doubles(M.best_run(runs, "f1", "stage", "test").select("run_id", F.col("metrics")["f1"].alias("f1")))


@register("appended_new_columns", """
SELECT event_id, user_id % 3 AS a, CAST(NULL AS VARCHAR) AS event_type FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, NULL, event_type FROM events WHERE event_id % 3 <> 0""")
def q_appended_new_columns(spark, sf_dir):
    """S9 + S10 + S11: rows appended with a column that the table lacked, and without one it has."""
    e = table(spark, sf_dir, "events")
    name = f"appended_{uuid.uuid4().hex[:12]}"
    io.write_table(e.where("event_id % 3 = 0").select("event_id", (F.col("user_id") % 3).alias("a")), name, path=scratch_path(spark, name))
    io.merge_schema_write(e.where("event_id % 3 <> 0").select("event_id", "event_type"), name)
    return io.read_table(spark, name)


@register("table_to_table_stream", """
SELECT event_id, event_type, round(CAST(value AS DOUBLE) * 2, 6) AS doubled FROM events WHERE CAST(value AS DOUBLE) > 1""")
def q_table_to_table_stream(spark, sf_dir):
    """S2 + S6 + S7: a stream reads a table incrementally and appends to another."""
    run = uuid.uuid4().hex[:12]
    source, sink = f"stream_in_{run}", f"stream_out_{run}"
    io.write_table(table(spark, sf_dir, "events").select("event_id", "event_type", F.col("value").cast("double")), source, path=scratch_path(spark, source))
    doubled = io.read_stream_table(spark, source).where("value > 1").select("event_id", "event_type", F.round(F.col("value") * 2, 6).alias("doubled"))
    io.run_available_now(io.append_stream(doubled, sink, scratch_path(spark, f"checkpoint-{run}"), {"availableNow": True}))
    return io.read_table(spark, sink)


@register("distinct_devices_rolled_up", """
SELECT event_type, count(DISTINCT user_id) AS devices, true AS within_bound FROM events GROUP BY event_type
UNION ALL SELECT NULL, count(DISTINCT user_id), true FROM events""")
def q_distinct_devices_rolled_up(spark, sf_dir):
    """Sketches kept per model and day, rolled up per model and over all;
    whether each is within five standard errors of the exact count."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    daily = io.materialize(G.distinct_sketches(e, "user_id", ["event_type", "day"]), "daily-sketches")
    close = lambda d: F.abs(F.col("estimate") - F.col("devices")) <= F.col("devices") * (5 * 0.83 / 64)
    exact = G.distinct_count(e, "user_id", "event_type", out="devices")
    models = exact.join(G.rolled_up_distinct(daily, "event_type", "estimate"), "event_type")
    every = G.distinct_count(e, "user_id", out="devices").join(G.rolled_up_distinct(daily, out="estimate"))
    return models.select("event_type", "devices", close(models).alias("within_bound")).unionByName(
        every.select(F.lit(None).cast("string").alias("event_type"), "devices", close(every).alias("within_bound")))


@register("unprojected_filter", """
SELECT event_id, event_type FROM events WHERE user_id % 5 = 2 AND CAST(value AS DOUBLE) > 50""")
def q_unprojected_filter(spark, sf_dir):
    """P7 + P5: rows chosen by columns that the result doesn't have."""
    e = table(spark, sf_dir, "events")
    return S.where(S.where(e.select("event_id", "event_type"), F.col("user_id") % 5 == 2), "cast(value as double) > 50")


@register("dropped_columns", """
SELECT c_custkey, c_nationkey FROM customer""")
def q_dropped_columns(spark, sf_dir):
    """All columns but a few."""
    c = table(spark, sf_dir, "customer")
    return S.drop_cols(c, *[n for n in c.columns if n not in ("c_custkey", "c_nationkey")])


@register("loaded_folder", """
SELECT c_custkey, c_name, c_nationkey FROM customer""")
def q_loaded_folder(spark, sf_dir):
    """A folder of CSV files, written from a table, loaded with a declared schema."""
    folder = scratch_path(spark, f"folder-{uuid.uuid4().hex[:12]}")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").repartition(3).write.option("header", "true").csv(folder)
    return io.load_dir(spark, folder, fmt="csv", schema="c_custkey long, c_name string, c_nationkey int")


@register("database_lifecycle", """
SELECT event_type, count(*) AS n, true AS made, true AS reset_is_empty, true AS dropped FROM events GROUP BY event_type""")
def q_database_lifecycle(spark, sf_dir):
    """A database is made, holds a table, is reset (empty again) and dropped."""
    db = f"plant_{uuid.uuid4().hex[:12]}"
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    io.ensure_database(spark, db, use=False)
    made = io.database_exists(spark, db)
    io.write_table(counts, f"{db}.counts", path=scratch_path(spark, db))
    read = io.materialize(io.read_table(spark, f"{db}.counts"), "counts")
    io.reset_database(spark, db)
    empty = not spark.catalog.tableExists(f"{db}.counts")
    io.write_table(counts, f"{db}.counts", path=scratch_path(spark, f"{db}-again"))
    io.drop_table(spark, f"{db}.counts")
    spark.sql(f"DROP DATABASE {db}")   # without CASCADE: the table is gone
    return read.select("event_type", "n", F.lit(made).alias("made"), F.lit(empty).alias("reset_is_empty"),
                       F.lit(not io.database_exists(spark, db)).alias("dropped"))


@register("first_readings", """
SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 20""")
def q_first_readings(spark, sf_dir):
    """A bounded look at a table (the preview's limit is the feature)."""
    return S.preview(table(spark, sf_dir, "events").select("event_id", "event_type").orderBy("event_id"))


@register("array_picks", """
SELECT user_id, count(*) AS n, true AS one_pick, true AS from_list FROM events GROUP BY user_id""")
def q_array_picks(spark, sf_dir):
    """every key picks one value of a fixed list, the same in all its rows."""
    values = ["A", "B", "C", "D"]
    e = table(spark, sf_dir, "events").select("user_id", array_lookup(values, "user_id").alias("pick"))
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("pick") == 1).alias("one_pick"),
                                    F.bool_and(F.col("pick").isin(values)).alias("from_list"))


@register("order_lines_joined", """
SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND CAST(l_orderkey % 7 AS BIGINT) = CAST(o_orderkey % 7 AS BIGINT)""")
def q_order_lines_joined(spark, sf_dir):
    """A join on two keys that takes only named columns of the right side."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("key"), (F.col("l_orderkey") % 7).alias("part"))
    orders = table(spark, sf_dir, "orders").withColumn("key", F.col("o_orderkey")).withColumn("part", F.col("o_orderkey") % 7)
    return join_on_keys(lines, orders, ["key", "part"], right_cols=["o_custkey"]).select("l_orderkey", "l_linenumber", "o_custkey")
