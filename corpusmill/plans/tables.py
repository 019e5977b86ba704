"""Queries over the generic tables: events as measurements, lineitem for summaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import metrics
from ..sources.files import ensure_checkpoint_dir
from . import sql as S  # noqa: F401
from .registry import query, table


@query(
    "strategy_scores",
    """WITH e AS (SELECT event_type AS strategy, value > 20 AS fired, user_id % 3 = 0 AS ref, value > 60 AS correct, value AS ms FROM events), g AS (SELECT strategy, count(*) AS attempts, count(*) FILTER (fired) AS fired, count(*) FILTER (fired AND ref) AS ref_available, count(*) FILTER (fired AND ref AND correct) AS correct, sum(ms) AS t FROM e GROUP BY strategy)
    SELECT strategy, attempts, fired, ref_available, correct, round(t, 2) AS total_ms, round(correct / nullif(ref_available, 0), 4) AS precision, round(t / attempts, 2) AS cost_all FROM g""",
)
def strategy_scores(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("strategy", F.col("event_type"))
    out = metrics.strategy_scores(e, ["strategy"], F.col("value") > 20, F.pmod("user_id", F.lit(3)) == 0, F.col("value") > 60, F.col("value"))
    return out.select("strategy", "attempts", "fired", "ref_available", "correct", F.round("total_ms", 2).alias("total_ms"), "precision", F.round(F.col("total_ms") / F.col("attempts"), 2).alias("cost_all"))


@query("strategy_distribution", "SELECT coalesce(CASE WHEN value > 20 THEN event_type END, '[missed]') AS strategy, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 2) AS pct FROM events GROUP BY 1")
def strategy_distribution(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy(F.coalesce(F.when(F.col("value") > 20, F.col("event_type")), F.lit("[missed]")).alias("strategy")).agg(F.count("*").alias("n"))
    return n.select("strategy", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2).alias("pct"))  # one row for each strategy


@query("epoch_iso", "SELECT event_id, strftime(make_timestamp(1700000000000000 + event_id * 61000000), '%Y-%m-%dT%H:%M:%S') AS iso, strftime(make_timestamp(1700000000000000 + event_id * 61000000), '%H:%M') AS clock FROM events")
def epoch_iso(spark, sf_dir):
    at = F.lit(1_700_000_000) + F.col("event_id") * 61
    return table(spark, sf_dir, "events").select("event_id", dates.epoch_iso(at).alias("iso"), dates.epoch_clock(at).alias("clock"))


@query("json_path_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_path_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("quantity_summary", "SELECT l_returnflag, count(l_quantity) AS n, round(avg(CAST(l_quantity AS DOUBLE)), 4) AS mean, CAST(median(CAST(l_quantity AS DOUBLE)) AS DOUBLE) AS median, min(CAST(l_quantity AS DOUBLE)) AS min, max(CAST(l_quantity AS DOUBLE)) AS max FROM lineitem GROUP BY l_returnflag")
def quantity_summary(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return metrics.summary(table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("q")), ["l_returnflag"], "q")
