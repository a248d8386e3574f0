"""Replication inputs derived from the benchmark tables, in Spark and in SQL alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("changed"),
    )


def target(spark, d) -> DataFrame:
    return orders(spark, d).where("k % 10 <> 0")


def stage(spark, d) -> DataFrame:
    return orders(spark, d).where("k % 4 = 0").withColumn("price", (F.col("price") + 1).cast("decimal(18,2)"))


def snapshot(spark, d) -> DataFrame:
    return orders(spark, d).where("k % 7 <> 0").withColumn("price", F.when(F.col("k") % 3 == 0, F.col("price") + 5).otherwise(F.col("price")).cast("decimal(18,2)"))


def changes(spark, d) -> DataFrame:
    return stage(spark, d).withColumn("_op", F.element_at(F.array(F.lit("I"), F.lit("u"), F.lit("D")), (F.col("k") % 3 + 1).cast("int")))


def cdc_log(spark, d) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("v"), F.col("event_id").alias("_seq"), op.alias("_op"))


def cdc_target(spark, d) -> DataFrame:
    return table(spark, d, "events").where("user_id % 3 <> 0").select(F.col("user_id").alias("k")).distinct().withColumn("v", F.lit("seed"))


def cdc_images(spark, d) -> DataFrame:
    """Rows read again: users that still exist at the source."""
    return table(spark, d, "events").where("user_id % 5 <> 0").groupBy(F.col("user_id").alias("k")).agg(F.concat(F.lit("image "), F.count("*").cast("string")).alias("v"))


def latency_log(spark, d) -> DataFrame:
    """A change log in which every seventh row is delivered again a minute later."""
    e = table(spark, d, "events").select(
        F.col("user_id").alias("k"), F.col("event_id").alias("_seq"), F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U").alias("_op"),
        F.lit(1).cast("long").alias("_run_id"), F.col("ts").cast("timestamp").alias("_commit_ts"),
    )
    e = e.withColumn("_applied_at", F.col("_commit_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_seq") % 30).cast("decimal(18,6)")))
    again = e.where("_seq % 7 = 0").withColumn("_applied_at", F.col("_applied_at") + F.expr("interval 60 seconds")).withColumn("_seq", F.col("_seq") + 100_000_000)
    return e.unionByName(again)


def runs(spark, d) -> DataFrame:
    """Run statistics: orders by month and status."""
    o = table(spark, d, "orders").withColumn("month", F.date_trunc("month", "o_orderdate"))
    g = o.groupBy("month", F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("m"))
    return g.select(
        (F.year("month") * 100 + F.month("month")).cast("long").alias("run_id"), F.concat(F.lit("t_"), F.lower("s")).alias("target"), F.col("month").cast("timestamp").alias("ts"),
        F.when(F.col("s") == "F", "CDC").when(F.col("s") == "O", "WATERMARK").otherwise("SNAPSHOT").alias("method"), F.when(F.col("m") % 5 == 0, "ERROR").otherwise("SUCCESS").alias("status"),
        F.col("n").alias("rows_ins"), F.floor(F.col("n") / 2).alias("rows_upd"), (F.col("n") % 3).alias("rows_del"), (F.col("n") % 4 * 250).alias("duration_ms"),
    )


def registry(spark, d) -> DataFrame:
    """A row per market segment and nation, as targets; some have never run."""
    c = table(spark, d, "customer").groupBy(F.concat_ws("_", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("target")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("m"))
    at = lambda expr: F.timestamp_seconds(F.lit(1_700_000_000) - expr)
    return c.select(
        "target", F.lit("WATERMARK").alias("method"), F.when(F.col("m") % 11 == 0, "BLOCKED").otherwise("ACTIVE").alias("status"), F.when(F.col("m") % 7 != 0, at(F.col("m") * 60)).alias("last_run_ts"),
        (F.col("m") % 4).alias("fail_count"), F.when(F.col("m") % 13 == 0, at(-F.col("m"))).alias("parked_until"), F.when(F.col("m") % 3 == 0, at(F.col("m"))).alias("lease_ts"),
        F.lit(300).cast("long").alias("max_cycle_secs"), (F.col("n") % 5).alias("pending_spill"), F.when(F.col("m") % 9 == 0, "slow").alias("last_warning"),
    )


def registry_runs(spark, d) -> DataFrame:
    r = registry(spark, d).where("last_run_ts is not null")
    return r.select("target", F.lit(1).cast("long").alias("run_id"), F.col("pending_spill").alias("rows_ins"), F.col("fail_count").alias("rows_upd"), (F.col("fail_count") + 1).alias("rows_del")).unionByName(
        r.select("target", F.lit(2).cast("long").alias("run_id"), (F.col("pending_spill") + 10).alias("rows_ins"), F.col("fail_count").alias("rows_upd"), F.lit(0).cast("long").alias("rows_del"))
    )


def registry_cdc(spark, d) -> DataFrame:
    return registry(spark, d).where("fail_count = 1").select("target", F.when(F.col("pending_spill") == 2, "BROKEN").otherwise("OK").alias("status"))


def database(spark) -> tuple[str, str] | None:
    """(url, driver) of the database that stands for a foreign one; None where the session has none that all tasks reach.

    That is the one of the session's tidemark.jdbc.url and tidemark.jdbc.driver; unset, Spark's embedded one, which lives in
    the driver's process and so reaches its tasks in local mode alone, not those of a cluster or a local cluster.
    """
    url = spark.conf.get("tidemark.jdbc.url", None)
    if not url and re.match(r"local(\[|$)", spark.sparkContext.master):
        url = "jdbc:derby:memory:tidemark;create=true"
    return (url, spark.conf.get("tidemark.jdbc.driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver")) if url else None


def foreign(spark, rows: DataFrame, types: str = "") -> tuple[str, str, dict]:
    """(url, table, options) of rows written to that database over JDBC."""
    import uuid

    reached = database(spark)
    if not reached:
        raise ValueError("set tidemark.jdbc.url to a database that all executors reach")
    (url, driver), name = reached, f"T_{uuid.uuid4().hex}".upper()
    options, more = {"driver": driver}, {"createTableColumnTypes": types} if types else {}
    rows.coalesce(4).write.format("jdbc").options(url=url, dbtable=name, batchsize="10000", **more, **options).save()
    return url, name, options


def foreign_files(spark, rows: DataFrame) -> DataFrame:
    """Rows as a table of another format in the folder that driver and executors share: the foreign table where no database is reached."""
    path = fresh_path(spark, "foreign")
    rows.write.orc(path)
    return spark.read.schema(rows.schema).orc(path)


NOW = 1_700_000_000

ORD = "ord AS (SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price, strftime(o_orderdate, '%Y%m%d%H%M%S') AS changed FROM orders)"
T = "t AS (SELECT * FROM ord WHERE k % 10 <> 0)"
S = "s AS (SELECT k, cust, status, CAST(price + 1 AS DECIMAL(18,2)) AS price, changed FROM ord WHERE k % 4 = 0)"
N = "n AS (SELECT k, cust, status, CAST(CASE WHEN k % 3 = 0 THEN price + 5 ELSE price END AS DECIMAL(18,2)) AS price, changed FROM ord WHERE k % 7 <> 0)"
C = "c AS (SELECT *, CASE k % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'u' ELSE 'D' END AS _op FROM s)"
L = "l AS (SELECT user_id AS k, event_type AS v, event_id AS _seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op FROM events)"
U = "u AS (SELECT DISTINCT user_id AS k, 'seed' AS v FROM events WHERE user_id % 3 <> 0)"
IMG = "i AS (SELECT user_id AS k, 'image ' || CAST(count(*) AS VARCHAR) AS v FROM events WHERE user_id % 5 <> 0 GROUP BY user_id)"
NET = "net AS (SELECT k, v, _seq, _op FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY _seq DESC) AS rn FROM l) WHERE rn = 1)"
LAT = "e0 AS (SELECT user_id AS k, event_id AS _seq, CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS _op, CAST(1 AS BIGINT) AS _run_id, ts AS _commit_ts, ts + to_seconds(event_id % 30) AS _applied_at FROM events), g AS (SELECT * FROM e0 UNION ALL SELECT k, _seq + 100000000, _op, _run_id, _commit_ts, _applied_at + to_seconds(60) FROM e0 WHERE _seq % 7 = 0)"
RUNS = """r AS (SELECT CAST(year(m0) * 100 + month(m0) AS BIGINT) AS run_id, 't_' || lower(s) AS target, CAST(m0 AS TIMESTAMP) AS ts, CASE s WHEN 'F' THEN 'CDC' WHEN 'O' THEN 'WATERMARK' ELSE 'SNAPSHOT' END AS method,
 CASE WHEN m % 5 = 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status, n AS rows_ins, n // 2 AS rows_upd, n % 3 AS rows_del, n % 4 * 250 AS duration_ms
 FROM (SELECT date_trunc('month', o_orderdate) AS m0, o_orderstatus AS s, count(*) AS n, min(o_orderkey) AS m FROM orders GROUP BY ALL))"""
REG = """reg AS (SELECT target, 'WATERMARK' AS method, CASE WHEN m % 11 = 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status, CASE WHEN m % 7 <> 0 THEN 1700000000 - m * 60 END AS last_run, m % 4 AS fail_count,
 CASE WHEN m % 13 = 0 THEN 1700000000 + m END AS parked, CASE WHEN m % 3 = 0 THEN 1700000000 - m END AS lease, CAST(300 AS BIGINT) AS max_cycle_secs, n % 5 AS pending_spill, CASE WHEN m % 9 = 0 THEN 'slow' END AS last_warning
 FROM (SELECT lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS target, count(*) AS n, min(c_custkey) AS m FROM customer GROUP BY 1)),
 v AS (SELECT target, status, fail_count, pending_spill, last_warning, 1700000000 - last_run AS lag_seconds, status = 'BLOCKED' AS is_blocked, coalesce(parked > 1700000000, false) AS is_parked, 1700000000 - lease AS lease_age,
 coalesce(1700000000 - lease > max_cycle_secs, false) AS is_stale, CASE WHEN last_run IS NOT NULL THEN pending_spill + 10 END AS last_ins, CASE WHEN last_run IS NOT NULL THEN fail_count END AS last_upd, CASE WHEN last_run IS NOT NULL THEN 0 END AS last_del,
 CASE WHEN fail_count = 1 THEN CASE WHEN pending_spill = 2 THEN 'BROKEN' ELSE 'OK' END END AS cdc_status FROM reg),
 w AS (SELECT *, lag_seconds IS NOT NULL AND lag_seconds <= 86400 AND fail_count = 0 AND NOT is_blocked AND NOT is_parked AND NOT is_stale AND coalesce(cdc_status, 'OK') = 'OK' AS is_healthy FROM v)"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
