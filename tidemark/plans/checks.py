"""Queries of data quality, monitoring and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, merge, metrics, quality
from ..sources.scratch import fresh_path
from ..sources.store import Target
from ..streaming import streams
from . import scenarios as X
from .registry import query
from .syncs import BASE, CDC, COLS, IMAGE, K, UPSERT


# -- quality -------------------------------------------------------------------------------------------


@query("A01_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return merge.duplicate_keys(X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


FIELDS = "SELECT DISTINCT o_orderpriority || '_' || o_orderstatus AS name, CASE o_orderstatus WHEN 'F' THEN 'CHAR' ELSE 'INT4' END AS datatype, 10 AS length FROM orders"


@query("Q01_schema_drift", f"WITH a AS ({FIELDS}), s AS (SELECT * FROM a WHERE name NOT LIKE '1%'), t AS (SELECT lower(name) AS name, datatype, CASE WHEN name LIKE '3%' THEN 20 ELSE length END AS length FROM a WHERE name NOT LIKE '2%'), j AS (SELECT lower(coalesce(s.name, t.name)) AS name, CASE WHEN t.name IS NULL THEN 'added' WHEN s.name IS NULL THEN 'removed' WHEN s.length <> t.length THEN 'retyped' END AS change FROM s FULL JOIN t ON lower(s.name) = t.name) SELECT name, change, change <> 'added' AS blocked FROM j WHERE change IS NOT NULL")
def schema_drift(spark, d):
    a = X.table(spark, d, "orders").select(F.concat_ws("_", "o_orderpriority", "o_orderstatus").alias("name"), F.when(F.col("o_orderstatus") == "F", "CHAR").otherwise("INT4").alias("datatype"), F.lit(10).alias("length")).distinct()
    t = a.where("name not like '2%'").select(F.lower("name").alias("name"), "datatype", F.when(F.col("name").like("3%"), 20).otherwise(F.col("length")).alias("length"))
    return quality.schema_drift(a.where("name not like '1%'"), t)


@query("Q02_evolve", BASE + "SELECT k, cust, status, price, changed, NULL AS note FROM t")
def evolve(spark, d):
    t = X.target(spark, d)
    s = t.withColumn("note", F.lit("x"))
    table = lambda df: spark.createDataFrame(quality.field_table(df.schema), "name string, datatype string")
    return quality.evolve(t, s.schema, quality.schema_drift(table(s), table(t)))


@query("Q03_cell_text", "SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS a, hex(o_orderstatus) AS b, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN rtrim(o_orderpriority || '   ') END, '') AS c FROM orders")
def cell_text(spark, d):
    rows = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(18,2)").alias("a"), F.col("o_orderstatus").cast("binary").alias("b"), F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderpriority", F.lit("   "))).alias("c"))
    return rows.select("k", *[quality.cell_text(c, rows.schema[c].dataType).alias(c) for c in "abc"])


@query("Q04_row_fingerprint", X.with_(X.ORD) + "SELECT k, md5(concat_ws('|', CAST(k AS VARCHAR), CAST(cust AS VARCHAR), status, CAST(price AS VARCHAR), changed)) AS fp FROM ord")
def row_fingerprint(spark, d):
    o = X.orders(spark, d)
    return o.select("k", quality.row_fingerprint(o).alias("fp"))


@query("Q05_row_key_text", X.with_(X.ORD) + "SELECT k, (CASE WHEN k % 2 = 0 THEN 'a\\|b' ELSE 'c\\\\' END) || '|' || CAST(k AS VARCHAR) || '|' AS key_text FROM ord")
def row_key_text(spark, d):
    o = X.orders(spark, d).withColumn("odd", F.when(F.col("k") % 2 == 0, "a|b").otherwise("c\\"))
    return o.select("k", quality.row_key_text(o, ["odd", "k"]).alias("key_text"))


DIFF = "m AS (SELECT k, max(CASE side WHEN 't' THEN fp END) AS a, max(CASE side WHEN 'n' THEN fp END) AS b FROM (SELECT k, 't' AS side, status || price AS fp FROM t UNION ALL SELECT k, 'n', status || price FROM n) GROUP BY k)"


@query("U02_multiset_difference", BASE + ", " + DIFF + " SELECT CAST(k AS VARCHAR) || '|' AS k, CASE x WHEN 1 THEN 1 ELSE 0 END AS n_source, CASE x WHEN 2 THEN 1 ELSE 0 END AS n_replica FROM m, (VALUES (1), (2)) v(x) WHERE a IS DISTINCT FROM b AND ((x = 1 AND a IS NOT NULL) OR (x = 2 AND b IS NOT NULL))")
def multiset_difference(spark, d):
    return quality.multiset_difference(X.target(spark, d), X.snapshot(spark, d), K, ["status", "price"]).drop("fp")


@query("Q06_validate_full", BASE + ", " + DIFF + " SELECT (SELECT count(*) FROM t) AS source_rows, (SELECT count(*) FROM n) AS replica_rows, count(*) FILTER (a <> b) AS mismatched, count(*) FILTER (b IS NULL) AS missing, count(*) FILTER (a IS NULL) AS extra, 'FAIL' AS status FROM m")
def validate_full(spark, d):
    return quality.validate_full(X.target(spark, d), X.snapshot(spark, d), K, ["status", "price"])


@query("Q07_validate_sample", BASE + ", p AS (SELECT * FROM t ORDER BY md5(CAST(k AS VARCHAR) || '|'), k LIMIT 500), q AS (SELECT p.k, p.status || p.price AS a, n.status || n.price AS b, n.k AS nk FROM p LEFT JOIN n ON p.k = n.k) SELECT count(*) AS source_rows, count(nk) AS replica_rows, count(*) FILTER (a <> b) AS mismatched, count(*) FILTER (nk IS NULL) AS missing, CAST(0 AS BIGINT) AS extra, 'FAIL' AS status FROM q")
def validate_sample(spark, d):
    return quality.validate_sample(X.target(spark, d), X.snapshot(spark, d), K, ["status", "price"], 500)


CELLS = "SELECT coalesce(t.k, n.k) AS k, CASE WHEN t.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS diff, x AS column_name, CASE x WHEN 'price' THEN CAST(t.price AS VARCHAR) ELSE t.status END AS value_a, CASE x WHEN 'price' THEN CAST(n.price AS VARCHAR) ELSE n.status END AS value_b FROM t FULL JOIN n ON t.k = n.k, (VALUES ('price'), ('status')) v(x)"


@query("Q08_cell_diff", BASE + f"SELECT * FROM ({CELLS}) WHERE diff <> 'changed' OR value_a IS DISTINCT FROM value_b")
def cell_diff(spark, d):
    return quality.cell_diff(X.target(spark, d), X.snapshot(spark, d), K, ["price", "status"])


@query("J07_joindiff", BASE + "SELECT diff, count(*) AS n FROM (SELECT CASE WHEN t.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN t.price IS DISTINCT FROM n.price THEN 'changed' END AS diff FROM t FULL JOIN n ON t.k = n.k) WHERE diff IS NOT NULL GROUP BY 1")
def joindiff(spark, d):
    return quality.cell_diff(X.target(spark, d), X.snapshot(spark, d), K, ["price"]).groupBy("diff").agg(F.count("*").alias("n"))


@query("Q09_refuse_duplicates", "SELECT count(*) AS keys, max(n) AS worst FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1")
def worst_duplicate(spark, d):
    return merge.duplicate_keys(X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("keys"), F.max("n").alias("worst"))


@query("Q11_parity_matrix", BASE + "SELECT 'snapshot' AS method, CAST(0 AS BIGINT) AS diffs UNION ALL SELECT 'merge', CAST(0 AS BIGINT) UNION ALL SELECT 'watermark', (SELECT count(*) FROM t WHERE k NOT IN (SELECT k FROM n)) UNION ALL SELECT 'tampered cell', CAST(1 AS BIGINT)")
def parity_matrix(spark, d):
    t, n = X.target(spark, d), X.snapshot(spark, d)
    gone = merge.anti(t, n, K).select("k", *[F.lit(None).cast(t.schema[c].dataType).alias(c) for c in t.columns[1:]]).withColumn("_op", F.lit("D"))
    out = {
        "snapshot": merge.snapshot_merge(t, n, K), "merge": merge.apply_merge(t, n.withColumn("_op", F.lit("U")).unionByName(gone), K, "_op"),
        "watermark": merge.apply_upsert(t, n, K), "tampered cell": n.withColumn("status", F.when(F.col("k") == 1, "?").otherwise(F.col("status"))),
    }
    rows = [quality.cell_diff(n, v, K, t.columns[1:]).select("k").distinct().agg(F.lit(m).alias("method"), F.count("*").alias("diffs")) for m, v in out.items()]
    from ..sources.loads import union_by_name

    return union_by_name(rows)


@query("Q12_audit_reconcile", CDC + ", truth AS (SELECT k, 'seed' AS v FROM (SELECT DISTINCT k FROM l) WHERE k % 2 = 0), tg AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'stale' ELSE v END AS v FROM u), au AS (SELECT DISTINCT k FROM l WHERE _op = 'D') SELECT (SELECT count(*) FROM truth WHERE k NOT IN (SELECT k FROM tg)) AS lost, (SELECT count(*) FROM tg WHERE k NOT IN (SELECT k FROM truth) AND k NOT IN (SELECT k FROM au)) AS phantom, (SELECT count(*) FROM truth JOIN tg ON truth.k = tg.k WHERE truth.v IS DISTINCT FROM tg.v) AS stale, (SELECT avg(CASE WHEN tg.k IS NULL THEN 0.0 ELSE 1.0 END) FROM au LEFT JOIN tg ON au.k = tg.k) AS audit_share")
def audit_reconcile(spark, d):
    log = X.cdc_log(spark, d)
    truth = log.select("k").distinct().where("k % 2 = 0").withColumn("v", F.lit("seed"))
    target = X.cdc_target(spark, d).withColumn("v", F.when(F.col("k") % 7 == 0, "stale").otherwise(F.col("v")))
    return quality.audit_reconcile(truth, log.where("_op = 'D'"), target, K, ["v"])


# -- monitoring ------------------------------------------------------------------------------------------


@query("V01_run_stats", X.with_(X.RUNS) + "SELECT target, run_id, strftime(ts - to_milliseconds(duration_ms), '%Y-%m-%d %H:%M:%S.%g') AS started, rows_ins + rows_upd + rows_del AS rows_applied, CASE WHEN duration_ms > 0 THEN (rows_ins + rows_upd + rows_del) * 1000.0 / duration_ms END AS rows_per_sec, status = 'SUCCESS' AS is_success FROM r")
def v_run_stats(spark, d):
    return metrics.run_stats(X.runs(spark, d)).select("target", "run_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("started"), "rows_applied", F.col("rows_per_sec").cast("double").alias("rows_per_sec"), "is_success")


@query("W04_latest_run", X.with_(X.RUNS) + "SELECT target, run_id, status, rows_ins FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY run_id DESC) AS rn FROM r) WHERE rn = 1")
def latest_run(spark, d):
    return metrics.latest_run(X.runs(spark, d)).select("target", "run_id", "status", "rows_ins")


@query("A05_throughput", X.with_(X.RUNS) + "SELECT target, count(*) AS runs, CAST(sum(rows_ins + rows_upd + rows_del) AS BIGINT) AS rows_applied, round(avg(CASE WHEN duration_ms > 0 THEN (rows_ins + rows_upd + rows_del) * 1000.0 / duration_ms END), 4) AS avg_rate FROM r WHERE ts >= TIMESTAMP '1998-01-01' GROUP BY 1")
def a_throughput(spark, d):
    return metrics.throughput_per_target(X.runs(spark, d), F.lit("1998-01-01").cast("timestamp"))


@query("A06_last_per_target", X.with_(X.RUNS) + "SELECT target, strftime(max(ts), '%Y-%m-%d') AS last_ts, arg_max(status, run_id) AS last_status FROM r GROUP BY 1")
def a_last(spark, d):
    return metrics.last_per_target(X.runs(spark, d)).withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd"))


@query("A07_success_rate", X.with_(X.RUNS) + "SELECT method, count(*) AS runs, round(100.0 * count(*) FILTER (status = 'SUCCESS') / count(*), 4) AS success_percent FROM r GROUP BY 1")
def a_success(spark, d):
    return metrics.success_rate(X.runs(spark, d)).withColumn("success_percent", F.col("success_percent").cast("double"))


@query("A08_deletes_reconciled", X.with_(X.RUNS) + "SELECT target, CAST(sum(rows_del) AS BIGINT) AS rows_del FROM r GROUP BY 1 HAVING sum(rows_del) > 0")
def a_deletes(spark, d):
    return metrics.deletes_reconciled(X.runs(spark, d))


@query("A09_failed_runs", X.with_(X.RUNS) + "SELECT target, run_id, status FROM r WHERE status <> 'SUCCESS' ORDER BY ts DESC, run_id DESC")
def a_failed(spark, d):
    return metrics.failed_runs(X.runs(spark, d)).select("target", "run_id", "status")


@query("A11_op_counters", X.with_(X.RUNS) + "SELECT target, CAST(sum(rows_ins) AS BIGINT) AS rows_ins, CAST(sum(rows_upd) AS BIGINT) AS rows_upd, CAST(sum(rows_del) AS BIGINT) AS rows_del FROM r GROUP BY 1")
def a_counters(spark, d):
    return metrics.op_counters(X.runs(spark, d))


def _view(spark, d):
    return metrics.targets(X.registry(spark, d), X.registry_runs(spark, d), X.registry_cdc(spark, d), F.timestamp_seconds(F.lit(X.NOW)))


VIEW = "target, lag_seconds, is_blocked, is_parked, lease_age, is_stale, cdc_status, is_healthy, last_ins, last_upd, last_del"


@query("V02_targets", X.with_(X.REG) + f"SELECT {VIEW} FROM w")
def v_targets(spark, d):
    return _view(spark, d).select(VIEW.split(", "))


@query("J08_latest_run_join", X.with_(X.REG) + "SELECT target, last_ins, cdc_status FROM w")
def latest_run_join(spark, d):
    return _view(spark, d).select("target", "last_ins", "cdc_status")


HEALTH = "SELECT count(*) AS targets, count(*) FILTER (is_healthy) AS healthy, count(*) FILTER (is_blocked) AS blocked, count(*) FILTER (is_parked) AS parked, count(*) FILTER (fail_count > 0) AS failing, max(lag_seconds) AS worst_lag, count(*) FILTER (lag_seconds IS NULL) AS never_run, count(*) FILTER (is_stale) AS stale_leases, CAST(sum(pending_spill) AS BIGINT) AS pending_spill, count(last_warning) AS warned FROM w"


@query("V03_health", X.with_(X.REG) + HEALTH)
def v_health(spark, d):
    return metrics.health(_view(spark, d))


@query("A10_health_rollup", X.with_(X.REG) + HEALTH)
def a_health(spark, d):
    return metrics.health(_view(spark, d))


@query("V04_metric_rows", X.with_(X.REG) + " UNION ALL ".join(f"SELECT '{m}' AS metric, target, CAST({m if m == 'lag_seconds' else f'coalesce({m}, 0)'} AS DOUBLE) AS value FROM w WHERE {m + ' IS NOT NULL' if m == 'lag_seconds' else 'true'}" for m in metrics.METRICS))
def v_metric_rows(spark, d):
    return metrics.metric_rows(_view(spark, d))


@query("T03_ranked_targets", X.with_(X.REG) + "SELECT target, CASE WHEN is_blocked THEN 0 WHEN is_parked THEN 1 WHEN lag_seconds IS NULL THEN 2 WHEN fail_count > 0 THEN 3 WHEN NOT is_healthy THEN 4 ELSE 5 END AS severity, lag_seconds FROM w")
def t_ranked(spark, d):
    return metrics.ranked(_view(spark, d)).select("target", "severity", "lag_seconds")


FIRST = "f AS (SELECT k, _commit_ts, min(_applied_at) AS _applied_at, arg_min(_op, (_applied_at, _seq)) AS _op FROM g GROUP BY 1, 2), h AS (SELECT *, (epoch_ms(_applied_at) - epoch_ms(_commit_ts)) / 1000.0 AS s FROM f)"
STATS = "SELECT count(*) AS samples, round(avg(s), 6) AS mean, quantile_disc(s, 0.5) AS p50, quantile_disc(s, 0.95) AS p95, quantile_disc(s, 0.99) AS p99, min(s) AS least, max(s) AS most, count(*) FILTER (_op = 'I') AS n_i, count(*) FILTER (_op = 'U') AS n_u, count(*) FILTER (_op = 'D') AS n_d FROM h"


@query("A03_first_apply", X.with_(X.LAT) + ", " + FIRST + " SELECT k, strftime(_commit_ts, '%Y%m%d%H%M%S') AS committed, CAST(s AS DOUBLE) AS latency_seconds, _op FROM h")
def a_first_apply(spark, d):
    return metrics.first_apply(X.latency_log(spark, d), K).select("k", F.date_format("_commit_ts", "yyyyMMddHHmmss").alias("committed"), F.col("latency_seconds").cast("double").alias("latency_seconds"), "_op")


@query("A02_latency_percentiles", X.with_(X.LAT) + ", " + FIRST + " " + STATS)
def a_latency(spark, d):
    return _doubles(metrics.latency_stats(X.latency_log(spark, d), K))


@query("V05_latency_stats", X.with_(X.LAT) + ", " + FIRST + " " + STATS + " WHERE _commit_ts >= (SELECT min(_commit_ts) + INTERVAL 1 DAY FROM g)")
def v_latency(spark, d):
    log = X.latency_log(spark, d)
    since = log.agg((F.min("_commit_ts") + F.expr("interval 1 day")).alias("since")).scalar()  # one row, within the same query
    return _doubles(metrics.latency_stats(log, K, since))


@query("V06_meets_target", X.with_(X.LAT) + ", " + FIRST + f", z AS ({STATS}) SELECT samples, p95, p99, samples > 0 AND p95 <= 28 AND p99 <= 28 AS meets FROM z")
def v_meets(spark, d):
    return _doubles(metrics.meets_target(metrics.latency_stats(X.latency_log(spark, d), K), 28, 28)).select("samples", "p95", "p99", "meets")


@query("A04_lag_by_operation", X.with_(X.LAT) + ", x AS (SELECT _op, (epoch_ms(_applied_at) - epoch_ms(_commit_ts)) / 1000.0 AS lag FROM g) SELECT _op, CAST(min(lag) AS DOUBLE) AS least, CAST(median(lag) AS DOUBLE) AS median, CAST(max(lag) AS DOUBLE) AS most FROM x GROUP BY 1")
def a_lag(spark, d):
    return _doubles(metrics.lag_by_operation(X.latency_log(spark, d)))


def _doubles(df):
    return df.select([F.col(c).cast("double").alias(c) if k.startswith("decimal") or k == "double" else F.col(c) for c, k in df.dtypes])


SAMPLES = "sm AS (SELECT event_type AS target, date_trunc('minute', ts) AS ts, max(event_id) AS rows, max(event_id // 2) AS upd, max(event_id // 3) AS del FROM events GROUP BY 1, 2), df AS (SELECT target, ts, (epoch_ms(ts) - epoch_ms(lag(ts) OVER w)) / 1000.0 AS dt, rows - lag(rows) OVER w AS r, upd - lag(upd) OVER w AS u, del - lag(del) OVER w AS d FROM sm WINDOW w AS (PARTITION BY target ORDER BY ts))"
RATES = "SELECT target, strftime(ts, '%Y%m%d%H%M') AS ts, CAST(round(greatest(r, 0) / dt, 6) AS DOUBLE) AS ins_rate, CAST(round(u / dt, 6) AS DOUBLE) AS upd_rate, CAST(round(greatest(d, -r) / dt, 6) AS DOUBLE) AS del_rate FROM df WHERE dt >= 0.5"


def _rates(spark, d):
    e = X.table(spark, d, "events").groupBy(F.col("event_type").alias("target"), F.date_trunc("minute", "ts").alias("ts"))
    samples = e.agg(F.max("event_id").alias("rows"), F.max(F.floor(F.col("event_id") / 2)).alias("upd"), F.max(F.floor(F.col("event_id") / 3)).alias("del")).withColumn("ts", F.col("ts").cast("timestamp"))
    return _doubles(metrics.throughput(samples)).withColumn("ts", F.date_format("ts", "yyyyMMddHHmm"))


@query("W06_throughput_rates", f"WITH {SAMPLES} {RATES}")
def w_rates(spark, d):
    return _rates(spark, d)


@query("V07_throughput", f"WITH {SAMPLES}, x AS ({RATES}) SELECT target, count(*) AS n, max(ins_rate) AS top FROM x GROUP BY 1")
def v_rates(spark, d):
    return _rates(spark, d).groupBy("target").agg(F.count("*").alias("n"), F.max("ins_rate").alias("top"))


# -- streaming -------------------------------------------------------------------------------------------

ROWS_A_FILE = 1_000_000


def _stream_of(spark, rows, batches: int, key: str):
    """rows as a directory of files by ranges of key, read as a stream in about so many micro-batches.

    A file has at most ROWS_A_FILE rows, so its size doesn't follow the table's; a micro-batch has many files then.
    """
    path = fresh_path(spark, "stream")
    files = max(batches, -(-rows.count() // ROWS_A_FILE))
    rows.repartitionByRange(files, key).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(path)


@query("S01_stream_cdc", CDC + IMAGE)
def stream_cdc(spark, d):
    t = Target(spark, fresh_path(spark, "target"), K)
    t.create(X.cdc_target(spark, d).select("k", "v", F.lit(-1).cast("long").alias("_seq"), F.lit("I").alias("_op")))
    streams.stream_cdc(_stream_of(spark, X.cdc_log(spark, d), 3, "_seq"), t, fresh_path(spark, "checkpoint"))
    return streams.read_live(t).select("k", "v")


@query("S02_stream_delta", BASE + UPSERT)
def stream_delta(spark, d):
    t = Target(spark, fresh_path(spark, "target"), K)
    t.create(X.target(spark, d))
    streams.stream_delta(_stream_of(spark, X.stage(spark, d), 2, "k"), t, fresh_path(spark, "checkpoint"), "changed")
    return t.read().select(COLS.split(", "))


def _deliveries(rows, order: str, n: int = 3):
    """rows in n deliveries of this order: written once, and read by delivery."""
    path = fresh_path(rows.sparkSession, "deliveries")
    rows.repartitionByRange(n, order).withColumn("_delivery", F.spark_partition_id()).write.partitionBy("_delivery").parquet(path)
    back = rows.sparkSession.read.parquet(path)
    return [back.where(F.col("_delivery") == i).select(rows.columns) for i in range(n)]


@query("S03_late_rows", X.with_(X.ORD) + "SELECT k, changed FROM ord WHERE changed > '19981231000000'")
def late_rows(spark, d):
    """A stream of reads whose windows overlap by the safety: rows that came late into the overlap are not lost, and those read twice count once."""
    import datetime as dt

    from ..operators import delta

    o = X.orders(spark, d).select("k", "changed")
    first = delta.bounds("NUMTS", "19990101000000", 86400, dt.datetime(2000, 1, 1))
    second = delta.bounds("NUMTS", first.next_watermark, 86400, dt.datetime(2002, 1, 1))
    late = (F.col("k") % 2 == 1) & (F.col("changed") >= first.next_watermark)  # not there yet at the first read
    reads = [o.where(delta.predicate("NUMTS", first, "changed") & (F.col("changed") < "20000101000000") & ~late), o.where(delta.predicate("NUMTS", second, "changed"))]
    t, path, checkpoint = Target(spark, fresh_path(spark, "target"), K), fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
    t.create(o.limit(0))
    for rows in reads:
        rows.write.mode("append").parquet(path)
        streams.stream_delta(spark.readStream.schema(o.schema).parquet(path), t, checkpoint, "changed")
    return t.read()


def _streamed(spark, rows, order: str, made, heartbeat: dict):
    """What a stream with a watermark gives out of rows delivered in this order, each delivery by a run that goes on from the one before; a heartbeat closes it."""
    out, path, checkpoint = (fresh_path(spark, x) for x in ("out", "stream", "checkpoint"))
    last = rows.agg(F.max(order).alias("m")).select(*[heartbeat[f.name].alias(f.name) if f.name in heartbeat else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    for part in [*_deliveries(rows, order), last]:
        part.write.mode("append").parquet(path)
        stream = made(spark.readStream.schema(rows.schema).parquet(path))
        streams.append_available(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


@query("S05_stream_first_apply", X.with_(X.LAT) + ", " + FIRST + " SELECT k, strftime(_commit_ts, '%Y%m%d%H%M%S') AS committed, CAST(s AS DOUBLE) AS latency_seconds, _op FROM h")
def stream_first_apply(spark, d):
    # as they are applied, so that rows delivered again come up to 90 seconds after their commit
    later = F.col("m") + F.expr("interval 1 hour")
    rows = _streamed(spark, X.latency_log(spark, d), "_applied_at", lambda log: streams.stream_first_apply(log, K, "2 minutes"), {"_commit_ts": later, "_applied_at": later})
    return rows.select("k", F.date_format("_commit_ts", "yyyyMMddHHmmss").alias("committed"), F.col("latency_seconds").cast("double").alias("latency_seconds"), "_op")


@query("S10_windowed_throughput", X.with_(X.LAT) + "SELECT strftime(time_bucket(INTERVAL 2 SECOND, _applied_at), '%Y%m%d%H%M%S') AS start, _op, count(*) AS n FROM g GROUP BY 1, 2")
def s_windowed(spark, d):
    # in the order of commits, so that rows come up to 90 seconds late for the window of their apply
    rows = _streamed(spark, X.latency_log(spark, d), "_commit_ts", lambda log: streams.stream_windows(log, "2 seconds", "2 minutes"), {"_applied_at": F.col("m") + F.expr("interval 1 hour")})
    return rows.select(F.date_format("start", "yyyyMMddHHmmss").alias("start"), "_op", "n")


@query("S06_stream_to_sink", X.with_(X.L) + "SELECT k, _seq, _op FROM l")
def stream_to_sink(spark, d):
    out = fresh_path(spark, "sink")
    streams.stream_log_to_sink(_stream_of(spark, X.cdc_log(spark, d), 2, "_seq"), f'PARQUET:"{out}"', fresh_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("k", "_seq", "_op")


@query("S09_stream_packages", "WITH p AS (SELECT p_partkey AS k, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part), v AS (SELECT k, (k * 7 + j * 9) % 24 AS b, CAST(price + j AS DECIMAL(10,2)) AS price, (k + j) % 5 = 0 AS gone FROM p, range(3) r(j)) SELECT k, arg_max(price, b) AS price FROM v GROUP BY k HAVING NOT arg_max(gone, b)")
def stream_packages(spark, d):
    """Every key in three of 24 packages, which come in the order of a hash of their numbers."""
    from ..operators import packages

    p = X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    t = Target(spark, fresh_path(spark, "target"), K)
    t.create(p.where("k % 3 = 0"))
    j = p.select("k", "price", F.explode(F.array(*map(F.lit, range(3)))).alias("j"))
    cell = F.concat_ws(",", F.col("k").cast("string"), (F.col("price") + F.col("j")).cast("decimal(10,2)").cast("string"), F.when((F.col("k") + F.col("j")) % 5 == 0, "D").otherwise("U"))
    b = j.groupBy(((F.col("k") * 7 + F.col("j") * 9) % 24).alias("b")).agg(F.concat_ws("\n", F.collect_list(cell)).alias("body"))
    fields = F.array(*[F.struct(F.lit(x).alias("Name")) for x in ("K", "PRICE", "OPER")])
    content = F.struct(F.lit("Table").alias("Kind"), fields.alias("Fields"))
    envelope = F.struct(F.lit("csv").alias("Encoding"), F.struct(F.col("b").alias("message.batchIndex"), F.lit(False).alias("message.lastBatch"), content.alias("Content")).alias("Attributes"), F.col("body").alias("Body"))
    path = fresh_path(spark, "stream")
    b.repartition(9, F.xxhash64("b")).select(F.to_json(envelope).alias("payload")).write.parquet(path)
    raw = spark.readStream.schema("payload string").option("maxFilesPerTrigger", 3).parquet(path)

    def prepare(rows):
        last = cdc.coalesce_log(packages.decode(rows, ["k", "price", "oper"]).withColumn("_place", F.struct("batch_index", "row_no")), K, "_place")
        return last.select(F.col("k").cast("long").alias("k"), F.col("price").cast("decimal(10,2)").alias("price"), F.when(F.col("oper") == "D", "D").otherwise("U").alias("_op"))

    streams.stream_packages(raw, t, fresh_path(spark, "bronze"), fresh_path(spark, "checkpoint"), prepare)
    return t.read()
