"""Run, target and health views, latency and throughput. ``now`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.ordered import lagged, quantiles
from ..sources.scratch import saved


def run_stats(runs: DataFrame) -> DataFrame:
    """runs with started_at, rows_applied, rows_per_sec (null without a duration) and is_success."""
    applied = F.col("rows_ins") + F.col("rows_upd") + F.col("rows_del")
    rate = F.when(F.col("duration_ms") > 0, applied * 1000.0 / F.col("duration_ms"))
    started = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) - F.col("duration_ms"))
    return runs.withColumns({"started_at": started, "rows_applied": applied, "rows_per_sec": rate, "is_success": F.col("status") == "SUCCESS"})


def latest_run(runs: DataFrame) -> DataFrame:
    """The run of each target with the largest run_id, by an aggregate."""
    rest = [c for c in runs.columns if c != "target"]
    return runs.groupBy("target").agg(F.max_by(F.struct(*rest), "run_id").alias("_r")).select("target", "_r.*")


def throughput_per_target(runs: DataFrame, since: Column) -> DataFrame:
    r = run_stats(runs).where(F.col("ts") >= since)
    return r.groupBy("target").agg(F.count("*").alias("runs"), F.sum("rows_applied").alias("rows_applied"), F.round(F.avg("rows_per_sec"), 4).alias("avg_rate"))


def last_per_target(runs: DataFrame) -> DataFrame:
    return runs.groupBy("target").agg(F.max("ts").alias("last_ts"), F.max_by("status", F.struct("ts", "run_id")).alias("last_status"))


def success_rate(runs: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "SUCCESS")
    return runs.groupBy("method").agg(F.count("*").alias("runs"), F.round(100.0 * ok / F.count("*"), 4).alias("success_percent"))


def deletes_reconciled(runs: DataFrame) -> DataFrame:
    return runs.groupBy("target").agg(F.sum("rows_del").alias("rows_del")).where("rows_del > 0")


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.where("status <> 'SUCCESS'").orderBy(F.desc("ts"), F.desc("run_id"))


def op_counters(runs: DataFrame) -> DataFrame:
    return runs.groupBy("target").agg(*[F.sum(c).alias(c) for c in ("rows_ins", "rows_upd", "rows_del")])


def targets(registry: DataFrame, runs: DataFrame, cdc: DataFrame, now: Column, lag_limit: int = 86400) -> DataFrame:
    """One row per target with its last run, lag, lease, spill and whether it is healthy.

    registry: target, method, status, last_run_ts, fail_count, parked_until, lease_ts, max_cycle_secs,
    pending_spill, last_warning. Healthy is: has run, lag below the limit, no failures, not blocked, not
    parked, no stale lease and no broken change capture. Registry and cdc have a row per target.
    """
    last = latest_run(runs).select("target", "run_id", F.col("rows_ins").alias("last_ins"), F.col("rows_upd").alias("last_upd"), F.col("rows_del").alias("last_del"))
    seconds = lambda c: F.unix_timestamp(now) - F.unix_timestamp(c)
    rows = registry.join(last, "target", "left").join(cdc.select("target", F.col("status").alias("cdc_status")), "target", "left")
    rows = rows.withColumns({"lag_seconds": seconds("last_run_ts"), "is_blocked": F.col("status") == "BLOCKED", "is_parked": F.coalesce(F.col("parked_until") > now, F.lit(False)), "lease_age": seconds("lease_ts")})
    rows = rows.withColumn("is_stale", F.coalesce(F.col("lease_age") > F.col("max_cycle_secs"), F.lit(False)))
    healthy = F.col("lag_seconds").isNotNull() & (F.col("lag_seconds") <= lag_limit) & (F.col("fail_count") == 0) & ~F.col("is_blocked") & ~F.col("is_parked") & ~F.col("is_stale") & (F.coalesce("cdc_status", F.lit("OK")) == "OK")
    return rows.withColumn("is_healthy", healthy)


def health(view: DataFrame) -> DataFrame:
    """One row over all targets."""
    return view.agg(
        F.count("*").alias("targets"), F.count_if("is_healthy").alias("healthy"), F.count_if("is_blocked").alias("blocked"), F.count_if("is_parked").alias("parked"),
        F.count_if(F.col("fail_count") > 0).alias("failing"), F.max("lag_seconds").alias("worst_lag"), F.count_if(F.col("lag_seconds").isNull()).alias("never_run"),
        F.count_if("is_stale").alias("stale_leases"), F.sum("pending_spill").alias("pending_spill"), F.count_if(F.col("last_warning").isNotNull()).alias("warned"),
    )


def ranked(view: DataFrame) -> DataFrame:
    """Worst first: blocked, parked, never run, failing, unhealthy, ok; then lag, then name."""
    severity = F.when(F.col("is_blocked"), 0).when(F.col("is_parked"), 1).when(F.col("lag_seconds").isNull(), 2).when(F.col("fail_count") > 0, 3).when(~F.col("is_healthy"), 4).otherwise(5)
    return view.withColumn("severity", severity).orderBy("severity", F.desc_nulls_last("lag_seconds"), "target")


METRICS = ["lag_seconds", "fail_count", "last_ins", "last_upd", "last_del", "pending_spill"]


def metric_rows(view: DataFrame) -> DataFrame:
    """metric, target, value in long form; no lag row for a target that never ran, other missing values 0."""
    stack = ", ".join(f"'{m}', cast({m if m == 'lag_seconds' else f'coalesce({m}, 0)'} as double)" for m in METRICS)
    return view.selectExpr("target", f"stack({len(METRICS)}, {stack}) as (metric, value)").where("value is not null").select("metric", "target", "value")


def first_apply(log: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _commit_ts, _op, latency_seconds: one sample per change, at its first apply; rows without a commit are left out."""
    rows = log.where(F.col("_commit_ts").isNotNull()).groupBy(*keys, "_commit_ts").agg(F.min("_applied_at").alias("_applied_at"), F.min_by("_op", F.struct("_applied_at", "_seq")).alias("_op"))
    return rows.withColumn("latency_seconds", (F.unix_millis("_applied_at") - F.unix_millis("_commit_ts")) / 1000.0)


def latency_stats(log: DataFrame, keys: list[str], since: Column | None = None) -> DataFrame:
    """samples, mean, discrete p50, p95, p99, min, max, and samples by operation; no samples give nulls, not zeros.

    The percentiles are exact and found in range bins of the distinct latencies: no aggregate holds them all.
    """
    rows = first_apply(log, keys)
    rows = rows.where(F.col("_commit_ts") >= since) if since is not None else rows
    counts = saved(rows.groupBy("latency_seconds", "_op").agg(F.count("*").alias("n")), "latencies")
    x, n = F.col("latency_seconds"), F.col("n")
    stats = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("samples"), F.round(F.sum(x * n).cast("double") / F.sum("n"), 6).alias("mean"), F.min(x).alias("least"), F.max(x).alias("most"),
        *[F.coalesce(F.sum(F.when(F.col("_op") == o, n)), F.lit(0)).alias(f"n_{o.lower()}") for o in "IUD"],
    )
    ranks = quantiles(counts.groupBy("latency_seconds").agg(F.sum("n").alias("n")).withColumn("_all_", F.lit(0)), ["_all_"], "latency_seconds", "n", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    both = stats.join(F.broadcast(ranks.drop("_all_")), F.lit(True), "left")  # one row on either side
    return both.select("samples", "mean", "p50", "p95", "p99", "least", "most", "n_i", "n_u", "n_d")


def meets_target(stats: DataFrame, p95: float, p99: float) -> DataFrame:
    """stats with meets; no data is not a pass."""
    return stats.withColumn("meets", (F.col("samples") > 0) & F.coalesce((F.col("p95") <= p95) & (F.col("p99") <= p99), F.lit(False)))


def lag_by_operation(log: DataFrame) -> DataFrame:
    """_op, least, median, most of the lags; the median lies between the two middle ones."""
    rows = log.where(F.col("_commit_ts").isNotNull()).withColumn("lag", (F.unix_millis("_applied_at") - F.unix_millis("_commit_ts")) / 1000.0)
    counts = saved(rows.groupBy("_op", "lag").agg(F.count("*").alias("n")), "lags")
    ends = counts.groupBy("_op").agg(F.min("lag").alias("least"), F.max("lag").alias("most"))
    middle = quantiles(counts, ["_op"], "lag", "n", {"median": 0.5}, interpolated=True).withColumnRenamed("_op", "_of")
    return ends.join(middle, ends["_op"].eqNullSafe(middle["_of"]), "left").select("_op", "least", "median", "most")


def throughput(samples: DataFrame) -> DataFrame:
    """target, ts, ins_rate, upd_rate, del_rate from counters (rows, upd, del) sampled over time; the first sample has none."""
    rows = lagged(samples, ["target"], ["ts"], ["ts", "rows", "upd", "del"])
    step = lambda c: F.col(c) - F.col(f"_before_{c}")
    rows = rows.withColumns({"dt": (F.unix_millis("ts") - F.unix_millis("_before_ts")) / 1000.0, "_rows": step("rows"), "_upd": step("upd"), "_del": step("del")}).where("dt >= 0.5")
    rate = lambda x: F.round(x / F.col("dt"), 6)
    return rows.select("target", "ts", rate(F.greatest("_rows", F.lit(0))).alias("ins_rate"), rate(F.col("_upd")).alias("upd_rate"), rate(F.greatest(F.col("_del"), -F.col("_rows"))).alias("del_rate"))


def windowed_throughput(log: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """start, _op, n of changes applied in tumbling or sliding windows."""
    w = F.window("_applied_at", length, slide) if slide else F.window("_applied_at", length)
    return log.groupBy(w.alias("w"), "_op").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "_op", "n")
