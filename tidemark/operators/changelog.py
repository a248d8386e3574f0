"""The per-target change log: append, number, widen, replay, retain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.ordered import numbered
from .merge import verdicts

CONTROL = ["_seq", "_op", "_run_id", "_commit_ts", "_applied_at"]


def log_changes(target: DataFrame, changes: DataFrame, keys: list[str], run_id: int, commit: Column, applied: Column, base: int = 0) -> DataFrame:
    """Log rows of applied changes: U where the key was in the target, else I."""
    rows = verdicts(target, changes, keys).withColumn("_run_id", F.lit(run_id).cast("long")).withColumn("_commit_ts", commit).withColumn("_applied_at", applied)
    return numbered(rows, keys, "_seq", base)


def log_deletes(target: DataFrame, gone: DataFrame, keys: list[str], run_id: int, applied: Column, base: int = 0) -> DataFrame:
    """Log rows of keys that left the target: the keys, and null for all else."""
    rows = gone.select(*[F.col(c) if c in keys else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    rows = rows.withColumn("_op", F.lit("D")).withColumn("_run_id", F.lit(run_id).cast("long")).withColumn("_commit_ts", F.lit(None).cast("timestamp")).withColumn("_applied_at", applied)
    return numbered(rows, keys, "_seq", base)


def widen(log: DataFrame, more: DataFrame) -> DataFrame:
    """Two stretches of a log, the later with columns that the target gained."""
    return log.unionByName(more, allowMissingColumns=True)


def replay(log: DataFrame, keys: list[str]) -> DataFrame:
    """The mirror that a log describes: the last row of each key, without deletes and control columns."""
    from .cdc import coalesce_log

    return coalesce_log(log, keys).where("_op <> 'D'").drop(*CONTROL)


def retain(log: DataFrame, offsets: list[int], older_than: Column | None) -> DataFrame:
    """What stays: rows that a subscriber has yet to read, or that are inside the window; one of both must be given."""
    if not offsets and older_than is None:
        raise ValueError("retention needs a subscriber or a window")
    gone = F.lit(True)
    if offsets:
        gone = gone & (F.col("_seq") <= min(offsets))
    if older_than is not None:
        gone = gone & (F.col("_applied_at") < older_than)
    return log.where(~gone)


def batch(log: DataFrame, offset: int, upto: int, dedup_keys: list[str] | None = None, strip: bool = False) -> DataFrame:
    """What a subscription publishes: offset < _seq <= upto, the last write of each key if asked for."""
    from .cdc import coalesce_log

    rows = log.where((F.col("_seq") > offset) & (F.col("_seq") <= upto))
    if dedup_keys:
        rows = coalesce_log(rows, dedup_keys)
    return strip_control(rows) if strip else rows


def strip_control(rows: DataFrame) -> DataFrame:
    return rows.drop(*CONTROL)
