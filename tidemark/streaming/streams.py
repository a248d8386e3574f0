"""Structured Streaming forms of the appliers: what a stream of files leaves is what one batch would."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cdc import coalesce_log
from ..operators.merge import apply_merge
from ..operators.metrics import windowed_throughput
from ..operators.packages import refuse_stale, with_number
from ..sources.sinks import publish
from ..sources.store import Target


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that is there now, in micro-batches; a later call goes on from the checkpoint."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_cdc(log: DataFrame, target: Target, checkpoint: str, seq: str = "_seq", op: str = "_op") -> None:
    """Each micro-batch coalesced and merged under its batch id.

    The last sequence of each key stays in the target's column ``seq``, so a log whose files arrive out of
    order never overwrites newer rows with older ones. A deleted key leaves a row with op D, which read_live drops.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        net = coalesce_log(rows, target.keys, seq)

        def newest(old: DataFrame, changes: DataFrame) -> DataFrame:
            return coalesce_log(old.unionByName(changes.select(old.columns)), target.keys, seq)

        target.commit(batch_id + 1, net, F.lit(None).cast("timestamp"), F.current_timestamp(), merge=newest, log=False)

    run_available(log, each, checkpoint)


def read_live(target: Target, seq: str = "_seq", op: str = "_op") -> DataFrame:
    return target.read().where(F.upper(op) != "D").drop(seq, op)


def stream_delta(source: DataFrame, target: Target, checkpoint: str, order: str) -> None:
    """Rows of a growing source upserted by key; of a key's rows in one batch the last by ``order`` counts."""

    def each(rows: DataFrame, batch_id: int) -> None:
        target.commit(batch_id + 1, coalesce_log(rows, target.keys, order), F.lit(None).cast("timestamp"), F.current_timestamp(), log=False)

    run_available(source, each, checkpoint)


def stream_packages(raw: DataFrame, target: Target, bronze: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], op: str = "_op", payload: str = "payload") -> None:
    """Numbered packages merged in the order of their numbers, however they are delivered.

    The target's watermark is the position: the number of the last package merged.  A micro-batch keeps its packages raw
    in ``bronze``, merges those that follow the position without a gap, whichever micro-batch brought them, and leaves
    those beyond a gap for later.  A package at or below the position fails the stream, as it would bring back old rows.
    prepare() turns packages into one typed change a key, with an operation.
    """
    spark = raw.sparkSession

    def each(rows: DataFrame, batch_id: int) -> None:
        state = target.state()
        if state.run_id > batch_id:  # merged before the stream died
            return
        position = int(state.watermark) if state.watermark is not None else -1
        rows = rows.select(F.col(payload).alias("payload"))
        refuse_stale(rows, position)
        rows = with_number(rows)
        rows.sortWithinPartitions("_number").write.mode("overwrite").parquet(f"{bronze}/run={batch_id}")
        kept = spark.read.schema("payload string, _number long").parquet(f"{bronze}/run=*")
        waiting = kept.where(F.col("_number") > position)
        numbers = waiting.select("_number").distinct()  # a row a package that waits
        place = F.row_number().over(Window.orderBy("_number"))
        upto = numbers.withColumn("_place", place).where(F.col("_number") - position == F.col("_place")).agg(F.max("_number")).first()[0]
        changes = prepare(waiting.where(F.col("_number") <= (position if upto is None else upto)).select("payload"))
        target.commit(batch_id + 1, changes, F.lit(None).cast("timestamp"), F.current_timestamp(), None if upto is None else str(upto), merge=lambda t, c: apply_merge(t, c, target.keys, op), log=False)

    run_available(raw, each, checkpoint)


def stream_first_apply(log: DataFrame, keys: list[str], safety: str) -> DataFrame:
    """keys, _commit_ts, _applied_at, _op, latency_seconds: one row per change, at its first apply.

    Rows may come again for as long as ``safety``, in any order; a change is given out once a later commit shows that this
    is over, so a quiet source needs a heartbeat.  Rows without a commit, and such as come later still, are left out.
    """
    rows = log.where(F.col("_commit_ts").isNotNull()).withWatermark("_commit_ts", safety).groupBy(*keys, "_commit_ts")
    rows = rows.agg(F.min("_applied_at").alias("_applied_at"), F.min_by("_op", F.struct("_applied_at", "_seq")).alias("_op"))
    return rows.withColumn("latency_seconds", (F.unix_millis("_applied_at") - F.unix_millis("_commit_ts")) / 1000.0)


def stream_windows(log: DataFrame, length: str, safety: str) -> DataFrame:
    """start, _op, n of changes applied in windows; a window is given out once ``safety`` has passed since its end, and rows that come later are left out."""
    return windowed_throughput(log.where(F.col("_applied_at").isNotNull()).withWatermark("_applied_at", safety), length)


def append_available(rows: DataFrame, path: str, checkpoint: str) -> None:
    """What a stream with a watermark has to give out by now, as files."""
    rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start().awaitTermination()


def stream_log_to_sink(log: DataFrame, spec: str, checkpoint: str) -> None:
    """A subscription: each has a checkpoint of its own."""
    run_available(log, lambda rows, _: publish(rows, spec), checkpoint)
