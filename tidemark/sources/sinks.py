"""Publishing a relation or a stretch of a change log to Parquet or a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.changelog import batch

KINDS, MODES = ("PARQUET", "TABLE"), ("FULL", "APPEND")


def parse_sink(spec: str) -> tuple[str, str, str]:
    """KIND:DEST[:MODE]; a destination with colons is quoted. The mode defaults to APPEND."""
    m = re.fullmatch(r'(\w+):(?:"([^"]+)"|([^:"]+))(?::(\w+))?', spec)
    if not m:
        raise ValueError(f"not a sink: {spec}")
    kind, mode = m[1].upper(), (m[4] or "APPEND").upper()
    if kind not in KINDS or mode not in MODES:
        raise ValueError(f"unknown sink {kind} or mode {mode}")
    return kind, m[2] or m[3], mode


def publish_parquet(df: DataFrame, path: str, mode: str = "FULL", partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite" if mode == "FULL" else "append").partitionBy(*(partition_by or [])).parquet(path)


def publish_table(df: DataFrame, name: str, mode: str = "FULL") -> None:
    df.write.mode("overwrite" if mode == "FULL" else "append").saveAsTable(name)


def publish(df: DataFrame, spec: str) -> None:
    kind, dest, mode = parse_sink(spec)
    (publish_parquet if kind == "PARQUET" else publish_table)(df, dest, mode)


def subscription_advance(spark: SparkSession, log: DataFrame, spec: str, offset: int, dedup_keys: list[str] | None = None, strip: bool = False) -> int:
    """Publish offset < _seq <= the highest sequence now, and give the new offset; an empty log publishes nothing.

    The caller stores the offset after this returns, so a crash between publishes again and loses nothing.
    """
    top = log.agg({"_seq": "max"}).first()[0]
    if top is None or top <= offset:
        return offset
    publish(batch(log, offset, top, dedup_keys, strip), spec)
    return top
