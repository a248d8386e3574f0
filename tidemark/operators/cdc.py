"""Change-data capture: a log coalesced to one net operation per key, applied from images or re-read rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import coerce
from .merge import anti, apply_merge, apply_upsert, semi

RESERVED = "__sync_"


def coalesce_log(log: DataFrame, keys: list[str], seq: str = "_seq", after=None) -> DataFrame:
    """The last row of each key by sequence: an aggregate with map-side combine, so one hot key stays small."""
    if after is not None:
        log = log.where(F.col(seq) > F.lit(after))
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def net_keys(log: DataFrame, keys: list[str], seq: str = "_seq", op: str = "_op") -> DataFrame:
    """Keys to read again: net inserts and updates."""
    return coalesce_log(log, keys, seq).where(F.upper(op).isin("I", "U")).select(keys)


def typed_log(log: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """The log's text columns in the target's types, cast once, so that joins compare plain columns."""
    kinds = dict(target.dtypes)
    have = dict(log.dtypes)
    return log.select([coerce(c, have[c], kinds[c]).alias(c) if c in columns and have[c] == "string" else F.col(c) for c in log.columns])


def refuse(target: DataFrame, log: DataFrame, images: DataFrame | None, mode: str) -> None:
    """Reserved names, and images that lack a target column."""
    bad = [c for c in target.columns if c.startswith(RESERVED)]
    if bad:
        raise ValueError(f"reserved column names: {', '.join(bad)}")
    source = images if mode == "keys" else log if mode == "image" else None
    lacking = [c for c in target.columns if source is not None and c not in source.columns]
    if lacking:
        raise ValueError(f"the images lack {', '.join(lacking)}")


def cdc_apply(target: DataFrame, log: DataFrame, keys: list[str], mode: str, images: DataFrame | None = None, seq: str = "_seq", op: str = "_op", after=None) -> DataFrame:
    """The new target. mode: delete (net deletes only), image (values from the log) or keys (values from images).

    In keys mode a net insert or update without an image has vanished and is a delete; a key whose net
    operation is delete is not revived by an old image.
    """
    refuse(target, log, images, mode)
    net = typed_log(coalesce_log(log, keys, seq, after), target, target.columns if mode == "image" else keys)
    if mode == "delete":
        return anti(target, net.where(F.upper(op) == "D"), keys)
    if mode == "image":
        return apply_merge(target, net.select(*target.columns, op), keys, op)
    if mode != "keys":
        raise ValueError(f"unknown mode {mode}")
    live = net.where(F.upper(op).isin("I", "U")).select(keys)
    gone = vanished(net, images, keys, op)
    return apply_upsert(anti(target, net.where(F.upper(op) == "D").select(keys).union(gone), keys), semi(images.select(target.columns), live, keys), keys)


def vanished(net: DataFrame, images: DataFrame, keys: list[str], op: str = "_op") -> DataFrame:
    """Net inserts and updates without an image."""
    return anti(net.where(F.upper(op).isin("I", "U")).select(keys), images, keys)


def effective_deletes(target: DataFrame, net: DataFrame, images: DataFrame | None, keys: list[str], op: str = "_op") -> DataFrame:
    """Keys that really leave the target: net deletes and vanished keys that it holds."""
    gone = net.where(F.upper(op) == "D").select(keys)
    if images is not None:
        gone = gone.unionByName(vanished(net, images, keys, op))
    return semi(target.select(keys), gone, keys)


def cdc_counts(target: DataFrame, net: DataFrame, keys: list[str], images: DataFrame | None = None, op: str = "_op") -> DataFrame:
    """rows_ins, rows_upd, rows_del of a coalesced log against the target before it, in one marked join."""
    rows = net.select(*keys, F.upper(op).alias("_o"))
    if images is not None:
        seen = images.select(keys).distinct().withColumn("_img", F.lit(True))
        rows = rows.join(seen, keys, "left").select(*keys, F.when(F.col("_o").isin("I", "U") & F.col("_img").isNull(), "D").otherwise(F.col("_o")).alias("_o"))
    rows = rows.join(target.select(*keys, F.lit(True).alias("_t")), keys, "left")
    live, here = F.col("_o").isin("I", "U"), F.col("_t").isNotNull()
    return rows.agg(F.count_if(live & ~here).alias("rows_ins"), F.count_if(live & here).alias("rows_upd"), F.count_if((F.col("_o") == "D") & here).alias("rows_del"))


def position(log: DataFrame, before: int | None, seq: str = "_seq") -> int | None:
    """The largest sequence consumed; it never moves back, and an empty batch leaves it."""
    top = log.agg(F.max(seq)).first()[0]
    if top is None:
        return before
    if before is not None and top < before:
        raise ValueError(f"the log went back from {before} to {top}")
    return top


def changedoc_delta(target: DataFrame, source: DataFrame, headers: DataFrame, after, keys: list[str], object_key: str) -> DataFrame:
    """Headers of change documents after (date, time) name objects; their rows are read again and upserted."""
    objects = headers.where(F.struct("udate", "utime") > F.struct(F.lit(after[0]).alias("udate"), F.lit(after[1]).alias("utime"))).select(F.col("objectid").alias(object_key)).distinct()
    return apply_upsert(target, source.join(objects, object_key, "left_semi"), keys)


def insert_only_delta(target: DataFrame, items: DataFrame, headers: DataFrame, after, keys: list[str], number: str) -> DataFrame:
    """New change numbers name item rows; what is delivered again replaces itself."""
    numbers = headers.where(F.struct("udate", "utime") > F.struct(F.lit(after[0]).alias("udate"), F.lit(after[1]).alias("utime"))).select(number).distinct()
    return apply_upsert(target, items.join(numbers, number, "left_semi").dropDuplicates(keys), keys)
