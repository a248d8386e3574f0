"""The merge algebra: (target, changes, keys) to the new target, null-safe on keys, and its counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_keys(keys: list[str], a: str = "a", b: str = "b") -> Column:
    """A null key matches itself; still an equality join for Spark."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def anti(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.alias("a").join(b.select(keys).alias("b"), same_keys(keys), "left_anti")


def semi(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.alias("a").join(b.select(keys).alias("b"), same_keys(keys), "left_semi")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and n of every key that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def refuse_duplicates(df: DataFrame, keys: list[str]) -> None:
    worst = duplicate_keys(df, keys).orderBy(F.desc("n")).first()
    if worst:
        raise ValueError(f"key {tuple(worst[k] for k in keys)} occurs {worst.n} times")


def refuse_other_columns(subset: list[str], target: list[str]) -> None:
    """A registered subset must name exactly the target's columns, whatever their case and order."""
    a, b = {c.lower() for c in subset}, {c.lower() for c in target}
    if a != b:
        raise ValueError(f"registered without a column of the target: {sorted(b - a)}; registered but not in the target: {sorted(a - b)}")


def apply_insert(target: DataFrame, changes: DataFrame, op_col: str | None = None) -> DataFrame:
    """Append; of changes with an operation only inserts and updates."""
    if op_col:
        changes = changes.where(F.upper(op_col).isin("I", "U")).drop(op_col)
    return target.unionByName(changes.select([c for c in target.columns if c in changes.columns]), allowMissingColumns=True)


def apply_upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Update matched rows, insert the rest. Keys are never updated, and columns that changes lack keep their value."""
    if set(target.columns) <= set(changes.columns):
        if set(target.columns) == set(keys):
            return target.unionByName(anti(changes.select(target.columns), target, keys))
        return anti(target, changes, keys).unionByName(changes.select(target.columns))
    both = target.withColumn("_t", F.lit(True)).alias("a").join(changes.withColumn("_c", F.lit(True)).alias("b"), same_keys(keys), "full_outer")
    pick = lambda c: F.when(F.col("b._c"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return both.select([(pick(c) if c in changes.columns else F.col(f"a.{c}")).alias(c) for c in target.columns])


def apply_merge(target: DataFrame, changes: DataFrame, keys: list[str], op_col: str | None) -> DataFrame:
    """D deletes, I and U upsert, in either case; a miss deletes nothing or inserts; other operations are ignored."""
    if not op_col:
        return apply_upsert(target, changes, keys)
    op = F.upper(F.col(op_col))
    known = changes.where(op.isin("I", "U", "D"))
    return anti(target, known, keys).unionByName(known.where(op.isin("I", "U")).select(target.columns))


def snapshot_merge(target: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """The snapshot's rows, with what only the target has of them; keys that the snapshot lacks are gone."""
    extra = [c for c in target.columns if c not in snapshot.columns]
    if not extra:
        return snapshot.select(target.columns)
    rows = snapshot.alias("a").join(target.select(*keys, *extra).alias("b"), same_keys(keys), "left")
    return rows.select([F.col(f"b.{c}" if c in extra else f"a.{c}").alias(c) for c in target.columns])


def side_counts(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """rows_ins, rows_upd, rows_del of a snapshot against a target, in one pass over both."""
    t, s = target.select(*keys, F.lit(1).alias("_t")), stage.select(*keys, F.lit(1).alias("_s"))
    both = t.alias("a").join(s.alias("b"), same_keys(keys), "full_outer")
    return both.agg(
        F.count_if(F.col("_t").isNull()).alias("rows_ins"),
        F.count_if(F.col("_t").isNotNull() & F.col("_s").isNotNull()).alias("rows_upd"),
        F.count_if(F.col("_s").isNull()).alias("rows_del"),
    )


def verdicts(target: DataFrame, changes: DataFrame, keys: list[str], op: str = "_op") -> DataFrame:
    """changes with U where the key is in the target, else I; a marker decides, so null keys work."""
    marked = target.select(keys).distinct().withColumn("_hit", F.lit(True))
    rows = changes.alias("a").join(marked.alias("b"), same_keys(keys), "left")
    return rows.select("a.*", F.when(F.col("b._hit"), "U").otherwise("I").alias(op))


def reload_replace(target: DataFrame, stage: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new target, log rows): the target becomes the stage; D for keys that vanish, I for every staged row."""
    gone = anti(target, stage, keys).select(*[F.col(c) if c in keys else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns], F.lit("D").alias("_op"))
    return stage.select(target.columns), gone.unionByName(stage.select(*target.columns, F.lit("I").alias("_op")))


def refuse_empty_reload(target: DataFrame, stage: DataFrame | None, allowed: bool = False) -> None:
    """An empty stage must not empty a target unless that is allowed; no stage never does."""
    if stage is None:
        raise ValueError("a reload without a stage replaces nothing")
    if not allowed and stage.isEmpty() and not target.isEmpty():
        raise ValueError("the stage is empty and the target is not")


def common_columns(stage: DataFrame, target: DataFrame) -> list[str]:
    """Columns of both, in the target's order, compared without case."""
    have = {c.lower() for c in stage.columns}
    return [c for c in target.columns if c.lower() in have]
