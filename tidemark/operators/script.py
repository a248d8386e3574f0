"""The SQL surface: scripts, capped results, tidy column names, profiles and samples."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.ordered import numbered, quantiles
from ..sources.portions import value_counts
from ..sources.scratch import saved


def statements(script: str) -> list[str]:
    """The statements between semicolons outside quotes and comments."""
    parts = re.findall(r"(?:'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|[^;'\"`])+", script, re.S)
    return [p.strip() for p in parts if re.sub(r"--[^\n]*|/\*.*?\*/", "", p, flags=re.S).strip()]


def run_script(spark: SparkSession, script: str) -> DataFrame:
    """Every statement in turn; the last one's result."""
    out = spark.createDataFrame([], "result string")
    for s in statements(script):
        out = spark.sql(s)
    return out


def capped(df: DataFrame, n: int, want_total: bool = False) -> tuple[DataFrame, dict]:
    """(at most n rows, {truncated, row_count}): n + 1 stands for more unless the exact total is asked for."""
    found = df.limit(n + 1).count()
    return df.limit(n), {"truncated": found > n, "row_count": df.count() if want_total and found > n else found}


def tidy_names(names: list[str]) -> list[str]:
    """Upper case, other characters as _, a letter first, at most 30, _2 and so on for repeats."""
    out: list[str] = []
    for name in names:
        base = re.sub(r"[^A-Z0-9_]", "_", name.upper()).strip("_")
        base = (base if base[:1].isalpha() else f"C_{base}")[:30]
        made, i = base, 1
        while made in out:
            i += 1
            made = f"{base[: 30 - len(f'_{i}')]}_{i}"
        out.append(made)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*tidy_names(df.columns))


def preview(table: DataFrame, n: int, transform=None, order: list[str] | None = None) -> DataFrame:
    """The first rows through the target's transform, if it has one."""
    rows = transform(table) if transform else table
    return (rows.orderBy(*order) if order else rows).limit(n)


def summarize(df: DataFrame) -> DataFrame:
    """column_name, column_type, least, most, n_distinct, mean, deviation, q25, q50, q75, n_rows, null_percent of every column.

    Least and most are in the type's own order.  Distinct counts and the exact quartiles of numbers (discrete
    ones) follow from the counts of each column's values.  An empty table has counts of 0 and nulls.
    """
    number = lambda kind: kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    aggs, lines = [F.count("*").alias("_n")], []
    for i, (c, kind) in enumerate(df.dtypes):
        x = F.col(c).cast("double") if number(kind) else F.lit(None).cast("double")
        aggs += [F.min(c).cast("string").alias(f"a{i}"), F.max(c).cast("string").alias(f"b{i}"), F.round(F.avg(x), 6).alias(f"m{i}"), F.round(F.stddev_samp(x), 6).alias(f"s{i}"), F.round(100.0 * F.count_if(F.col(c).isNull()) / F.count("*"), 6).alias(f"z{i}")]
        lines.append(f"'{c}', '{kind}', a{i}, b{i}, m{i}, s{i}, _n, z{i}")
    plain = df.agg(*aggs).selectExpr(f"stack({len(lines)}, {', '.join(lines)}) as (column_name, column_type, least, most, mean, deviation, n_rows, null_percent)")
    counts = saved(value_counts(df, df.columns), "values")
    distinct = counts.groupBy("column_name").agg(F.count("text").alias("n_distinct"))
    numbers = [c for c, kind in df.dtypes if number(kind)]
    quarters = counts.where(F.col("column_name").isin(numbers)).withColumn("x", F.expr("try_cast(text as double)"))
    quarters = quantiles(quarters, ["column_name"], "x", "n", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    out = plain.join(distinct, "column_name", "left").join(quarters, "column_name", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    return out.select("column_name", "column_type", "least", "most", "n_distinct", "mean", "deviation", "q25", "q50", "q75", "n_rows", "null_percent")


def stride_sample(df: DataFrame, order: list[str], p: int) -> DataFrame:
    """Every p-th row of a total order; a prime p doesn't fall in step with generated cycles."""
    return numbered(df, order, "_rn").where(F.col("_rn") % p == 0).drop("_rn")
