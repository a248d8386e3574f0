"""Schema drift, keyed fingerprints, cell diffs and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import anti, same_keys


def field_table(schema: T.StructType) -> list[tuple]:
    """(name, datatype) of each column, lower-case names."""
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def schema_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """name, change (added, removed, retyped), blocked from two field tables (name and further columns of the type)."""
    rest = [c for c in source.columns if c != "name"]
    low = lambda df, mark: df.select(F.lower("name").alias("name"), F.struct(*rest).alias(mark))
    both = low(source, "_s").join(low(target, "_t"), "name", "full_outer")
    change = F.when(F.col("_t").isNull(), "added").when(F.col("_s").isNull(), "removed").when(~F.col("_s").eqNullSafe(F.col("_t")), "retyped")
    return both.select("name", change.alias("change")).where("change is not null").withColumn("blocked", F.col("change") != "added")


def evolve(target: DataFrame, source_schema: T.StructType, drift: DataFrame) -> DataFrame:
    """target with new columns as null; unchanged as a whole when anything blocks it. A catalog is small."""
    rows = drift.collect()
    if any(r.blocked for r in rows):
        return target
    kinds = {f.name.lower(): f.dataType for f in source_schema.fields}
    for name in sorted(r.name for r in rows):
        target = target.withColumn(name, F.lit(None).cast(kinds[name]))
    return target


def cell_text(column: str, kind: T.DataType) -> Column | None:
    """Canonical text of a cell: hex for binary, trailing blanks of text trimmed, null as ''; floats have none."""
    c = F.col(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return None
    text = F.hex(c) if isinstance(kind, T.BinaryType) else F.rtrim(c) if isinstance(kind, T.StringType) else c.cast("string")
    return F.coalesce(text, F.lit(""))


def row_fingerprint(df: DataFrame, columns: list[str] | None = None, hashed: bool = True) -> Column:
    """All comparable cells joined by a bar, as md5 if asked for."""
    cells = [cell_text(c, df.schema[c].dataType) for c in columns or df.columns]
    joined = F.concat_ws("|", *[c for c in cells if c is not None])
    return F.md5(joined) if hashed else joined


def row_key_text(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> Column:
    """Key parts with bars inside escaped, each followed by a bar; without keys the fingerprint."""
    if not keys:
        return row_fingerprint(df, columns)
    parts = [F.concat(F.replace(F.replace(cell_text(k, df.schema[k].dataType), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")), F.lit("|")) for k in keys]
    return F.concat(*parts)


def fingerprints(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """k, fp, n: how often each key and fingerprint occur together."""
    rows = df.select(row_key_text(df, keys, columns).alias("k"), row_fingerprint(df, columns).alias("fp"))
    return rows.groupBy("k", "fp").agg(F.count("*").alias("n"))


def multiset_difference(source: DataFrame, replica: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """k, fp, n_source, n_replica where the two differ: both directions from one full outer join."""
    a = fingerprints(source, keys, columns).withColumnRenamed("n", "n_source")
    b = fingerprints(replica, keys, columns).withColumnRenamed("n", "n_replica")
    both = a.join(b, ["k", "fp"], "full_outer").na.fill(0, ["n_source", "n_replica"])
    return both.where("n_source <> n_replica")


def validate_full(source: DataFrame, replica: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """source_rows, replica_rows, mismatched, missing, extra, status; nothing compared with something is a failure."""
    d = multiset_difference(source, replica, keys, columns)
    by_key = d.groupBy("k").agg(F.sum(F.greatest(F.lit(0), F.col("n_source") - F.col("n_replica"))).alias("a"), F.sum(F.greatest(F.lit(0), F.col("n_replica") - F.col("n_source"))).alias("b"))
    out = by_key.agg(
        F.coalesce(F.sum(F.least("a", "b")), F.lit(0)).alias("mismatched"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col("a") - F.col("b"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col("b") - F.col("a"))), F.lit(0)).alias("extra"),
    )
    n, m = source.agg(F.count("*").alias("source_rows")), replica.agg(F.count("*").alias("replica_rows"))
    out = n.join(F.broadcast(m)).join(F.broadcast(out))  # one row each
    bad = (F.col("mismatched") + F.col("missing") + F.col("extra") > 0) | ((F.col("source_rows") == 0) & (F.col("replica_rows") > 0))
    return out.withColumn("status", F.when(bad, "FAIL").otherwise("PASS"))


def ordered_read(df: DataFrame, columns: list[str], n: int | None = None) -> DataFrame:
    """The compared columns in their own order, nulls first; the first n of them in sample mode."""
    rows = df.select(columns).orderBy(*[F.asc_nulls_first(c) for c in columns])
    return rows if n is None else rows.limit(n)


def validate_sample(source: DataFrame, replica: DataFrame, keys: list[str], columns: list[str], n: int) -> DataFrame:
    """validate_full of the source rows with the n least key hashes, and the replica's rows of these keys."""
    picked = source.orderBy(F.md5(row_key_text(source, keys)), *keys).limit(n)
    return validate_full(picked, replica.join(picked.select(keys).distinct(), keys, "left_semi"), keys, columns)


def cell_diff(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, diff (added, removed, changed), column_name, value_a, value_b: one row for each cell that differs."""
    left, right = a.withColumn("_in", F.lit(True)).alias("a"), b.withColumn("_in", F.lit(True)).alias("b")
    both = left.join(right, same_keys(keys), "full_outer")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"a.{c}").cast("string").alias("value_a"), F.col(f"b.{c}").cast("string").alias("value_b")) for c in columns])
    kind = F.when(F.col("a._in").isNull(), "added").when(F.col("b._in").isNull(), "removed").otherwise("changed")
    rows = both.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], kind.alias("diff"), F.explode(cells).alias("x")).select(*keys, "diff", "x.*")
    return rows.where((F.col("diff") != "changed") | ~F.col("value_a").eqNullSafe(F.col("value_b")))


def audit_reconcile(truth: DataFrame, audit: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """lost (truth without target), phantom (target in neither truth nor audit), stale (payload differs), audit_share."""
    lost = anti(truth, target, keys).agg(F.count("*").alias("lost"))
    phantom = anti(target, truth.select(keys).unionByName(audit.select(keys)), keys).agg(F.count("*").alias("phantom"))
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])
    stale = truth.alias("a").join(target.alias("b"), same_keys(keys)).agg(F.count_if(~same).alias("stale"))
    marked = audit.select(keys).distinct().alias("a").join(target.select(*keys, F.lit(1).alias("_hit")).distinct().alias("b"), same_keys(keys), "left")
    share = marked.agg(F.avg(F.col("b._hit").isNotNull().cast("double")).alias("audit_share"))
    return lost.join(F.broadcast(phantom)).join(F.broadcast(stale)).join(F.broadcast(share))  # one row each
