"""Typed loads: schema from a field catalog, column and row selection, paging, key lookup, JSON and text rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import initial_date

# Dictionary types of the source systems and their Spark types.
DDIC = {
    "INT1": "int", "INT2": "int", "INT4": "int", "INT8": "bigint", "FLTP": "double", "DF16_DEC": "double", "DF34_DEC": "double", "D16R": "double", "D34R": "double",
    "DATS": "date", "TIMS": "string", "RAW": "binary", "LRAW": "binary", "RSTR": "binary",
}


def spark_type(datatype: str, length: int = 0, decimals: int = 0) -> str:
    kind = datatype.upper()
    if kind in ("DEC", "CURR", "QUAN"):
        return f"decimal({min(length or 38, 38)},{decimals})"
    return DDIC.get(kind, "string")


def typed_schema(catalog: list[dict], columns: list[str] | None = None) -> tuple[T.StructType, list[str]]:
    """(schema, keys) of a catalog of {name, datatype, length, decimals, is_key}; an unknown requested column is an error."""
    known = {f["name"].lower(): f for f in catalog}
    keys = [f["name"].lower() for f in catalog if f.get("is_key")]
    wanted = select_columns(list(known), columns, keys)[0] if columns else list(known)
    fields = []
    for name in wanted:
        f = known[name]
        meta = {"ddic": f["datatype"], "length": f.get("length", 0), "decimals": f.get("decimals", 0), "key": bool(f.get("is_key"))}
        made = T.DataType.fromDDL(spark_type(f["datatype"], f.get("length", 0), f.get("decimals", 0)))
        fields.append(T.StructField(name, made, True, meta))
    return T.StructType(fields), keys


def select_columns(have: list[str], wanted: list[str], keys: list[str]) -> tuple[list[str], list[str]]:
    """(columns in catalog order with the keys kept, keys that had to be added); unknown names are an error."""
    low = [c.lower() for c in wanted]
    unknown = [c for c in low if c not in have]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    added = [k for k in keys if k not in low]
    return [c for c in have if c in low or c in keys], added


def ingest_typed_text(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text cells as the target's types by name, in one projection; blank dates are null and a bad cell fails the job."""
    names = {c.lower(): c for c in rows.columns}
    cells = []
    for f in schema.fields:
        cell = F.col(names[f.name.lower()]) if f.name.lower() in names else F.lit(None).cast("string")
        cells.append((initial_date(cell) if isinstance(f.dataType, T.DateType) else cell.cast(f.dataType)).alias(f.name, metadata=f.metadata))
    return rows.select(cells)


def full_load(source: DataFrame, schema: T.StructType, where: Column | None = None, max_rows: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Filter, project and type a source; the caller replaces the target with it, so a re-run changes nothing."""
    rows = source_filter(source, where)
    rows = row_cap(rows, max_rows, order or [rows.columns[0]]) if max_rows is not None else rows
    names = {c.lower(): c for c in source.columns}
    return rows.select([F.col(names[f.name]).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])


def source_filter(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """Caller's and engine's conditions together; Catalyst pushes them into the scan."""
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def row_cap(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def keyset_page(df: DataFrame, keys: list[str], last: list | None, n: int) -> DataFrame:
    """The n rows after a composite key, in key order."""
    if last is not None:
        after = F.lit(False)
        for i, k in enumerate(keys):
            same = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(keys[:i], last)], F.lit(True))
            after = after | (same & (F.col(k) > F.lit(last[i])))
        df = df.where(after)
    return df.orderBy(*keys).limit(n)


def lookup_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose composite key is in wanted; an empty set selects nothing. The side to broadcast is left to its measured size."""
    return df.join(wanted.select(keys).distinct(), keys, "left_semi")


def param_source(spark: SparkSession, text: str, views: dict[str, DataFrame], **params) -> DataFrame:
    """A parameterised view: named arguments never become part of the SQL text."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=params)


def native_source(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A foreign SQL query over JDBC; the schema comes from the result's metadata."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


#: Most portions of a parallel load over JDBC: each is a connection of its own.
MOST_PARTS = 10_000


def sql_literal(value) -> str:
    """A value as other databases read it, with the JDBC escapes of dates and times."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def portion_predicates(portions: DataFrame, column: str, half_open: bool = False) -> tuple[list[int], list[str]]:
    """(numbers, conditions) of portions (portion_no, lo, hi), and number 0 for the rows without a value; together they hold every row once."""
    rows = portions.where("lo is not null").orderBy("lo").limit(MOST_PARTS + 1).collect()
    if len(rows) > MOST_PARTS:
        raise ValueError(f"more than {MOST_PARTS} portions")
    end = "<" if half_open else "<="
    return [0, *[r.portion_no for r in rows]], [f"{column} IS NULL", *[f"{column} >= {sql_literal(r.lo)} AND {column} {end} {sql_literal(r.hi)}" for r in rows]]


def parallel_load(spark: SparkSession, url: str, table: str, column: str, portions: DataFrame, half_open: bool = False, **options) -> DataFrame:
    """A foreign table over JDBC with portion_no: a task and a query of its own for each portion, and one for the rows without a value.

    Each query asks the foreign database for its range alone; rows outside all portions aren't loaded.
    """
    numbers, conditions = portion_predicates(portions, column, half_open)
    rows = spark.read.jdbc(url, table, predicates=conditions, properties={k: str(v) for k, v in options.items()})
    return rows.withColumn("portion_no", F.get(F.array(*[F.lit(n).cast("long") for n in numbers]), F.spark_partition_id()))


def ingest_json(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON in a text column as typed columns beside the others: one row for an object or null, one for each object of an array.

    Fields that a text lacks, and those of a text that isn't JSON, are null; an empty array gives no row.
    """
    text = F.trim(F.col(column))
    each = F.from_json(F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), F.coalesce(text, F.lit("{}")), F.lit("]"))), f"array<struct<{schema}>>")
    fields = T.DataType.fromDDL(schema).names
    out = rows.withColumn("_json", F.explode(F.coalesce(each, F.array(F.lit(None).cast(f"struct<{schema}>")))))
    return out.select(*[c for c in rows.columns if c != column], *[F.col("_json")[c].alias(c) for c in fields])


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """One relation from parts whose columns differ; what a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def empty_load(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
