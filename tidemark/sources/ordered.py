"""Rows in the order of columns without a window over all of them: range bins, and what one bin hands to the next.

Rows are dealt by ranges of the whole order, so a hot value of its first columns is split by the others, and sorted where
they lie.  Only a row for each bin is ever put in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import saved

#: Columns of dealt rows: the bin, and the place in it.
BIN, PLACE = "_bin", "_in"


def _before():
    """The bins before, over a table of one row a bin."""
    return Window.orderBy(BIN).rowsBetween(Window.unboundedPreceding, -1)


def _inside():
    return Window.partitionBy(BIN).orderBy(PLACE)


def dealt(df: DataFrame, order: list[str]) -> DataFrame:
    """df written in bins of its order, with bin and place; bins rise with the order."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # range << 33, and the place in it
    return saved(rows.withColumns({BIN: F.shiftright(place, 33), PLACE: place.bitwiseAND(F.lit((1 << 33) - 1))}), "dealt")


def with_offsets(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Dealt rows with the sums of each of these aggregates over the bins before."""
    by = rows.groupBy(BIN).agg(*[c.alias(n) for n, c in sums.items()])
    by = by.select(BIN, *[F.coalesce(F.sum(n).over(_before()), F.lit(0)).alias(n) for n in sums])
    return rows.join(F.broadcast(by), BIN)


def numbered(df: DataFrame, order: list[str], name: str = "_seq", base: int = 0) -> DataFrame:
    """df with base + 1, 2, … in the order of columns that make a total order."""
    rows = with_offsets(dealt(df, order), {"_off": F.count("*")})
    return rows.withColumn(name, (F.col("_off") + F.col(PLACE) + base + 1).cast("long")).drop(BIN, PLACE, "_off")


def lagged(df: DataFrame, by: list[str], order: list[str], columns: list[str], prefix: str = "_before_") -> DataFrame:
    """df with the columns of the row before in the order of by and order; null for the first of each value of by.

    A bin's first row gets the last one of the bins before, so no window holds a whole value of by.
    """
    rows = dealt(df, [*by, *order])
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*by, *columns])])
    last = rows.groupBy(BIN).agg(F.max_by(row, PLACE).alias("_carry"))
    last = last.select(BIN, F.lag("_carry").over(Window.orderBy(BIN)).alias("_carry"))  # over one row a bin
    rows = rows.join(F.broadcast(last), BIN).withColumn("_row", F.coalesce(F.lag(row).over(_inside()), F.col("_carry")))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"_row.{c}").eqNullSafe(F.col(c))
    return rows.select(*df.columns, *[F.when(same, F.col(f"_row.{c}")).alias(prefix + c) for c in columns])


def carried(df: DataFrame, order: list[str], mark: str, name: str) -> DataFrame:
    """df with the last value of ``mark`` that is not null at or before each row of the order."""
    rows = dealt(df, order)
    last = rows.where(F.col(mark).isNotNull()).groupBy(BIN).agg(F.max_by(mark, PLACE).alias("_carry"))
    last = rows.groupBy(BIN).agg(F.lit(1).alias("_one")).join(last, BIN, "left")
    last = last.select(BIN, F.last("_carry", ignorenulls=True).over(_before()).alias("_carry"))
    here = F.last(mark, ignorenulls=True).over(_inside().rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(F.broadcast(last), BIN).withColumn(name, F.coalesce(here, F.col("_carry"))).drop(BIN, PLACE, "_carry")


def quantiles(counts: DataFrame, by: list[str], value: str, n: str, shares: dict[str, float], interpolated: bool = False) -> DataFrame:
    """by, and a column for each share: the exact quantile of values that occur n times each.

    Discrete ones are the least value that so large a share of rows doesn't exceed; interpolated ones lie between
    the two nearest.  Null values don't count.  Values are dealt into range bins; prefix sums over the bins say
    which of them hold a rank that is asked for, and only these are looked into.
    """
    rows = dealt(counts.where(F.col(value).isNotNull() & (F.col(n) > 0)).select(*by, F.col(value).alias("_v"), F.col(n).alias("_n")), [*by, "_v"])
    sizes = rows.groupBy(*by, BIN).agg(F.sum("_n").alias("_k"))  # a row for each bin, and one more for each end of a value of by
    over = Window.partitionBy(*by).orderBy(BIN)
    sizes = sizes.select(*by, BIN, "_k", (F.sum("_k").over(over) - F.col("_k")).alias("_off"), F.sum("_k").over(Window.partitionBy(*by)).alias("_all"))
    asked, made = [], []
    for c, p in shares.items():
        at = F.lit(p) * (F.col("_all") - 1) if interpolated else F.greatest(F.ceil(F.lit(p) * F.col("_all") - 1e-9) - 1, F.lit(0))
        parts = {"lo": F.floor(at), "hi": F.ceil(at)} if interpolated else {"lo": at}
        asked += [F.struct(F.lit(f"{c}_{k}").alias("name"), x.cast("long").alias("rank")) for k, x in parts.items()]
        low, high = F.col(f"{c}_lo"), F.col(f"{c}_hi")
        made.append((low.cast("double") + (at - F.floor(at)) * (high.cast("double") - low.cast("double")) if interpolated else low).alias(c))
    wanted = sizes.select(*by, BIN, "_off", "_k", "_all", F.explode(F.array(*asked)).alias("_a"))
    wanted = wanted.where((F.col("_a.rank") >= F.col("_off")) & (F.col("_a.rank") < F.col("_off") + F.col("_k")))  # one bin for each rank
    keys = [*by, BIN]
    looked = rows.alias("a").join(F.broadcast(wanted.select(*[F.col(c).alias(f"b_{c}") for c in keys]).distinct()), _same(keys), "left_semi")
    inside = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    looked = looked.select(*keys, "_v", "_n", F.sum("_n").over(inside).alias("_upto"))
    hit = (F.col("_a.rank") - F.col("_off") >= F.col("_upto") - F.col("_n")) & (F.col("_a.rank") - F.col("_off") < F.col("_upto"))
    found = looked.alias("a").join(F.broadcast(wanted.select(*[F.col(c).alias(f"b_{c}") for c in keys], "_off", "_all", "_a")), _same(keys) & hit)
    names = [f"{c}_{k}" for c in shares for k in (("lo", "hi") if interpolated else ("lo",))]
    found = found.groupBy(*[F.col(f"a.{c}").alias(c) for c in by]).agg(F.max("_all").alias("_all"), *[F.max(F.when(F.col("_a.name") == x, F.col("_v"))).alias(x) for x in names])
    return found.select(*by, *made)


def _same(keys: list[str]) -> Column:
    out = F.lit(True)
    for c in keys:
        out = out & F.col(f"a.{c}").eqNullSafe(F.col(f"b_{c}"))
    return out
