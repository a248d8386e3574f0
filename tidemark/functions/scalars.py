"""Column builders for the text conventions of the source systems: padded numbers, text dates, flags, counters."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = "^[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alpha_in(v, length: int) -> Column:
    """Zero-pad values that are all digits; others, null and blank stay. Longer values are not cut."""
    v = _col(v)
    return F.when(v.rlike(DIGITS) & (F.length(v) < length), F.lpad(v, length, "0")).otherwise(v)


def alpha_out(v) -> Column:
    """Drop leading zeros of values that are all digits, of any length; one zero is left of zeros."""
    v = _col(v)
    return F.when(v.rlike(DIGITS), F.regexp_replace(v, "^0+(?=.)", "")).otherwise(v)


def flag(v) -> Column:
    """'X' is true, everything else and null false."""
    return F.coalesce(_col(v) == "X", F.lit(False))


def text_date(v) -> Column:
    """yyyyMMdd as a date; null, blank, zeros and what is no date give null."""
    v = _col(v)
    return F.when(v.rlike("^[0-9]{8}$"), F.try_to_date(v, "yyyyMMdd"))


def text_time(v) -> Column:
    """HHmmss as 'HH:mm:ss'; 000000 is midnight; null, blank and what is no time give null."""
    v = _col(v)
    ok = v.rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$")
    return F.when(ok, F.concat_ws(":", F.substring(v, 1, 2), F.substring(v, 3, 2), F.substring(v, 5, 2)))


def initial_date(v) -> Column:
    """An ISO text date; 0000-00-00 or only blanks and dashes give null; other junk fails the job."""
    v = _col(v)
    blank = (F.trim(v, F.lit(" -")) == "") | (v == "0000-00-00")
    return F.when(v.isNull() | blank, F.lit(None).cast("date")).otherwise(v.cast("date"))


def coerce(v, source: str, target: str) -> Column:
    """Text of the change log as the target's type: dates, times, hex, else a strict cast."""
    v = _col(v)
    if source == target or target == "string":
        return v
    if target == "date":
        return F.when(v.isNull() | v.isin("", "00000000"), F.lit(None).cast("date")).otherwise(F.to_date(v, "yyyyMMdd"))
    if target == "time":
        return text_time(v)
    if target == "timestamp":
        return F.to_timestamp(F.substring(v, 1, 14), "yyyyMMddHHmmss")
    if target == "binary":
        bad = F.raise_error(F.concat(F.lit("not hexadecimal: "), v)).cast("binary")
        return F.when(v.isNull() | (v == ""), F.lit(None).cast("binary")).when(v.rlike("^([0-9A-Fa-f]{2})+$"), F.unhex(v)).otherwise(bad)
    return v.cast(target)


def format_numts(ts) -> Column:
    return F.date_format(_col(ts), "yyyyMMddHHmmss")


def parse_numts(v) -> Column:
    """The first 14 digits as a time stamp of the session's zone; null where there are fewer."""
    v = _col(v)
    return F.try_to_timestamp(F.substring(v, 1, 14), F.lit("yyyyMMddHHmmss"))


def shift_padded(v, by: int) -> Column:
    """Arithmetic on a zero-padded counter keeps its width and never goes below zero."""
    v = _col(v)
    moved = F.greatest(F.lit(0), v.cast("decimal(38,0)") + by).cast("string")
    return F.when(F.length(moved) < F.length(v), F.lpad(moved, F.length(v), F.lit("0"))).otherwise(moved)


def format_lag(seconds) -> Column:
    """never, 45s, 3m07s or 2h05m."""
    s = _col(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    minutes = F.concat(F.floor(s / 60).cast("string"), F.lit("m"), two(s % 60), F.lit("s"))
    hours = F.concat(F.floor(s / 3600).cast("string"), F.lit("h"), two(F.floor(s % 3600 / 60)), F.lit("m"))
    return F.when(s.isNull(), "never").when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, minutes).otherwise(hours)


def cadence_seconds(c) -> Column:
    c = F.lower(_col(c))
    micro = F.try_to_number(F.regexp_extract(c, "^micro:([0-9]+)$", 1), F.lit("999999999")).cast("long")
    return F.when(c == "hourly", F.lit(3600).cast("long")).when(c == "nightly", F.lit(86400).cast("long")).otherwise(F.coalesce(micro, F.lit(0).cast("long")))


def with_currency(amounts: DataFrame, amount: str, currency: str, decimals: DataFrame | None) -> DataFrame:
    """amounts with curr_decimals and curr_amount: amount * 10^(2 - decimals), decimals 2 where not listed.

    decimals: currkey, currdec, a list of the world's currencies and small; missing it is an error.
    """
    if decimals is None:
        raise ValueError("the table of currency decimals is missing")
    listed = decimals.select(F.col("currkey").alias("_key"), F.col("currdec").cast("int").alias("_dec"))
    rows = amounts.join(F.broadcast(listed), F.col(currency) == F.col("_key"), "left")
    rows = rows.withColumn("curr_decimals", F.coalesce("_dec", F.lit(2)))
    scaled = F.col(amount).cast("decimal(20,2)") * F.pow(F.lit(10), 2 - F.col("curr_decimals")).cast("decimal(12,6)")
    return rows.withColumn("curr_amount", scaled.cast("decimal(30,5)")).drop("_key", "_dec")


def unique_token(name: str) -> str:
    """A table token for a target name: upper case, other characters as _, and a short hash where any was replaced."""
    plain = re.sub(r"[^A-Z0-9_]", "_", name.upper())
    return plain if plain == name.upper() else f"{plain}_{hashlib.sha256(name.upper().encode()).hexdigest()[:6].upper()}"


SQL_FUNCTIONS = {
    "alpha_in(v STRING, n INT)": "STRING RETURN CASE WHEN v RLIKE '^[0-9]+$' AND length(v) < n THEN lpad(v, n, '0') ELSE v END",
    "alpha_out(v STRING)": "STRING RETURN CASE WHEN v RLIKE '^[0-9]+$' THEN regexp_replace(v, '^0+(?=.)', '') ELSE v END",
    "flag_x(v STRING)": "BOOLEAN RETURN coalesce(v = 'X', false)",
    "text_date(v STRING)": "DATE RETURN CASE WHEN v RLIKE '^[0-9]{8}$' THEN try_to_date(v, 'yyyyMMdd') END",
}


def register(spark: SparkSession) -> None:
    """The scalar functions for SQL; Catalyst inlines them."""
    for head, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {body}")
