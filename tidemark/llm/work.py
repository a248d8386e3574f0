"""Where operators keep intermediate tables: the folder that the cluster shares."""

from __future__ import annotations

import gc
import json
import re
import tempfile
import time
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as characters and as a Java regular expression.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t-\\r]+"


#: Most bytes of the batches of rows that go to Python workers and back, if the session says nothing of it: Spark's own
#: default counts rows, whatever their texts' length.
BATCH = 4 << 20

_own: dict[str, str] = {}


def steady(spark: SparkSession) -> None:
    """Bounds the batches of the session by bytes, so that tasks on long texts need no more memory than others."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir.  Unset, it is a temporary folder in local mode, as in tests, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
        found = _own[context.applicationId]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used."""
    steady(spark)
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: computed once, safe from lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files of steps whose results have been written.

    Spark deletes them when the driver's JVM finds that nothing refers to them, which may be long after.
    """
    gc.collect()  # plans that only Python's garbage refers to
    for _ in range(2):  # what the first pass finds dead holds on to more until the cleaner has seen it
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def free_name(name: str, taken: list[str]) -> str:
    """name, with more underscores if columns are called so already."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    steady(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bits of the filter that possible() ships, as a power of 2: 16 MB.
FILTER_BITS = 27


def possible(wanted: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test on a column: true for every value of wanted's key, and for few others.

    A bitmap with two places a value, of 16 bits a value up to 2 ** FILTER_BITS in all; beyond that it lets
    more rows pass.  It spares rows that can't match a shuffle; an exact join of the rest must follow.
    """
    spark = wanted.sparkSession
    bits = min(FILTER_BITS, max(10, (16 * wanted.count()).bit_length()))
    mask = F.lit((1 << bits) - 1)
    places = F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 36).bitwiseAND(mask)))
    found = wanted.select(F.xxhash64(key).alias("h")).select(places.alias("p"))
    found = found.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v")).toArrow()  # at most 2 ** (FILTER_BITS - 6) rows
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[found["at"].to_numpy()] = found["v"].to_numpy().view(np.uint64)
    shipped = spark.sparkContext.broadcast(table)

    def test(hashes: pa.Array) -> pa.Array:
        h, out, low = hashes.to_numpy().view(np.uint64), None, np.uint64((1 << bits) - 1)
        for p in (h & low, (h >> np.uint64(36)) & low):
            hit = (shipped.value[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)
            out = hit if out is None else out & hit
        return pa.array(out.astype(bool))

    check = F.arrow_udf(test, "boolean")
    return lambda c: check(F.xxhash64(c))


#: Most words of 64 bits in the bitmap of possible_natively(), which travels with the plan.
BITMAP = 1 << 16


def possible_natively(wanted: DataFrame) -> Callable[[Column], Column]:
    """possible() without Python, for hashes: a test that every h of wanted passes, and few others.

    A bitmap of 64 bits a hash, up to BITMAP words; a fuller one lets more rows pass to the join that must follow.
    """
    size = 1 << max(6, min(BITMAP, wanted.count()).bit_length())
    word, bit = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(size - 1)), F.expr("shiftleft(1L, cast(h & 63 as int))")
    bitmap = np.zeros(size, np.int64)
    for r in wanted.groupBy(word.alias("at")).agg(F.bit_or(bit).alias("bits")).collect():  # at most ``size`` rows
        bitmap[r["at"]] = r["bits"]
    table = F.from_json(F.lit(json.dumps(bitmap.tolist())), "array<bigint>")
    return lambda h: F.getbit(F.get(table, F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(size - 1)).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def text_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a hash of the text in a new column, and its name: with doc_id it tells rows apart whose doc_id is the same."""
    name = free_name("_text_key", docs.columns)
    return docs.withColumn(name, F.xxhash64("text")), name


def without(docs: DataFrame, gone: DataFrame, key: str, native: bool = False) -> DataFrame:
    """docs without the rows whose doc_id and ``key``, from text_key(), are in gone; a null doc_id is a value like others.

    Only rows that may be in gone are shuffled.  Columns are kept, but for key.  native: the filter is a
    column expression, for at most some million rows that go.
    """
    columns = [c for c in docs.columns if c != key]
    of, of_key = free_name("_gone_id", docs.columns), free_name("_gone_key", docs.columns)
    gone = saved(gone.select(F.col("doc_id").alias(of), F.col(key).alias(of_key)).distinct(), "gone")
    may = possible_natively(gone.select(F.col(of_key).alias("h"))) if native else possible(gone, of_key)
    same = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(key) == F.col(of_key))
    doubtful = docs.where(may(F.col(key))).join(gone.hint("merge"), same, "left_anti")
    return docs.where(~may(F.col(key))).select(columns).unionByName(doubtful.select(columns))
