"""Package streams: JSON envelopes with CSV bodies, decoded and applied in order, replayable from their raw copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.loads import ingest_typed_text
from .cdc import coalesce_log
from .merge import apply_merge, snapshot_merge

ENVELOPE = "Encoding string, Attributes struct<`message.batchIndex`: long, `message.lastBatch`: boolean, Content: struct<Kind: string, Fields: array<struct<Name: string>>>>, Body string"

#: A CSV row with quotes: the quoted parts may hold commas, quotes and line ends.
_ROW = r'((?:[^"\n]|"(?:[^"]|"")*")+)(?:\n|$)'
_CELL = r'(?:^|,)("(?:[^"]|"")*"|[^,"]*)'


def envelopes(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """batch_index, last_batch, names, body of raw envelopes; what is no CSV table fails the job, control envelopes have no names."""
    e = raw.select(F.from_json(payload, ENVELOPE).alias("e")).select("e.*")
    a = F.col("Attributes")
    wrong = (F.col("Encoding") != "csv") | (a["Content"]["Kind"] != "Table") | (a["Content"]["Fields"].isNull() != F.col("Body").isNull())
    checked = F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(F.concat(F.lit("not a CSV table: batch "), a["message.batchIndex"].cast("string"))).cast("bigint")).otherwise(a["message.batchIndex"])
    return e.select(checked.alias("batch_index"), F.coalesce(a["message.lastBatch"], F.lit(False)).alias("last_batch"), a["Content"]["Fields"]["Name"].alias("names"), F.col("Body").alias("body"))


def decode(raw: DataFrame, fields: list[str], payload: str = "payload") -> DataFrame:
    """batch_index, row_no and the named fields as text, by name and in any order; unquoted empty cells are null.

    A row with another number of cells than the package has names fails the job with batch and row.
    """
    rows = envelopes(raw, payload).where("names is not null")
    rows = rows.select("batch_index", "names", F.posexplode(F.regexp_extract_all("body", F.lit(_ROW), 1)).alias("row_no", "line"))
    rows = rows.withColumn("cells", F.regexp_extract_all("line", F.lit(_CELL), 1))
    message = F.concat(F.lit("batch "), F.col("batch_index").cast("string"), F.lit(" row "), F.col("row_no").cast("string"), F.lit(": wrong number of cells"))
    rows = rows.withColumn("cells", F.when(F.size("cells") == F.size("names"), F.col("cells")).otherwise(F.raise_error(message).cast("array<string>")))

    def cell(name: str):
        at = F.array_position(F.transform("names", lambda n: F.lower(n)), name.lower()).cast("int")
        text = F.get("cells", at - 1)
        plain = F.when(text.startswith('"'), F.replace(text.substr(F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"')))
        return plain.otherwise(F.when(text == "", None).otherwise(text)).alias(name)

    return rows.select("batch_index", "row_no", *[cell(f) for f in fields])


def package_full(target: DataFrame, raw: DataFrame, keys: list[str], op_col: str | None = None) -> DataFrame:
    """A full load in packages: all after-images once the last batch is there, then a snapshot merge; deletes are refused."""
    if envelopes(raw).where("last_batch").isEmpty():
        return target
    fields = target.columns + ([op_col] if op_col else [])
    rows = decode(raw, fields)
    if op_col:
        bad = F.raise_error(F.lit("a full load holds a delete")).cast("string")
        rows = rows.withColumn(op_col, F.when(F.upper(op_col) == "D", bad).otherwise(F.col(op_col))).where(F.coalesce(F.col(op_col), F.lit("")) != "D")
    last = coalesce_log(rows.withColumn("_place", F.struct("batch_index", "row_no")), keys, "_place")
    return snapshot_merge(target, ingest_typed_text(last.select(target.columns), target.schema), keys)


def package_delta(target: DataFrame, raw: DataFrame, keys: list[str], op_col: str, after: int | None = None) -> DataFrame:
    """Packages past the merged position, coalesced by (batch, row) and merged once: D deletes, U and blank upsert.

    raw is the stored copy, so replaying any stretch of it again changes nothing.
    """
    rows = decode(raw, [*target.columns, op_col])
    if after is not None:
        rows = rows.where(F.col("batch_index") > after)
    last = coalesce_log(rows.withColumn("_place", F.struct("batch_index", "row_no")), keys, "_place")
    op = F.when(F.upper(op_col) == "D", "D").otherwise("U")
    kinds = T.StructType([*target.schema.fields, T.StructField("_op", T.StringType())])
    return apply_merge(target, ingest_typed_text(last.withColumn("_op", op), kinds), keys, "_op")


def with_number(raw: DataFrame, payload: str = "payload", name: str = "_number") -> DataFrame:
    """raw with each package's number; nothing else is decoded."""
    return raw.withColumn(name, F.from_json(payload, "Attributes struct<`message.batchIndex`: long>")["Attributes"]["message.batchIndex"])


def refuse_stale(raw: DataFrame, position: int) -> None:
    """A new package must come after the merged position."""
    least = with_number(raw).agg(F.min("_number")).first()[0]
    if least is not None and least <= position:
        raise ValueError(f"batch {least} is not after {position}")
