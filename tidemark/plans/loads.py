"""Queries of scans, loads, portions and the SQL surface."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import script
from ..sources import loads, portions
from ..sources.ordered import numbered
from ..sources.scratch import fresh_path, saved
from . import scenarios as X
from .registry import query

CATALOG = [
    {"name": "L_ORDERKEY", "datatype": "INT8", "is_key": True}, {"name": "L_LINENUMBER", "datatype": "INT4", "is_key": True}, {"name": "L_QUANTITY", "datatype": "DEC", "length": 15, "decimals": 2},
    {"name": "L_EXTENDEDPRICE", "datatype": "CURR", "length": 15, "decimals": 2}, {"name": "L_RETURNFLAG", "datatype": "CHAR", "length": 1},
]


@query("L01_full_load", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag <> 'N'")
def full_load(spark, d):
    schema, _ = loads.typed_schema(CATALOG)
    path = fresh_path(spark, "load")
    for _ in range(2):  # a re-run replaces the target
        loads.full_load(X.table(spark, d, "lineitem"), schema, F.col("l_returnflag") != "N").write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


@query("L02_typed_schema", "SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS amount FROM lineitem GROUP BY ALL")
def typed_schema(spark, d):
    schema, keys = loads.typed_schema(CATALOG, ["l_extendedprice"])
    rows = loads.full_load(X.table(spark, d, "lineitem"), schema)
    return rows.groupBy(*keys).agg(F.sum("l_extendedprice").cast("double").alias("amount"))


@query("L03_select_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def select_columns(spark, d):
    o = X.table(spark, d, "orders")
    columns, _ = loads.select_columns(o.columns, ["O_ORDERSTATUS"], ["o_orderkey"])
    return o.select(columns)


@query("L04_source_filter", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderstatus = 'O') AND (o_custkey % 2 = 0)")
def source_filter(spark, d):
    return loads.source_filter(X.table(spark, d, "orders"), F.col("o_orderstatus").isin("F", "O"), F.col("o_custkey") % 2 == 0, None).select("o_orderkey")


@query("L05_row_cap", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def row_cap(spark, d):
    return loads.row_cap(X.table(spark, d, "orders").select("o_orderkey", "o_custkey"), 1000, ["o_orderkey"])


@query("L06_param_source", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")
def param_source(spark, d):
    text = "SELECT o_orderstatus, count(*) AS n FROM param_orders WHERE o_orderpriority = :priority GROUP BY o_orderstatus"
    return loads.param_source(spark, text, {"param_orders": X.table(spark, d, "orders")}, priority="1-URGENT")


@query("L08_keyset_page", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey > 50 OR (l_orderkey = 50 AND l_linenumber > 3) OR (l_orderkey = 50 AND l_linenumber = 3 AND l_partkey > 10) ORDER BY 1, 2, 3 LIMIT 500")
def keyset_page(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return loads.keyset_page(rows, ["l_orderkey", "l_linenumber", "l_partkey"], [50, 3, 10], 500)


@query("L09_lookup_keys", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT o_orderkey, 1 + o_custkey % 4 FROM orders WHERE o_orderstatus = 'P')")
def lookup_keys(spark, d):
    keys = X.table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), (1 + F.col("o_custkey") % 4).cast("int").alias("l_linenumber"))
    return loads.lookup_keys(X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), keys, ["l_orderkey", "l_linenumber"])


WIDTH_SQL = """f AS (SELECT min(l_orderkey) AS a, max(l_orderkey) AS b, count(*) AS n FROM lineitem), p AS (SELECT a, b, n, {parts} AS parts FROM f),
q AS (SELECT *, CAST(ceil((b - a + 1) / parts) AS BIGINT) AS width FROM p), c AS (SELECT unnest(range(a, b + 1, width)) AS lo, * FROM q),
cuts AS (SELECT row_number() OVER (ORDER BY lo) AS portion_no, lo, least(lo + width - 1, b) AS hi, CAST(ceil(n / parts) AS BIGINT) AS est_rows FROM c)"""


@query("L10_parallel_load", "WITH s AS (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS c, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders), f AS (SELECT min(c) AS a, max(c) AS b FROM s), q AS (SELECT a, CAST(ceil((b - a + 1) / CAST(greatest(1, least(8, b - a + 1)) AS DOUBLE)) AS BIGINT) AS width FROM f) SELECT CASE WHEN c IS NULL THEN 0 ELSE (c - a) // width + 1 END AS portion_no, count(*) AS n, count(c) AS customers, CAST(sum(price) AS DOUBLE) AS price FROM s, q GROUP BY 1")
def parallel_load(spark, d):
    """orders from another database into a target, a task and a query of its own for each of 8 portions and for the rows without a customer.

    On a cluster without a database the foreign table is files, and one scan deals its rows out by portion.
    """
    rows = X.orders(spark, d).select(F.col("k").alias("K"), F.when(F.col("k") % 11 != 0, F.col("cust")).alias("CUST"), F.col("price").alias("PRICE"))
    if X.database(spark):
        url, name, options = X.foreign(spark, rows)
        facts = loads.native_source(spark, url, f"SELECT MIN(CUST) AS A, MAX(CUST) AS B, COUNT(CUST) AS N FROM {name}", **options).toDF("a", "b", "n")
        loaded = loads.parallel_load(spark, url, name, "CUST", portions.widths(facts, parts=8), **options)
    else:
        source = X.foreign_files(spark, rows)
        loaded = portions.assign_portion(source, "CUST", portions.by_width(source, "CUST", parts=8)).where("portion_no is not null")
    path = fresh_path(spark, "load")
    loaded.write.partitionBy("portion_no").parquet(path)
    back = spark.read.schema("K long, CUST long, PRICE decimal(18,2), portion_no long").parquet(path)
    return back.groupBy("portion_no").agg(F.count("*").alias("n"), F.count("CUST").alias("customers"), F.sum("PRICE").cast("double").alias("price"))


@query("L11_partition_candidates", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, min(CAST({c} AS VARCHAR)) AS min_value, max(CAST({c} AS VARCHAR)) AS max_value, count(*) - count({c}) AS n_null, avg(CASE WHEN regexp_matches(CAST({c} AS VARCHAR), '^[0-9]+$') THEN 1.0 ELSE 0.0 END) AS digit_share FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")))
def partition_candidates(spark, d):
    return portions.partition_candidates(X.table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("L13_ingest_json", "WITH x AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) SELECT event_id, k, i AS part FROM x, (VALUES (0), (1)) v(i) WHERE i = 0 OR event_id % 3 = 0 UNION ALL SELECT event_id, NULL, NULL FROM x WHERE event_id % 5 = 0")
def ingest_json(spark, d):
    e = X.table(spark, d, "events")
    one = lambda i: F.regexp_replace("props", r"\}\s*$", f', "part": {i}}}')
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" ["), one(0), F.lit(", "), one(1), F.lit("]"))).otherwise(one(0))  # objects and arrays of them
    rows = e.select("event_id", text.alias("body")).unionByName(e.where("event_id % 5 = 0").select("event_id", F.lit("{not json").alias("body")))
    return loads.ingest_json(rows, "body", "k bigint, part int")


@query("L14_typed_text", "SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS price, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def typed_text(spark, d):
    o = X.table(spark, d, "orders")
    text = o.select(F.col("o_orderkey").cast("string").alias("K"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"), F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.when(F.col("o_orderkey") % 2 == 0, "0000-00-00").otherwise("    -  -  ")).alias("day"))
    from pyspark.sql import types as T

    return loads.ingest_typed_text(text, T._parse_datatype_string("k bigint, price decimal(18,2), day date"))


@query("L15_union_by_name", "SELECT o_orderkey AS k, o_orderstatus AS status, NULL AS cust FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_custkey FROM orders WHERE o_orderkey % 2 = 1")
def union_by_name(spark, d):
    o = X.table(spark, d, "orders").withColumnRenamed("o_orderkey", "k")
    root = fresh_path(spark, "union")
    o.where("k % 2 = 0").select("k", F.col("o_orderstatus").alias("status")).write.parquet(f"{root}/a")
    o.where("k % 2 = 1").select(F.col("o_custkey").alias("cust"), "k").write.parquet(f"{root}/b")
    return loads.union_by_name([spark.read.parquet(f"{root}/{p}") for p in "ab"])


@query("L16_read_partitioned", "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def read_partitioned(spark, d):
    path = fresh_path(spark, "partitioned")
    X.table(spark, d, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last_key"))


@query("L17_federated_query", "SELECT lang, coalesce(CAST(quality AS VARCHAR), 'none') AS quality, count(*) AS n, sum(n_chars) AS chars FROM documents LEFT JOIN (SELECT doc_id, quality FROM labels WHERE toxic = 0) USING (doc_id) GROUP BY 1, 2")
def federated_query(spark, d):
    """One statement over Parquet and a table of another database, which gets the filter and the columns.

    On a cluster without a database the foreign table is ORC files, whose scan gets them.
    """
    labels = X.table(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"))
    if X.database(spark):
        url, name, options = X.foreign(spark, labels)
        foreign = spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
    else:
        foreign = X.foreign_files(spark, labels)
    X.table(spark, d, "documents").createOrReplaceTempView("federated_documents")
    foreign.createOrReplaceTempView("federated_labels")
    return spark.sql("SELECT lang, coalesce(CAST(quality AS STRING), 'none') AS quality, count(*) AS n, sum(n_chars) AS chars FROM federated_documents LEFT JOIN (SELECT doc_id, quality FROM federated_labels WHERE toxic = 0) USING (doc_id) GROUP BY 1, 2")


@query("L18_empty_load", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey < 0")
def empty_load(spark, d):
    schema, _ = loads.typed_schema(CATALOG, ["l_linenumber"])
    return loads.empty_load(spark, schema).union(loads.full_load(X.table(spark, d, "lineitem"), schema, F.col("l_orderkey") < 0))


GREEDY = """h AS (SELECT row_number() OVER (ORDER BY {col}) AS i, {col} AS v, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}),
x AS (SELECT i, v, n, CAST(1 AS BIGINT) AS no, n AS s FROM h WHERE i = 1 UNION ALL SELECT h.i, h.v, h.n, CASE WHEN x.s + h.n <= {limit} THEN x.no ELSE x.no + 1 END, CASE WHEN x.s + h.n <= {limit} THEN x.s + h.n ELSE h.n END FROM x JOIN h ON h.i = x.i + 1)
SELECT no AS portion_no, min(v) AS lo, max(v) AS hi, CAST(sum(n) AS BIGINT) AS est_rows FROM x GROUP BY no"""


@query("L20_portions_histogram", "WITH RECURSIVE " + GREEDY.format(col="l_suppkey", table="lineitem", limit=5000))
def portions_histogram(spark, d):
    return portions.by_records(X.table(spark, d, "lineitem"), "l_suppkey", 5000)


@query("L21_portions_width", "WITH " + WIDTH_SQL.format(parts="greatest(1, least(CAST(ceil(n / 7000) AS BIGINT), b - a + 1))") + " SELECT portion_no, lo, hi, est_rows FROM cuts")
def portions_width(spark, d):
    return portions.by_width(X.table(spark, d, "lineitem"), "l_orderkey", limit=7000)


@query("L22_portions_size", "WITH RECURSIVE " + GREEDY.format(col="l_suppkey", table="lineitem", limit=8192))
def portions_size(spark, d):
    return portions.by_size(X.table(spark, d, "lineitem"), "l_suppkey", 1, 128)


@query("L23_portions_time", "WITH f AS (SELECT date_trunc('month', min(l_shipdate)) AS a, max(l_shipdate) AS b FROM lineitem), c AS (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS lo FROM f) SELECT row_number() OVER (ORDER BY lo) AS portion_no, CAST(lo AS DATE) AS lo, CAST(lo + INTERVAL 1 MONTH AS DATE) AS hi FROM c")
def portions_time(spark, d):
    return portions.by_time(X.table(spark, d, "lineitem"), "l_shipdate", "month")


@query("L24_portions_fiscal", "WITH p AS (SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1, 2) SELECT CAST(y AS INT) AS fiscal_year, CAST(q AS INT) AS period, row_number() OVER (ORDER BY y, q) AS portion_no, coalesce(lag(e) OVER (ORDER BY y, q) + 1, DATE '1990-01-01') AS lo, e AS hi FROM p")
def portions_fiscal(spark, d):
    p = X.table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("fiscal_year"), F.quarter("o_orderdate").alias("period")).agg(F.to_date(F.max("o_orderdate")).alias("period_end"))
    return portions.by_fiscal(p, dt.date(1990, 1, 1))


@query("L25_portions_list", "SELECT CASE WHEN o_orderpriority BETWEEN '1' AND '2~' THEN 1 WHEN o_orderpriority BETWEEN '4' AND '5~' THEN 2 END AS portion_no, count(*) AS n FROM orders GROUP BY 1")
def portions_list(spark, d):
    cuts = portions.by_list(spark, [("1", "2~"), ("4", "5~")], "string")
    return portions.assign_portion(X.table(spark, d, "orders").select("o_orderpriority"), "o_orderpriority", cuts).groupBy("portion_no").agg(F.count("*").alias("n"))


@query("J10_range_assign", "WITH f AS (SELECT date_trunc('year', min(l_shipdate)) AS a FROM lineitem) SELECT CAST(year(l_shipdate) - year(a) + 1 AS BIGINT) AS portion_no, count(*) AS n FROM lineitem, f GROUP BY 1")
def range_assign(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_shipdate")
    return portions.assign_portion(rows, "l_shipdate", portions.by_time(rows, "l_shipdate", "year"), half_open=True).groupBy("portion_no").agg(F.count("*").alias("n"))


@query("U03_union_portions", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def union_portions(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    cut = saved(portions.assign_portion(rows, "l_orderkey", portions.by_width(rows, "l_orderkey", parts=4)), "portions")  # one scan numbers the rows
    parts = [cut.where(F.col("portion_no") == i) for i in range(5)]  # each portion is then read alone, its number a filter of the scan; folders by portion would sort each task's rows
    return loads.union_by_name(parts).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("T01_ordered_read", "SELECT l_orderkey, l_linenumber, l_returnflag, 'full' AS mode FROM lineitem UNION ALL SELECT * FROM (SELECT l_orderkey, l_linenumber, l_returnflag, 'sample' AS mode FROM lineitem ORDER BY 1, 2, 3 LIMIT 1000)")
def ordered_read(spark, d):
    from ..operators import quality

    rows, columns = X.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"]
    both = [quality.ordered_read(rows, columns, n).withColumn("mode", F.lit(mode)) for n, mode in ((None, "full"), (1000, "sample"))]
    return loads.union_by_name(both)


@query("A12_histogram", "SELECT l_suppkey AS value, count(*) AS n FROM lineitem GROUP BY 1")
def histogram(spark, d):
    return portions.histogram(X.table(spark, d, "lineitem"), "l_suppkey")


@query("A13_high_water", "WITH x AS (SELECT strftime(l_shipdate, '%Y%m%d') AS day, lpad(CAST(l_partkey % 240000 AS VARCHAR), 6, '0') AS clock FROM lineitem) SELECT max(day) AS day, max(clock) FILTER (day = (SELECT max(day) FROM x)) AS clock FROM x")
def high_water(spark, d):
    x = X.table(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyyMMdd").alias("day"), F.lpad((F.col("l_partkey") % 240000).cast("string"), 6, "0").alias("clock"))
    return x.agg(F.max(F.struct("day", "clock")).alias("m")).select("m.day", "m.clock")


@query("A14_staged_max", X.with_(X.ORD, X.S) + "SELECT max(lpad(CAST(k AS VARCHAR), 12, '0')) AS staged FROM s")
def staged_max(spark, d):
    return X.stage(spark, d).agg(F.max(F.lpad(F.col("k").cast("string"), 12, "0")).alias("staged"))


@query("A15_group_report", "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1 ORDER BY 1")
def group_report(spark, d):
    o = X.table(spark, d, "orders").withColumn("p", F.col("o_totalprice").cast("decimal(18,2)"))
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("p").cast("double").alias("amount")).orderBy("o_orderpriority")


@query("P01_run_script", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey > 10 GROUP BY 1")
def run_script(spark, d):
    X.table(spark, d, "orders").createOrReplaceTempView("script_orders")
    return script.run_script(spark, "-- a; comment\nCREATE OR REPLACE TEMP VIEW script_some AS SELECT *, ';' AS semi FROM script_orders WHERE o_custkey > 10; SELECT o_orderstatus, count(*) AS n FROM script_some WHERE semi = ';' GROUP BY o_orderstatus;")


@query("P02_capped_query", "SELECT least(count(*), 101) AS row_count, count(*) > 100 AS truncated FROM lineitem WHERE l_quantity > 10")
def capped_query(spark, d):
    _, facts = script.capped(X.table(spark, d, "lineitem").where("l_quantity > 10").select("l_orderkey"), 100)
    return spark.createDataFrame([(facts["row_count"], facts["truncated"])], "row_count long, truncated boolean")


@query("P03_sanitize_columns", 'SELECT o_orderkey AS "ORDER_KEY", o_custkey AS "ORDER_KEY_2", o_orderstatus AS "C_1ST_STATUS" FROM orders')
def sanitize_columns(spark, d):
    o = X.table(spark, d, "orders")
    return script.sanitize_columns(o.select(F.col("o_orderkey").alias("order-key"), F.col("o_custkey").alias("Order Key"), F.col("o_orderstatus").alias("1st status")))


@query("P04_preview", "SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority FROM orders ORDER BY 1 LIMIT 50")
def preview(spark, d):
    return script.preview(X.table(spark, d, "orders"), 50, lambda t: t.select("o_orderkey", F.upper("o_orderpriority").alias("o_orderpriority")), ["o_orderkey"])


@query("X01_transform_view", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS doubled FROM orders")
def transform_view(spark, d):
    return X.table(spark, d, "orders").transform(lambda t: t.select("o_orderkey", (F.col("o_totalprice").cast("decimal(18,2)") * 2).alias("doubled")))


@query("P07_group_by_all", "WITH g AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS day) SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT day) AS days, count(o_orderkey) AS n FROM g LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(day AS DATE) GROUP BY ALL")
def group_by_all(spark, d):
    X.table(spark, d, "orders").createOrReplaceTempView("report_orders")
    return spark.sql("WITH g AS (SELECT explode(sequence(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS day) SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT day) AS days, count(o_orderkey) AS n FROM g LEFT JOIN report_orders ON CAST(o_orderdate AS DATE) = day GROUP BY ALL")


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    one = "SELECT '{c}' AS column_name, '{k}' AS column_type, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS most, count(DISTINCT {c}) AS n_distinct, {m} AS mean, {s} AS deviation, {q} count(*) AS n_rows, round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent FROM {t}"
    number = lambda k: k in ("int", "bigint")
    return " UNION ALL ".join(one.format(c=c, k=k, t=table, m=f"round(avg({c}), 6)" if number(k) else "NULL", s=f"round(stddev_samp({c}), 6)" if number(k) else "NULL", q=" ".join(f"CAST({f'quantile_disc({c}, 0.{p})' if number(k) else 'NULL'} AS DOUBLE) AS q{p}," for p in (25, 50, 75)).replace("0.50)", "0.5)")) for c, k in columns.items())


@query("P08_summarize", _profile_sql("(SELECT d.doc_id, lang, source, n_chars, quality FROM documents d LEFT JOIN labels USING (doc_id))", {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint", "quality": "bigint"}))
def summarize(spark, d):
    return script.summarize(X.table(spark, d, "documents").drop("text").join(X.table(spark, d, "labels").select("doc_id", F.col("quality").cast("bigint").alias("quality")), "doc_id", "left"))


@query("P09_ctas_roundtrip", "SELECT count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders")
def ctas_roundtrip(spark, d):
    import uuid

    name = f"ctas_{uuid.uuid4().hex}"
    X.table(spark, d, "orders").write.saveAsTable(name)
    return spark.table(name).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"))


@query("P10_stride_sample", "SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) WHERE rn % 97 = 0")
def stride_sample(spark, d):
    return script.stride_sample(X.table(spark, d, "orders"), ["o_orderkey"], 97).select("o_orderkey", "o_custkey")


@query("W05_stride_number", "SELECT k, row_number() OVER (ORDER BY k) AS rn FROM (SELECT o_orderkey AS k FROM orders)")
def stride_number(spark, d):
    return numbered(X.table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), ["k"], "rn")


@query("W07_period_carry", "WITH p AS (SELECT date_trunc('month', o_orderdate) AS m, CAST(max(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1) SELECT CAST(m AS DATE) AS month, lag(e) OVER (ORDER BY m) + 1 AS starts, e AS ends FROM p")
def period_carry(spark, d):
    p = X.table(spark, d, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.to_date(F.max("o_orderdate")).alias("e"))
    cuts = portions.by_fiscal(p.select(F.year("m").alias("fiscal_year"), F.month("m").alias("period"), F.col("e").alias("period_end")), None)
    return cuts.select(F.make_date("fiscal_year", "period", F.lit(1)).alias("month"), F.col("lo").alias("starts"), F.col("hi").alias("ends"))


@query("T02_top_score", "SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE), 6) AS score FROM embeddings ORDER BY embedding[1] DESC, vec_id LIMIT 50")
def top_score(spark, d):
    e = X.table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.element_at("embedding", 1).alias("x")).orderBy(F.desc("x"), "vec_id").limit(50).select("vec_id", "label", F.round(F.col("x").cast("double"), 6).alias("score"))
