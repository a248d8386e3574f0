"""Queries of the merge algebra, change capture, the change log, watermark windows and publishing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cdc, changelog, delta, merge, packages
from ..sources import sinks
from ..sources.scratch import fresh_path, saved
from ..sources.store import Target
from . import scenarios as X
from .registry import query

K = ["k"]
BASE = X.with_(X.ORD, X.T, X.S, X.N, X.C)
CDC = X.with_(X.L, X.U, X.IMG, X.NET)
COLS = "k, cust, status, price, changed"


@query("M01_apply_insert", BASE + f"SELECT {COLS} FROM t UNION ALL SELECT {COLS} FROM c WHERE upper(_op) IN ('I', 'U')")
def apply_insert(spark, d):
    return merge.apply_insert(X.target(spark, d), X.changes(spark, d), "_op")


UPSERT = f"SELECT {COLS} FROM t WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT {COLS} FROM s"


@query("M02_apply_upsert", BASE + UPSERT)
def apply_upsert(spark, d):
    return merge.apply_upsert(X.target(spark, d), X.stage(spark, d), K)


@query("M02_upsert_partial", BASE + "SELECT coalesce(t.k, s.k) AS k, t.cust, CASE WHEN s.k IS NULL THEN t.status ELSE s.status END AS status, t.price, t.changed FROM t FULL JOIN s ON t.k = s.k")
def upsert_partial(spark, d):
    return merge.apply_upsert(X.target(spark, d), X.stage(spark, d).select("k", "status"), K)


MERGE = f"SELECT {COLS} FROM t WHERE k NOT IN (SELECT k FROM c) UNION ALL SELECT {COLS} FROM c WHERE _op <> 'D'"


@query("M03_apply_merge", BASE + MERGE)
def apply_merge(spark, d):
    return merge.apply_merge(X.target(spark, d), X.changes(spark, d), K, "_op")


@query("M04_snapshot_merge", BASE + "SELECT n.*, t.k * 2 AS own FROM n LEFT JOIN t USING (k)")
def snapshot_merge(spark, d):
    return merge.snapshot_merge(X.target(spark, d).withColumn("own", F.col("k") * 2), X.snapshot(spark, d), K)


@query("M05_commit_delta", BASE + UPSERT)
def commit_delta(spark, d):
    t = Target(spark, fresh_path(spark, "target"), K)
    t.create(X.target(spark, d))
    t.commit(1, X.stage(spark, d), delta.commit_ts("NUMTS", "changed"), F.current_timestamp(), "20010801000000")
    t.commit(2, X.stage(spark, d).limit(0), delta.commit_ts("NUMTS", "changed"), F.current_timestamp(), "20010802000000")
    return t.read().select(COLS.split(", "))


@query("M06_reload_replace", BASE + f"SELECT k, CAST(NULL AS BIGINT) AS cust, NULL AS status, NULL AS price, NULL AS changed, 'D' AS _op FROM t WHERE k NOT IN (SELECT k FROM n) UNION ALL SELECT {COLS}, 'I' FROM n")
def reload_replace(spark, d):
    return merge.reload_replace(X.target(spark, d), X.snapshot(spark, d), K)[1]


@query("M07_load_types", BASE + f"SELECT 'D' AS load_type, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price FROM ({UPSERT}) UNION ALL SELECT x, count(*), CAST(sum(price) AS DOUBLE) FROM s, (VALUES ('F'), ('L')) v(x) GROUP BY x")
def load_types(spark, d):
    t, s = X.target(spark, d), X.stage(spark, d)
    out = None
    for kind in ("D", "F", "L"):
        rows = merge.reload_replace(t, s, K)[0] if delta.load_plan(kind).truncates else merge.apply_upsert(t, s, K)
        rows = rows.agg(F.lit(kind).alias("load_type"), F.count("*").alias("n"), F.sum("price").cast("double").alias("price"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("J01_null_safe_join", "SELECT a.c AS c, a.n AS na, b.n AS nb FROM (SELECT nullif(o_custkey % 10, 3) AS c, count(*) AS n FROM orders GROUP BY 1) a JOIN (SELECT nullif(o_orderkey % 10, 3) AS c, count(*) AS n FROM orders GROUP BY 1) b ON a.c IS NOT DISTINCT FROM b.c")
def null_safe_join(spark, d):
    o = X.orders(spark, d)
    side = lambda c, n: o.groupBy(F.nullif(F.col(c) % 10, F.lit(3)).alias("c")).agg(F.count("*").alias(n))
    return side("cust", "na").alias("a").join(side("k", "nb").alias("b"), merge.same_keys(["c"])).select("a.c", "na", "nb")


@query("J02_side_counts", BASE + "SELECT count(*) FILTER (t.k IS NULL) AS rows_ins, count(*) FILTER (t.k IS NOT NULL AND n.k IS NOT NULL) AS rows_upd, count(*) FILTER (n.k IS NULL) AS rows_del FROM t FULL JOIN n ON t.k = n.k")
def side_counts(spark, d):
    return merge.side_counts(X.target(spark, d), X.snapshot(spark, d), K)


@query("J05_verdicts", BASE + "SELECT s.k, CASE WHEN t.k IS NULL THEN 'I' ELSE 'U' END AS _op FROM s LEFT JOIN t ON s.k = t.k")
def verdicts(spark, d):
    return merge.verdicts(X.target(spark, d), X.stage(spark, d), K).select("k", "_op")


@query("J06_typed_key_join", "SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderkey % 6 = 0")
def typed_key_join(spark, d):
    o = X.orders(spark, d)
    log = o.where("k % 6 = 0").select(F.lpad(F.col("k").cast("string"), 10, "0").alias("k"))
    return merge.semi(o, cdc.typed_log(log, o, K), K).select("k", "status")


@query("P05_strip_control", BASE + f"SELECT {COLS} FROM s")
def strip_control(spark, d):
    return changelog.strip_control(changelog.log_changes(X.target(spark, d), X.stage(spark, d), K, 1, F.lit(None).cast("timestamp"), F.current_timestamp()))


@query("P06_common_columns", BASE + "SELECT k, status, price FROM s")
def common_columns(spark, d):
    s = X.stage(spark, d).select("price", "status", "k").withColumn("more", F.lit(1)).toDF("PRICE", "Status", "K", "more")
    return s.select([F.col(c).alias(c) for c in merge.common_columns(s, X.target(spark, d))])


# -- change capture ---------------------------------------------------------------------------------


@query("W01_coalesce", CDC + "SELECT * FROM net")
def coalesce(spark, d):
    return cdc.coalesce_log(X.cdc_log(spark, d), K)


@query("W03_net_keys", CDC + "SELECT k FROM net WHERE _op <> 'D'")
def net_keys(spark, d):
    return cdc.net_keys(X.cdc_log(spark, d), K)


@query("T04_ordered_log", X.with_(X.L) + "SELECT * FROM l WHERE _seq > 500 ORDER BY _seq")
def ordered_log(spark, d):
    return X.cdc_log(spark, d).where("_seq > 500").orderBy("_seq")


@query("M09_cdc_delete", CDC + "SELECT * FROM u WHERE k NOT IN (SELECT k FROM net WHERE _op = 'D')")
def cdc_delete(spark, d):
    return cdc.cdc_apply(X.cdc_target(spark, d), X.cdc_log(spark, d), K, "delete")


IMAGE = "SELECT k, v FROM u WHERE k NOT IN (SELECT k FROM net) UNION ALL SELECT k, v FROM net WHERE _op <> 'D'"


@query("M10_cdc_image", CDC + IMAGE)
def cdc_image(spark, d):
    log = X.cdc_log(spark, d).withColumn("k", F.lpad(F.col("k").cast("string"), 10, "0"))  # keys as padded text, as logs hold them
    return cdc.cdc_apply(X.cdc_target(spark, d), log, K, "image")


@query("M11_cdc_keys", CDC + "SELECT * FROM u WHERE k NOT IN (SELECT k FROM net) UNION ALL SELECT i.k, i.v FROM i JOIN net ON i.k = net.k WHERE _op <> 'D'")
def cdc_keys(spark, d):
    return cdc.cdc_apply(X.cdc_target(spark, d), X.cdc_log(spark, d), K, "keys", X.cdc_images(spark, d))


@query("J03_images_of_net_keys", CDC + "SELECT i.k, i.v FROM i JOIN net ON i.k = net.k WHERE _op <> 'D'")
def images_of_net_keys(spark, d):
    return merge.semi(X.cdc_images(spark, d), cdc.net_keys(X.cdc_log(spark, d), K), K)


@query("J04_vanished_keys", CDC + "SELECT k FROM net WHERE _op <> 'D' AND k NOT IN (SELECT k FROM i)")
def vanished_keys(spark, d):
    return cdc.vanished(cdc.coalesce_log(X.cdc_log(spark, d), K), X.cdc_images(spark, d), K)


@query("M12_cdc_counts", CDC + ", e AS (SELECT net.k, CASE WHEN _op = 'D' OR i.k IS NULL THEN 'D' ELSE 'X' END AS o, u.k IS NOT NULL AS here FROM net LEFT JOIN i ON net.k = i.k LEFT JOIN u ON net.k = u.k) SELECT count(*) FILTER (o = 'X' AND NOT here) AS rows_ins, count(*) FILTER (o = 'X' AND here) AS rows_upd, count(*) FILTER (o = 'D' AND here) AS rows_del FROM e")
def cdc_counts(spark, d):
    return cdc.cdc_counts(X.cdc_target(spark, d), cdc.coalesce_log(X.cdc_log(spark, d), K), K, X.cdc_images(spark, d))


@query("M13_cdc_position", "SELECT max(event_id) AS position FROM events")
def cdc_position(spark, d):
    return spark.createDataFrame([(cdc.position(X.cdc_log(spark, d), 3),)], "position long")


CHANGED = "SELECT o_custkey AS objectid, strftime(o_orderdate, '%Y%m%d') AS udate, lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') AS utime, o_orderkey AS number FROM orders"


def _headers(spark, d):
    o = X.table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("objectid"), F.date_format("o_orderdate", "yyyyMMdd").alias("udate"), F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0").alias("utime"), F.col("o_orderkey").alias("number"))


@query("M14_changedoc_delta", f"WITH h AS ({CHANGED}), o AS (SELECT DISTINCT objectid FROM h WHERE udate > '20000101' OR (udate = '20000101' AND utime > '000100')), b AS (SELECT c_custkey AS k, 'old' AS seg FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_custkey IN (SELECT objectid FROM o)) SELECT * FROM b WHERE k NOT IN (SELECT k FROM n) UNION ALL SELECT * FROM n")
def changedoc_delta(spark, d):
    c = X.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    return cdc.changedoc_delta(c.where("k % 2 = 0").withColumn("seg", F.lit("old")), c, _headers(spark, d), ("20000101", "000100"), K, "k")


@query("M15_insert_only_delta", f"WITH h AS ({CHANGED}), b AS (SELECT l_orderkey AS number, l_linenumber AS line, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT number, line, n FROM b WHERE number % 3 = 0 OR number IN (SELECT number FROM h WHERE udate > '20000101')")
def insert_only_delta(spark, d):
    items = X.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("number"), F.col("l_linenumber").alias("line")).agg(F.count("*").alias("n"))
    return cdc.insert_only_delta(items.where("number % 3 = 0"), items, _headers(spark, d), ("20000101", "999999"), ["number", "line"], "number")


# -- packages ----------------------------------------------------------------------------------------


def _part(spark, d):
    return X.table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.concat_ws(", ", "p_name", "p_brand").alias("name"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"))


def _packages(spark, d):
    """part in envelopes of 500 rows, names quoted, with an operation; the last is marked."""
    p = _part(spark, d)
    cell = F.concat_ws(",", F.col("k").cast("string"), F.concat(F.lit('"'), F.replace("name", F.lit('"'), F.lit('""')), F.lit(' ""x""\n"')), F.col("price").cast("string"), F.when(F.col("k") % 5 == 0, "D").when(F.col("k") % 5 == 1, "").otherwise("U"))
    b = p.groupBy(F.floor(F.col("k") / 500).alias("b")).agg(F.concat_ws("\n", F.array_sort(F.collect_list(cell))).alias("body"))
    last = b.agg(F.max("b").alias("m"))
    head = F.concat(F.lit('{"Encoding":"csv","Attributes":{"message.batchIndex":'), F.col("b").cast("string"), F.lit(',"message.lastBatch":'), (F.col("b") == F.col("m")).cast("string"))
    kind = ',"Content":{"Kind":"Table","Fields":[{"Name":"K"},{"Name":"NAME"},{"Name":"PRICE"},{"Name":"OPER"}]}},"Body":'
    body = F.regexp_replace(F.to_json(F.struct("body")), r'^\{"body":|\}$', "")
    return b.join(F.broadcast(last)).select(F.concat(head, F.lit(kind), body, F.lit("}")).alias("payload"))


PART = """p AS (SELECT p_partkey AS k, p_name || ', ' || p_brand || ' "x"' || chr(10) AS name, CAST(p_retailprice AS DECIMAL(10,2)) AS price, CASE p_partkey % 5 WHEN 0 THEN 'D' WHEN 1 THEN NULL ELSE 'U' END AS oper FROM part), b AS (SELECT p_partkey AS k, 'old' AS name, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part WHERE p_partkey % 3 = 0)"""


@query("S08_decode_packages", f"WITH {PART} SELECT k // 500 AS batch_index, CAST(k AS VARCHAR) AS k, name, CAST(price AS VARCHAR) AS price, oper FROM p")
def decode_packages(spark, d):
    return packages.decode(_packages(spark, d), ["k", "name", "price", "oper"]).drop("row_no")


@query("M16_package_full", f"WITH {PART} SELECT k, name, price FROM p")
def package_full(spark, d):
    old = _part(spark, d).where("k % 3 = 0").withColumn("name", F.lit("old"))
    return packages.package_full(old, _packages(spark, d), K)


DELTA = "SELECT k, name, price FROM b WHERE k NOT IN (SELECT k FROM p WHERE {w}) UNION ALL SELECT k, name, price FROM p WHERE {w} AND coalesce(oper, 'U') <> 'D'"


@query("M17_package_delta", f"WITH {PART} " + DELTA.format(w="true"))
def package_delta(spark, d):
    old = _part(spark, d).where("k % 3 = 0").withColumn("name", F.lit("old"))
    return packages.package_delta(old, _packages(spark, d), K, "oper")


@query("M18_package_replay", f"WITH {PART} " + DELTA.format(w="k // 500 > 0"))
def package_replay(spark, d):
    raw = saved(_packages(spark, d), "bronze")
    once = packages.package_delta(_part(spark, d).where("k % 3 = 0").withColumn("name", F.lit("old")), raw, K, "oper", 0)
    return packages.package_delta(once, raw, K, "oper", 0)


@query("M19_idempotent_replay", BASE + MERGE)
def idempotent_replay(spark, d):
    once = merge.apply_merge(X.target(spark, d), X.changes(spark, d), K, "_op")
    return merge.apply_merge(once, X.changes(spark, d), K, "_op")


# -- watermark windows --------------------------------------------------------------------------------

START = dt.datetime(2000, 6, 1, 12, 0, 0)


def _keys_in(spark, d, kind, column, mark, safety, time_column=None):
    o = X.orders(spark, d).withColumns({"day": F.substring("changed", 1, 8), "clock": F.substring("changed", 9, 6), "tsl": F.concat("changed", F.lit(".0000005")), "counter": F.lpad(F.col("k").cast("string"), 10, "0")})
    b = delta.bounds(kind, mark, safety, START)
    return o.where(delta.predicate(kind, b, column, time_column)).select("k", F.lit(b.next_watermark).alias("next_watermark"))


@query("K01_numts", X.with_(X.ORD) + "SELECT k, '20000601115800' AS next_watermark FROM ord WHERE changed > '19991231235800'")
def k_numts(spark, d):
    return _keys_in(spark, d, "NUMTS", "changed", "20000101000000", 120)


@query("K02_timestampl", X.with_(X.ORD) + "SELECT k, '20000601115900.0000000' AS next_watermark FROM ord WHERE changed || '.0000005' > '19991231235900.1234567'")
def k_timestampl(spark, d):
    return _keys_in(spark, d, "TIMESTAMPL", "tsl", "20000101000000.1234567", 60)


@query("K03_date", X.with_(X.ORD) + "SELECT k, '20000531' AS next_watermark FROM ord WHERE substr(changed, 1, 8) > '19991230' AND substr(changed, 1, 8) < '20000601'")
def k_date(spark, d):
    return _keys_in(spark, d, "DATE", "day", "20000101", 90000)


@query("K04_datetime", X.with_(X.ORD) + "SELECT k, '20000601115900' AS next_watermark FROM ord WHERE substr(changed, 1, 8) > '19991231' OR (substr(changed, 1, 8) = '19991231' AND substr(changed, 9, 6) > '235900')")
def k_datetime(spark, d):
    return _keys_in(spark, d, "DATETIME", "day", "20000101000000", 60, "clock")


@query("K05_int", X.with_(X.ORD) + "SELECT k, '0000000100' AS next_watermark FROM ord WHERE k > 95")
def k_int(spark, d):
    return _keys_in(spark, d, "INT", "counter", "0000000100", 5)


@query("K08_read_predicate", X.with_(X.ORD) + "SELECT k FROM ord WHERE substr(changed, 1, 8) > '19991231' AND substr(changed, 1, 8) < '20000601' AND (status = 'F' OR cust < 50)")
def k_predicate(spark, d):
    o = X.orders(spark, d).withColumn("day", F.substring("changed", 1, 8))
    return o.where(delta.predicate("DATE", delta.bounds("DATE", "20000101", 1, START), "day") & ((F.col("status") == "F") | (F.col("cust") < 50))).select("k")


@query("K10_commit_ts", X.with_(X.ORD) + "SELECT k, strftime(strptime(changed, '%Y%m%d%H%M%S') + INTERVAL 7 SECOND, '%Y-%m-%d %H:%M:%S') AS pair, strftime(strptime(changed, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS numts, strftime(strptime(substr(changed, 1, 8), '%Y%m%d') + INTERVAL 7 SECOND, '%Y-%m-%d %H:%M:%S') AS day FROM ord")
def k_commit_ts(spark, d):
    o = X.orders(spark, d).withColumns({"day": F.substring("changed", 1, 8), "clock": F.substring("changed", 9, 6)})
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return o.select("k", text(delta.commit_ts("DATETIME", "day", "clock", 7)).alias("pair"), text(delta.commit_ts("NUMTS", "changed")).alias("numts"), text(delta.commit_ts("DATE", "day", None, 7)).alias("day"))


# -- change log, publishing ---------------------------------------------------------------------------


@query("C01_log_changes", BASE + "SELECT s.k, s.price, row_number() OVER (ORDER BY s.k) + 10 AS _seq, CASE WHEN t.k IS NULL THEN 'I' ELSE 'U' END AS _op, CAST(4 AS BIGINT) AS _run_id FROM s LEFT JOIN t ON s.k = t.k")
def log_changes(spark, d):
    log = changelog.log_changes(X.target(spark, d), X.stage(spark, d), K, 4, delta.commit_ts("NUMTS", "changed"), F.current_timestamp(), 10)
    return log.select("k", "price", "_seq", "_op", "_run_id")


@query("W08_sequence", "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) + 7 AS _seq FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)")
def sequence(spark, d):
    rows = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    return changelog.numbered(rows, ["l_orderkey", "l_linenumber", "l_partkey"], base=7)


GONE = "x AS (SELECT k FROM net WHERE _op = 'D' UNION ALL SELECT k FROM net WHERE _op <> 'D' AND k NOT IN (SELECT k FROM i))"


@query("C02_log_deletes", CDC + ", " + GONE + " SELECT k, NULL AS v, 'D' AS _op, row_number() OVER (ORDER BY k) AS _seq FROM u WHERE k IN (SELECT k FROM x)")
def log_deletes(spark, d):
    t, net = X.cdc_target(spark, d), cdc.coalesce_log(X.cdc_log(spark, d), K)
    return changelog.log_deletes(t, cdc.effective_deletes(t, net, X.cdc_images(spark, d), K), K, 1, F.current_timestamp()).select("k", "v", "_op", "_seq")


@query("U01_union_by_name", CDC + ", " + GONE + " SELECT k, count(*) AS n FROM x GROUP BY k")
def union_deletes(spark, d):
    net = cdc.coalesce_log(X.cdc_log(spark, d), K)
    rows = net.where("_op = 'D'").select("k").unionByName(cdc.vanished(net, X.cdc_images(spark, d), K), allowMissingColumns=True)
    return rows.groupBy("k").agg(F.count("*").alias("n"))


@query("C03_widen_log", BASE + "SELECT k, price, NULL AS extra FROM s WHERE k % 8 = 0 UNION ALL SELECT k, price, 'new' FROM s WHERE k % 8 <> 0")
def widen_log(spark, d):
    s = X.stage(spark, d).select("k", "price")
    path = fresh_path(spark, "log")
    s.where("k % 8 = 0").write.parquet(f"{path}/_run_id=1")
    s.where("k % 8 <> 0").withColumn("extra", F.lit("new")).write.parquet(f"{path}/_run_id=2")
    return spark.read.option("mergeSchema", "true").parquet(path).select("k", "price", "extra")


@query("C04_replay_log", BASE + UPSERT)
def replay_log(spark, d):
    t, s = X.target(spark, d), X.stage(spark, d)
    none = F.lit(None).cast("timestamp")
    first = changelog.log_changes(t.limit(0), t, K, 1, none, F.current_timestamp())
    second = changelog.log_changes(t, s, K, 2, none, F.current_timestamp(), 100_000_000)
    return changelog.replay(changelog.widen(first, second), K).select(COLS.split(", "))


@query("W02_subscription_dedup", CDC + "SELECT k, v, _seq FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY _seq DESC) AS rn FROM l WHERE _seq > 100 AND _seq <= 900) WHERE rn = 1")
def subscription_dedup(spark, d):
    return changelog.batch(X.cdc_log(spark, d), 100, 900, K).select("k", "v", "_seq")


@query("C05_publish_parquet", BASE + "SELECT status, count(*) AS n, CAST(sum(price) AS DOUBLE) AS price FROM s GROUP BY 1")
def publish_parquet(spark, d):
    path = fresh_path(spark, "published")
    for _ in range(2):
        sinks.publish_parquet(X.stage(spark, d), path, "FULL", ["status"])
    return spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("n"), F.sum("price").cast("double").alias("price"))


@query("C06_publish_table", BASE + "SELECT k, count(*) AS n FROM (SELECT k FROM s UNION ALL SELECT k FROM t WHERE k % 4 = 1) GROUP BY k")
def publish_table(spark, d):
    import uuid

    name = f"published_{uuid.uuid4().hex}"
    sinks.publish(X.target(spark, d), f"TABLE:{name}:FULL")
    sinks.publish(X.stage(spark, d), f"TABLE:{name}:FULL")
    sinks.publish(X.target(spark, d).where("k % 4 = 1"), f"TABLE:{name}:APPEND")
    return spark.table(name).groupBy("k").agg(F.count("*").alias("n"))


@query("C08_subscription_advance", X.with_(X.L) + "SELECT k, _seq, _op FROM l WHERE _seq > 50")
def subscription_advance(spark, d):
    path, log, at = fresh_path(spark, "sub"), X.cdc_log(spark, d), 50
    for top in (400, 100_000_000):
        at = sinks.subscription_advance(spark, log.where(F.col("_seq") <= top), f'PARQUET:"{path}"', at)
    return spark.read.parquet(path).select("k", "_seq", "_op")


@query("C09_retain", X.with_(X.LAT) + "SELECT k, _seq FROM g WHERE NOT (_seq <= 300 AND _applied_at < (SELECT min(_applied_at) + INTERVAL 1 DAY FROM g))")
def retain(spark, d):
    log = X.latency_log(spark, d)
    edge = log.agg((F.min("_applied_at") + F.expr("interval 1 day")).alias("edge")).scalar()  # one row, within the same query
    return changelog.retain(log, [300, 900], edge).select("k", "_seq")


@query("C10_change_latency", X.with_(X.LAT) + "SELECT k, _seq, CAST(epoch_ms(_applied_at) - epoch_ms(_commit_ts) AS BIGINT) AS ms FROM g WHERE k = 7")
def change_latency(spark, d):
    log = X.latency_log(spark, d).where("k = 7")
    return log.select("k", "_seq", (F.unix_millis("_applied_at") - F.unix_millis("_commit_ts")).alias("ms")).orderBy("_seq")


# -- scalar functions ---------------------------------------------------------------------------------

TEXTS = """x AS (SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'A' || o_orderkey WHEN 3 THEN '000' ELSE '00' || o_orderkey END AS v,
 CASE o_orderkey % 5 WHEN 0 THEN '00000000' WHEN 1 THEN '20231345' WHEN 2 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS dats,
 CASE o_orderkey % 5 WHEN 0 THEN '000000' WHEN 1 THEN '256199' WHEN 2 THEN '' ELSE lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '3059' END AS tims, CASE o_orderkey % 3 WHEN 0 THEN 'X' WHEN 1 THEN ' ' END AS f FROM orders)"""


def _texts(spark, d):
    o = X.table(spark, d, "orders")
    k = F.col("o_orderkey")
    t = k.cast("string")
    return o.select(
        k.alias("k"), F.when(k % 7 == 0, None).when(k % 7 == 1, "").when(k % 7 == 2, F.concat(F.lit("A"), t)).when(k % 7 == 3, "000").otherwise(F.concat(F.lit("00"), t)).alias("v"),
        F.when(k % 5 == 0, "00000000").when(k % 5 == 1, "20231345").when(k % 5 == 2, None).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("dats"),
        F.when(k % 5 == 0, "000000").when(k % 5 == 1, "256199").when(k % 5 == 2, "").otherwise(F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit("3059"))).alias("tims"),
        F.when(k % 3 == 0, "X").when(k % 3 == 1, " ").alias("f"),
    )


@query("F01_alpha_in", f"WITH {TEXTS} SELECT k, CASE WHEN regexp_full_match(v, '[0-9]+') AND length(v) < 10 THEN lpad(v, 10, '0') ELSE v END AS v FROM x")
def f_alpha_in(spark, d):
    return _texts(spark, d).select("k", scalars.alpha_in("v", 10).alias("v"))


@query("F02_alpha_out", f"WITH {TEXTS} SELECT k, CASE WHEN regexp_full_match(v, '[0-9]+') THEN CAST(CAST(v AS HUGEINT) AS VARCHAR) ELSE v END AS v FROM x")
def f_alpha_out(spark, d):
    return _texts(spark, d).select("k", scalars.alpha_out("v").alias("v"))


@query("F03_flag", f"WITH {TEXTS} SELECT k, coalesce(f = 'X', false) AS f FROM x")
def f_flag(spark, d):
    scalars.register(spark)
    return _texts(spark, d).select("k", F.expr("flag_x(f)").alias("f"))


@query("F04_text_date", f"WITH {TEXTS} SELECT k, CAST(try_strptime(dats, '%Y%m%d') AS DATE) AS day FROM x")
def f_text_date(spark, d):
    return _texts(spark, d).select("k", scalars.text_date("dats").alias("day"))


@query("F05_text_time", f"WITH {TEXTS} SELECT k, strftime(try_strptime(tims, '%H%M%S'), '%H:%M:%S') AS clock FROM x")
def f_text_time(spark, d):
    return _texts(spark, d).select("k", scalars.text_time("tims").alias("clock"))


CURR = "y AS (SELECT n_nationkey, CASE WHEN n_nationkey % 6 <> 5 THEN n_nationkey % 4 END AS dec FROM nation)"


@query("F06_curr_decimals", f"WITH {CURR} SELECT c_custkey, coalesce(dec, 2) AS curr_decimals FROM customer JOIN y ON n_nationkey = c_nationkey")
def f_curr_decimals(spark, d):
    return _amounts(spark, d).select("c_custkey", "curr_decimals")


@query("F07_curr_amount", f"WITH {CURR} SELECT c_custkey, CAST(CAST(CAST(c_acctbal AS DECIMAL(20,2)) * CASE coalesce(dec, 2) WHEN 0 THEN 100 WHEN 1 THEN 10 WHEN 2 THEN 1 ELSE CAST(0.1 AS DECIMAL(3,1)) END AS DECIMAL(30,5)) AS DOUBLE) AS curr_amount FROM customer JOIN y ON n_nationkey = c_nationkey")
def f_curr_amount(spark, d):
    return _amounts(spark, d).select("c_custkey", F.col("curr_amount").cast("double").alias("curr_amount"))


@query("J09_currency_join", f"WITH {CURR} SELECT coalesce(dec, 2) AS curr_decimals, count(*) AS n FROM customer JOIN y ON n_nationkey = c_nationkey GROUP BY 1")
def currency_join(spark, d):
    return _amounts(spark, d).groupBy("curr_decimals").agg(F.count("*").alias("n"))


def _amounts(spark, d):
    listed = X.table(spark, d, "nation").where("n_nationkey % 6 <> 5").select(F.col("n_nationkey").alias("currkey"), (F.col("n_nationkey") % 4).alias("currdec"))
    return scalars.with_currency(X.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), "c_acctbal", "c_nationkey", listed)


@query("F08_initial_date", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def f_initial_date(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, "0000-00-00").when(k % 3 == 1, "    -  -  ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return X.table(spark, d, "orders").select(k.alias("k"), scalars.initial_date(text).alias("day"))


@query("F09_coerce", "SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 2 = 0 THEN hex(o_orderstatus) END AS raw, CAST(o_orderkey AS INTEGER) AS number FROM orders")
def f_coerce(spark, d):
    k = F.col("o_orderkey")
    t = X.table(spark, d, "orders").select(k.alias("k"), F.date_format("o_orderdate", "yyyyMMdd").alias("a"), F.when(k % 2 == 0, F.hex("o_orderstatus")).otherwise("").alias("b"), F.lpad(k.cast("string"), 10, "0").alias("c"))
    return t.select("k", scalars.coerce("a", "string", "date").alias("day"), F.hex(scalars.coerce("b", "string", "binary")).alias("raw"), scalars.coerce("c", "string", "int").alias("number"))


@query("F10_numts", "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m%d%H%M%S') AS v, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS back FROM orders")
def f_numts(spark, d):
    t = X.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), scalars.format_numts("o_orderdate").alias("v"))
    return t.withColumn("back", F.date_format(scalars.parse_numts("v"), "yyyy-MM-dd HH:mm:ss"))


@query("F11_shift_padded", "SELECT o_orderkey AS k, lpad(CAST(greatest(0, o_orderkey - 25) AS VARCHAR), 8, '0') AS v FROM orders")
def f_shift_padded(spark, d):
    k = F.col("o_orderkey")
    return X.table(spark, d, "orders").select(k.alias("k"), scalars.shift_padded(F.lpad(k.cast("string"), 8, "0"), -25).alias("v"))


@query("F13_format_lag", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN 'never' WHEN o_orderkey < 60 THEN o_orderkey || 's' WHEN o_orderkey < 3600 THEN (o_orderkey // 60) || 'm' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || 's' ELSE (o_orderkey // 3600) || 'h' || lpad(CAST(o_orderkey % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END AS lag FROM orders")
def f_format_lag(spark, d):
    k = F.col("o_orderkey")
    return X.table(spark, d, "orders").select(k.alias("k"), scalars.format_lag(F.when(k % 9 != 0, k)).alias("lag"))


@query("F14_cadence", "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 3600 WHEN 1 THEN 86400 WHEN 2 THEN o_orderkey ELSE 0 END AS seconds FROM orders")
def f_cadence(spark, d):
    k = F.col("o_orderkey")
    c = F.when(k % 4 == 0, "HOURLY").when(k % 4 == 1, "nightly").when(k % 4 == 2, F.concat(F.lit("micro:"), k.cast("string"))).otherwise("manual")
    return X.table(spark, d, "orders").select(k.alias("k"), scalars.cadence_seconds(c).alias("seconds"))


