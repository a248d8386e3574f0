"""Hand-written rows: merges, change capture, windows, guards."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import cdc, changelog, delta, merge, metrics, packages, quality
from tidemark.sources import loads, ordered, portions, sinks
from tidemark.sources.scratch import fresh_path
from tidemark.sources.store import Target

T = "id int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], T)


def test_upsert_matches_null_keys(spark, target):
    out = merge.apply_upsert(target, spark.createDataFrame([(None, "n2"), (3, "c")], T), ["id"])
    assert rows(out) == [(1, "a"), (2, "b"), (3, "c"), (None, "n2")]


def test_upsert_of_keys_only_inserts(spark):
    t = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(merge.apply_upsert(t, spark.createDataFrame([(1,), (2,), (None,)], "id int"), ["id"])) == [(1,), (2,), (None,)]


def test_merge_misses_and_unknown_operations(spark, target):
    c = spark.createDataFrame([(9, None, "d"), (8, "x", "u"), (1, "A", "I"), (2, None, "?")], T + ", op string")
    assert rows(merge.apply_merge(target, c, ["id"], "op")) == [(1, "A"), (2, "b"), (8, "x"), (None, "n")]


def test_snapshot_edges(spark, target):
    none = target.limit(0)
    assert merge.snapshot_merge(target, none, ["id"]).count() == 0
    assert rows(merge.snapshot_merge(none, target, ["id"])) == rows(target)
    assert merge.side_counts(target, none, ["id"]).first().asDict() == {"rows_ins": 0, "rows_upd": 0, "rows_del": 3}


def test_reload_guard(spark, target):
    with pytest.raises(ValueError):
        merge.refuse_empty_reload(target, target.limit(0))
    with pytest.raises(ValueError):
        merge.refuse_empty_reload(target, None)
    merge.refuse_empty_reload(target.limit(0), target.limit(0))
    with pytest.raises(ValueError):
        merge.refuse_duplicates(target.union(target), ["id"])


def test_cdc_coalesces(spark):
    t = spark.createDataFrame([(2, "b"), (3, "c")], T)
    log = spark.createDataFrame([(1, None, "D", 1), (1, "x", "I", 2), (2, "B", "U", 3), (3, "c", "I", 4), (3, None, "D", 5)], T + ", _op string, _seq long")
    assert rows(cdc.cdc_apply(t, log, ["id"], "image")) == [(1, "x"), (2, "B")]
    assert cdc.cdc_counts(t, cdc.coalesce_log(log, ["id"]), ["id"]).first().asDict() == {"rows_ins": 1, "rows_upd": 1, "rows_del": 1}
    assert rows(cdc.cdc_apply(t, log, ["id"], "image", after=3)) == [(2, "b")]
    with pytest.raises(ValueError):
        cdc.position(log, 9)
    assert cdc.position(log.limit(0), 9) == 9


def test_cdc_typed_keys_and_binary(spark):
    t = spark.createDataFrame([("001", 17, dt.date(2099, 12, 31), bytearray(b"\x01"))], "m string, c int, d date, p binary")
    log = spark.createDataFrame([("001", "0017", "20991231", "", "U", 1)], "m string, c string, d string, p string, _op string, _seq long")
    assert rows(cdc.cdc_apply(t, log, ["m", "c", "d"], "image")) == [("001", 17, dt.date(2099, 12, 31), None)]
    bad = log.withColumn("p", F.lit("zz"))
    with pytest.raises(Exception, match="hexadecimal"):
        cdc.cdc_apply(t, bad, ["m", "c", "d"], "image").collect()


def test_cdc_keys_mode(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], T)
    log = spark.createDataFrame([(1, "U", 1), (2, "D", 2), (3, "U", 3)], "id int, _op string, _seq long")
    images = spark.createDataFrame([(1, "A"), (2, "ghost")], T)  # 3 has vanished, 2 must not come back
    assert rows(cdc.cdc_apply(t, log, ["id"], "keys", images)) == [(1, "A")]
    with pytest.raises(ValueError):
        cdc.cdc_apply(t, log, ["id"], "keys", images.drop("v"))


def test_bounds_keep_late_commits():
    start = dt.datetime(2026, 9, 5, 12, 0, 0)
    assert delta.bounds("NUMTS", "20260905100000", 120, start) == delta.Bounds("20260905095800", None, "20260905115800")
    assert delta.bounds("DATE", "20260905", 1, start) == delta.Bounds("20260904", "20260905", "20260905")
    assert delta.bounds("DATE", "20260905", 1, start, reload=True).as_of is None
    assert delta.bounds("INT", "0010", 20, staged_max="0031") == delta.Bounds("0000", None, "0031")
    assert delta.forward("INT", "9", "10") == "10" and delta.forward("NUMTS", "20260102000000", "20260101000000") == "20260102000000"
    for bad in (lambda: delta.bounds("CHANGENR", None, 0, start), lambda: delta.bounds("NUMTS", None, 0), lambda: delta.check_target("DATE", ["k"], "micro:5"), lambda: delta.check_target("INT", [], "hourly"), lambda: delta.check_target("INT", ["k"], "hourly", "F", "CDC")):
        with pytest.raises(ValueError):
            bad()


def test_commits_count_once(spark):
    none = F.lit(None).cast("timestamp")
    t = Target(spark, fresh_path(spark, "t"), ["id"])
    t.create(spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("v")))
    c = spark.createDataFrame([(5, "x"), (200, "y"), (None, "z")], T)
    assert t.commit(1, c, none, F.current_timestamp(), "w1") == 3
    assert t.commit(1, c, none, F.current_timestamp(), "w1") == 0
    assert rows(t.log().select("id", "_op")) == [(200, "I"), (5, "U"), (None, "I")] and {r._seq for r in t.log().collect()} == {1, 2, 3}
    assert t.read().count() == 102 and t.state().watermark == "w1"
    quiet = t.state().rows
    t.commit(2, c.limit(0), none, F.current_timestamp(), "w2")
    assert t.state().watermark == "w2" and t.state().log_seq == 3 and t.state().rows == quiet
    t.commit(3, spark.createDataFrame([(5, "z")], T).select("id", "v"), none, F.current_timestamp())
    assert rows(t.log().where("_run_id = 3").select("id", "v", "_op", "_seq")) == [(5, "z", "U", 4)] and t.state().watermark == "w2"
    with pytest.raises(ValueError, match="occurs 2 times"):
        t.commit(4, c.union(c), none, F.current_timestamp())
    assert t.state().run_id == 3


def test_commit_of_some_columns_and_of_deletes(spark):
    none = F.lit(None).cast("timestamp")
    t = Target(spark, fresh_path(spark, "t"), ["id"])
    t.create(spark.createDataFrame([(1, "a", 7), (2, "b", 8)], T + ", w int"))
    t.commit(1, spark.createDataFrame([(2, "c"), (3, "d")], T), none, none)
    assert rows(t.read()) == [(1, "a", 7), (2, "c", 8), (3, "d", None)]
    gone = spark.createDataFrame([(i, None, None, "D") for i in (1, 2, 3)], T + ", w int, _op string")
    t.commit(2, gone, none, none, merge=lambda old, c: merge.apply_merge(old, c, ["id"], "_op"), log=False)
    assert rows(t.read()) == [] and t.read().columns == ["id", "v", "w"]


@pytest.mark.parametrize("dies", ["before the pointer", "while writing"])
def test_killed_commit_is_repeated(spark, monkeypatch, dies):
    none = F.lit(None).cast("timestamp")
    t = Target(spark, fresh_path(spark, "t"), ["id"])
    t.create(spark.createDataFrame([(1, "a")], T))
    c = spark.createDataFrame([(1, "b"), (2, "c")], T)
    with monkeypatch.context() as m:
        if dies == "while writing":
            bad = c.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("v")))
            with pytest.raises(Exception, match="killed"):
                t.commit(1, bad, none, F.current_timestamp())
        else:
            m.setattr(t, "_point", None)
            with pytest.raises(TypeError):
                t.commit(1, c, none, F.current_timestamp())
    assert rows(t.read()) == [(1, "a")] and t.log().count() == 0  # nothing of it is seen
    t.commit(1, c, none, F.current_timestamp())
    assert rows(t.read()) == [(1, "b"), (2, "c")]
    assert rows(t.log().select("id", "_op")) == [(1, "U"), (2, "I")]


def test_portions_hold_every_row_once(spark):
    df = spark.createDataFrame([(i % 7 if i % 5 else None,) for i in range(200)], "p long")
    for cuts in (portions.by_records(df, "p", 40), portions.by_width(df, "p", parts=3)):
        got = portions.assign_portion(df, "p", cuts)
        assert got.count() == 200 and got.where("portion_no is null").count() == 0 and got.where("portion_no = 0").count() == 40
    with pytest.raises(ValueError):
        portions.refuse_overlap(["P"], "p")


def greedy(counts, limit):
    out = []
    for v, n in sorted(counts.items()):
        if out and out[-1][2] + n <= limit:
            out[-1][1:] = [v, out[-1][2] + n]
        else:
            out.append([v, v, n])
    return [(i + 1, *x) for i, x in enumerate(out)]


def test_portions_of_many_values_are_exact(spark):
    df = spark.range(60_000).select(F.explode(F.array_repeat("id", F.expr("if(id % 1000 = 7, 30, 1 + id % 3)").cast("int"))).alias("p"))
    counts = {i: 30 if i % 1000 == 7 else 1 + i % 3 for i in range(60_000)}
    for limit in (25, 20_000, 10**9):
        assert sorted(map(tuple, portions.by_records(df, "p", limit).collect())) == greedy(counts, limit)


@pytest.mark.parametrize("kind", ["long", "date", "string"])
def test_portions_over_many_bins(spark, apart, kind):
    p = {"long": "id * 3 - 40", "date": "date_add(date'2020-01-01', cast(id as int))", "string": "concat('k', id)"}[kind]
    df = spark.range(60).select(F.expr(p).alias("p"), F.explode(F.array_repeat(F.lit(1), F.expr("if(id = 31, 90, 1 + id * 7 % 5)").cast("int"))).alias("x"))
    counts = {r.p: r.n for r in df.groupBy("p").agg(F.count("*").alias("n")).collect()}
    for limit in (1, 9, 50):
        assert sorted(map(tuple, portions.by_records(df.select("p"), "p", limit).collect())) == greedy(counts, limit)
    assert portions.by_records(df.limit(0), "p", 5).count() == 0


@pytest.fixture
def apart(spark):
    """Ranges stay apart, eleven of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def mixed(spark):
    """Rows with a hot value in the first column, and nulls."""
    return spark.range(1000).select(F.expr("if(id % 3 = 0, null, if(id % 10 < 8, 7, id % 50))").alias("a"), (F.col("id") * 7 % 1000).alias("k"))


def test_numbering_over_ranges(spark, apart):
    df = mixed(spark)
    for order in (["k"], ["a", "k"]):
        got = ordered.numbered(df, order, base=5).orderBy(*order).collect()
        assert [r._seq for r in got] == list(range(6, 1006))
    assert ordered.dealt(df, ["a", "k"]).select("_bin").distinct().count() > 5
    assert ordered.numbered(df.limit(0), ["k"]).count() == 0


def test_lag_over_ranges(spark, apart):
    df = mixed(spark).withColumn("v", F.when(F.col("k") % 4 != 0, F.col("k") * 2))
    got = {(r.a, r.k): (r._before_k, r._before_v) for r in ordered.lagged(df, ["a"], ["k"], ["k", "v"]).collect()}
    by = {}
    for r in sorted(df.collect(), key=lambda r: r.k):
        by.setdefault(r.a, []).append(r)
    want = {(a, r.k): (before.k, before.v) if before else (None, None) for a, own in by.items() for before, r in zip([None, *own], own)}
    assert got == want and len(got) == 1000
    assert ordered.lagged(df.limit(0), ["a"], ["k"], ["v"]).count() == 0


def test_values_carried_over_ranges(spark, apart):
    df = mixed(spark).withColumn("m", F.when(F.col("k").isin(130, 500, 501), F.col("k")))
    got = {r.k: r.c for r in ordered.carried(df, ["k"], "m", "c").collect()}
    assert got == {k: None if k < 130 else 130 if k < 500 else 500 if k < 501 else 501 for k in range(1000)}


def brute_quantile(values, p, interpolated):
    values = sorted(values)
    if not interpolated:
        return values[max(0, math.ceil(p * len(values) - 1e-9) - 1)]
    at = p * (len(values) - 1)
    lo = math.floor(at)
    return values[lo] + (at - lo) * (values[math.ceil(at)] - values[lo])


def test_quantiles_are_exact(spark, apart):
    df = mixed(spark).withColumn("n", F.col("k") % 5)
    by = {}
    for r in df.collect():
        by.setdefault(r.a, []).extend([r.k] * r.n)
    for interpolated in (False, True):
        got = ordered.quantiles(df, ["a"], "k", "n", {"x": 0.0, "y": 0.5, "z": 0.99, "w": 1.0}, interpolated)
        assert {r.a: (r.x, r.y, r.z, r.w) for r in got.collect()} == {a: tuple(brute_quantile(v, p, interpolated) for p in (0, 0.5, 0.99, 1)) for a, v in by.items() if v}
    assert ordered.quantiles(df.limit(0), ["a"], "k", "n", {"x": 0.5}).count() == 0


def test_percentiles_of_a_million_latencies(spark):
    at = F.timestamp_seconds(F.lit(1_600_000_000))
    log = spark.range(1_000_000).select(F.col("id").alias("k"), F.col("id").alias("_seq"), F.lit("U").alias("_op"), at.alias("_commit_ts"), (at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((F.col("id") * 7919 % 1_000_000 + 1) / 1000).cast("decimal(18,6)"))).alias("_applied_at"))
    r = metrics.latency_stats(log, ["k"]).first()
    assert (r.samples, float(r.p50), float(r.p95), float(r.p99), float(r.most)) == (1_000_000, 500.0, 950.0, 990.0, 1000.0)


def test_a_million_portions(spark):
    cuts = spark.range(1_000_000).select((F.col("id") + 1).alias("portion_no"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 4).alias("hi"))
    rows = portions.assign_portion(spark.range(0, 10_000_000, 5000).select(F.col("id").alias("p")).union(spark.range(9, 10_000_000, 5000)), "p", cuts)
    plan = rows._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert all(r.portion_no == (r.p // 10 + 1 if r.p % 10 < 5 else None) for r in rows.collect())


@pytest.mark.parametrize("kind", ["long", "date", "string", "timestamp", "decimal(12,2)"])
def test_assigning_by_ranges(spark, apart, kind):
    make = {"long": "id", "date": "date_add(date'2020-01-01', cast(id as int))", "string": "lpad(id, 4, '0')", "timestamp": "timestamp_seconds(id * 3600)", "decimal(12,2)": "cast(id / 4 as decimal(12,2))"}[kind]
    df = spark.range(100).select(F.when(F.col("id") % 9 != 0, F.expr(make)).alias("p"), "id")
    ends = [r[0] for r in spark.range(100).where("id in (10, 30, 31, 60)").select(F.expr(make)).orderBy("id").collect()]
    cuts = spark.createDataFrame([(2, ends[2], ends[3]), (1, ends[0], ends[1])], f"portion_no long, lo {kind}, hi {kind}")
    for half_open in (False, True):
        got = {r.id: r.portion_no for r in portions.assign_portion(df, "p", cuts, half_open).collect()}
        inside = lambda i, a, b: a <= i < b if half_open else a <= i <= b
        assert got == {i: 0 if i % 9 == 0 else 1 if inside(i, 10, 30) else 2 if inside(i, 31, 60) else None for i in range(100)}
    assert {r.portion_no for r in portions.assign_portion(df, "p", cuts.limit(0)).collect()} == {0, None}


def test_text_cells(spark):
    schema = spark.createDataFrame([], "a int, d date").schema
    ok = spark.createDataFrame([("1", "0000-00-00"), ("2", "    -  -  "), (None, None)], "A string, d string")
    assert rows(loads.ingest_typed_text(ok, schema)) == [(1, None), (2, None), (None, None)]
    with pytest.raises(Exception):
        loads.ingest_typed_text(spark.createDataFrame([("x", None)], "A string, d string"), schema).collect()
    with pytest.raises(ValueError):
        loads.select_columns(["a"], ["b"], ["a"])


def test_envelopes(spark):
    body = 'H1,"comma, and\nline",1.00,\\nH2,plain,-2.50,U\\n'.replace("\n", "\\n").replace('"', '\\"')
    head = '{"Encoding":"csv","Attributes":{"message.batchIndex":7,"message.lastBatch":true,"Content":{"Kind":"Table","Fields":[{"Name":"RID"},{"Name":"DESCR"},{"Name":"AMOUNT"},{"Name":"OP"}]}},"Body":"%s"}'
    raw = spark.createDataFrame([(head % body,)], "payload string")
    assert rows(packages.decode(raw, ["rid", "descr", "amount", "op"])) == [(7, 0, "H1", "comma, and\nline", "1.00", None), (7, 1, "H2", "plain", "-2.50", "U")]
    with pytest.raises(Exception, match="batch 7 row 0"):
        packages.decode(spark.createDataFrame([(head % "a,b\\n",)], "payload string"), ["rid"]).collect()
    with pytest.raises(ValueError):
        packages.refuse_stale(raw, 7)
    control = spark.createDataFrame([('{"Attributes":{"message.lastBatch":true}}',)], "payload string")
    assert packages.decode(control, ["rid"]).count() == 0 and packages.envelopes(control).first().last_batch


def test_validation_controls(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], T)
    tampered = spark.createDataFrame([(1, "x"), (2, "Y"), (None, "z")], T)
    assert quality.cell_diff(a, a, ["id"], ["v"]).count() == 0
    assert quality.cell_diff(a, tampered, ["id"], ["v"]).count() == 1
    assert quality.validate_full(a, a, ["id"], ["id", "v"]).first().status == "PASS"
    assert quality.validate_full(a.limit(0), a, ["id"], ["id", "v"]).first().status == "FAIL"
    drift = spark.createDataFrame([("x", "added", False), ("v", "removed", True)], "name string, change string, blocked boolean")
    assert quality.evolve(a, spark.createDataFrame([], T + ", x int").schema, drift).columns == a.columns


def test_latency_without_samples(spark):
    log = spark.createDataFrame([], "id long, _seq long, _op string, _commit_ts timestamp, _applied_at timestamp")
    stats = metrics.meets_target(metrics.latency_stats(log, ["id"]), 1, 1).first()
    assert stats.samples == 0 and stats.p95 is None and stats.meets is False


def test_retention_and_sinks(spark):
    with pytest.raises(ValueError):
        changelog.retain(spark.createDataFrame([(1,)], "_seq long"), [], None)
    assert sinks.parse_sink('parquet:"s3://a/b":full') == ("PARQUET", "s3://a/b", "FULL")
    assert sinks.parse_sink("TABLE:x") == ("TABLE", "x", "APPEND")
    for bad in ("CSV:x", "TABLE:x:MERGE", "nothing"):
        with pytest.raises(ValueError):
            sinks.parse_sink(bad)


def test_scalars(spark):
    df = spark.createDataFrame([("00012345678901234567890",), ("0",), ("",), (None,), ("A1",)], "v string")
    assert [r[0] for r in df.select(scalars.alpha_out("v")).collect()] == ["12345678901234567890", "0", "", None, "A1"]
    with pytest.raises(ValueError):
        scalars.with_currency(df, "v", "v", None)


def test_tokens_do_not_collide():
    made = {scalars.unique_token(n) for n in ("a.b", "a_b", "a-b", "A/B")}
    assert len(made) == 4 and scalars.unique_token("a_b") == "A_B"


def test_foreign_source(spark):
    """A query of another database over JDBC: columns and types come from its result."""
    with pytest.raises(Exception):
        loads.native_source(spark, "jdbc:none:x", "select 1")
    url = "jdbc:derby:memory:foreign;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    source = spark.createDataFrame([(1, "a", 2.5), (2, "b", -1.0), (3, "c", 0.25)], "K int, V string, AMOUNT double")
    source.write.format("jdbc").options(url=url, dbtable="ITEMS", createTableColumnTypes="V VARCHAR(9)", **driver).save()
    got = loads.native_source(spark, url, "SELECT NULLIF(V, 'b') AS V, COUNT(*) AS N, SUM(AMOUNT) AS S FROM ITEMS WHERE K > 1 GROUP BY V", **driver)
    assert got.columns == ["V", "N", "S"] and rows(got) == [("c", 1, 0.25), (None, 1, -1.0)]


@pytest.mark.parametrize("kind,half_open", [("long", False), ("date", True), ("timestamp", True), ("string", False)])
def test_parallel_load(spark, kind, half_open):
    """Every row lands once, in its portion's task; values with quotes, dates, times and nulls."""
    from tidemark.plans import scenarios

    make = {"long": "id", "date": "date_add(date'2020-02-27', cast(id as int))", "timestamp": "timestamp'2020-02-27 23:59:58.25' + make_interval(0, 0, 0, 0, 0, id)", "string": "concat('k', chr(39), lpad(id, 3, '0'))"}[kind]
    df = spark.range(60).select(F.col("id").alias("ID"), F.when(F.col("id") % 7 != 0, F.expr(make)).alias("P"))
    if kind == "string":  # the embedded database takes no null from Spark for texts
        df = df.where("P is not null")
    url, name, options = scenarios.foreign(spark, df, "P VARCHAR(20)" if kind == "string" else "")
    ends = {r.id: r[1] for r in spark.range(61).select("id", F.expr(make)).collect()}
    cuts = spark.createDataFrame([(1, ends[0], ends[20]), (2, ends[20 if half_open else 21], ends[60])], f"portion_no long, lo {kind}, hi {kind}")
    got = loads.parallel_load(spark, url, name, "P", cuts, half_open, **options)
    assert got.rdd.getNumPartitions() == 3
    first = lambda i: i < 20 if half_open else i <= 20
    assert {(r.ID, r.portion_no) for r in got.collect()} == {(i, 0 if i % 7 == 0 else 1 if first(i) else 2) for i in range(60) if i % 7 or kind != "string"}


def test_foreign_filter_is_pushed(spark, sf_dir):
    from tidemark.plans import loads as queries

    plan = queries.federated_query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"JDBCRelation.*PushedFilters: \[[^]]*EqualTo\(toxic,0\)", plan, re.I) and re.search(r"ReadSchema: struct<doc_id:bigint,quality:int>", plan, re.I) and "FileScan parquet" in plan


def test_registered_columns():
    merge.refuse_other_columns(["B", "a"], ["a", "b"])
    for subset in (["a"], ["a", "b", "c"], []):
        with pytest.raises(ValueError, match="registered"):
            merge.refuse_other_columns(subset, ["a", "b"])


def test_json_rows(spark):
    texts = [(1, '{"a": 1, "b": ["x"]}'), (2, '[{"a": 2}, {"b": []}]'), (3, None), (4, "[]"), (5, "nonsense"), (6, '{"a": "text"}')]
    got = loads.ingest_json(spark.createDataFrame(texts, "id int, body string"), "body", "a int, b array<string>")
    assert got.columns == ["id", "a", "b"]
    assert sorted([(r.id, r.a, r.b) for r in got.collect()], key=str) == sorted([(1, 1, ["x"]), (2, 2, None), (2, None, []), (3, None, None), (5, None, None), (6, None, None)], key=str)


def test_log_replay_gives_the_mirror(spark):
    none = F.lit(None).cast("timestamp")
    t0 = spark.createDataFrame([], T)
    log, mirror, base = None, t0, 0
    for i in range(3):
        c = spark.createDataFrame([((i * 3 + j * 2) % 7, f"{i}{j}") for j in range(4)], T)
        part = changelog.log_changes(mirror, c, ["id"], i, none, F.current_timestamp(), base)
        mirror, base = merge.apply_upsert(mirror, c, ["id"]), base + 4
        log = part if log is None else changelog.widen(log, part)
    assert rows(changelog.replay(log, ["id"])) == rows(mirror)


@pytest.mark.parametrize("kind", ["double", "string", "date", "timestamp"])
def test_few_and_many_portions_are_assigned_alike(spark, monkeypatch, kind):
    values = {"double": [-1.5, -0.0, 0.0, 2.0, 5.0, 7.5, float("nan"), float("inf")], "string": ["", "a", "a ", "b", "é", "z"]}.get(kind)
    values = values or [v[0] for v in spark.range(9).select(F.expr(f"cast(date_add(date'2020-02-26', cast(id as int)) as {kind})")).collect()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None, *values, None])], f"id int, p {kind}")
    for ends in ([(1, 2), (3, 5)], [(0, len(values) - 1)], [(4, 4), (1, 3)], []):
        cuts = spark.createDataFrame([(i + 1, values[a], values[b]) for i, (a, b) in enumerate(ends)] + [(9, None, None)], f"portion_no int, lo {kind}, hi {kind}")
        for half_open in (False, True):
            got = []
            for few in (portions.FEW, -1):
                monkeypatch.setattr(portions, "FEW", few)
                got.append(sorted(map(str, portions.assign_portion(df, "p", cuts, half_open).select("id", "portion_no").collect())))
                monkeypatch.undo()
            assert got[0] == got[1] and len(got[0]) == 2 * len(values) + 2


def test_few_portions_need_no_exchange_of_rows(spark):
    """Rows stay where they lie, so no task holds more of them than its part of the scan."""
    cuts = spark.createDataFrame([(i + 1, i * 10, i * 10 + 9) for i in range(portions.FEW + 1)], "portion_no long, lo long, hi long")
    plans = []
    for n in (0, 4, portions.FEW, portions.FEW + 1):
        got = portions.assign_portion(spark.range(5000).select(F.col("id").alias("p")), "p", cuts.limit(n))
        plans.append(got._jdf.queryExecution().executedPlan().toString())
        assert rows(got.groupBy("portion_no").count()) == rows(spark.createDataFrame([(i + 1, 10) for i in range(n)] + [(None, 5000 - 10 * n)], "portion_no long, count long"))
    assert [bool(re.search("rangepartitioning|hashpartitioning", p)) for p in plans] == [False, False, False, True]


def test_portions_are_written_without_a_sort(spark, sf_dir, monkeypatch):
    from tidemark.plans import loads as queries

    written = []
    monkeypatch.setattr(queries, "saved", lambda df, name: written.append(df) or df)
    queries.union_portions(spark, sf_dir)
    assert len(written) == 1 and not re.search(r"rangepartitioning|_bin|Sort \[(?!lo)", written[0]._jdf.queryExecution().executedPlan().toString())
