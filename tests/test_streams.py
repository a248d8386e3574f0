"""Streams restarted from their checkpoint, and properties over seeded random batches."""

import random

from pyspark.sql import functions as F

from tidemark.operators import cdc, merge, packages
from tidemark.sources.scratch import fresh_path
from tidemark.sources.store import Target
from tidemark.streaming import streams

LOG = "id int, v string, _seq long, _op string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def log_rows(seed, n, base=0):
    r = random.Random(seed)
    return [(r.randint(0, 9), f"v{base + i}", base + i, r.choice("IUDu")) for i in range(n)]


def test_stream_goes_on_from_its_checkpoint(spark):
    path, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "checkpoint")
    t = Target(spark, fresh_path(spark, "target"), ["id"])
    t.create(spark.createDataFrame([(3, "seed", -1, "I"), (77, "seed", -1, "I")], LOG))
    everything = []
    for part in (log_rows(1, 20), log_rows(2, 15, 20), []):
        everything += part
        if part:
            spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(path)
        streams.stream_cdc(spark.readStream.schema(LOG).parquet(path), t, checkpoint)
        start = spark.createDataFrame([(3, "seed"), (77, "seed")], "id int, v string")
        want = cdc.cdc_apply(start, spark.createDataFrame(everything, LOG), ["id"], "image")
        assert rows(streams.read_live(t)) == rows(want)


def test_files_out_of_order_do_not_bring_back_old_rows(spark):
    path = fresh_path(spark, "log")
    t = Target(spark, fresh_path(spark, "target"), ["id"])
    t.create(spark.createDataFrame([], LOG).union(spark.createDataFrame([(0, "z", -1, "I")], LOG)))
    checkpoint = fresh_path(spark, "checkpoint")
    for part in ([(1, "new", 9, "U")], [(1, "old", 3, "U"), (2, "gone", 4, "D")]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(path)
        streams.stream_cdc(spark.readStream.schema(LOG).parquet(path), t, checkpoint)
    assert rows(streams.read_live(t)) == [(0, "z"), (1, "new")]


def test_random_batches_are_idempotent(spark):
    target = spark.createDataFrame([(i, "a") for i in range(0, 10, 2)], "id int, v string")
    for seed in range(4):
        log = spark.createDataFrame(log_rows(seed, 25), LOG)
        for mode in ("image", "delete"):
            once = cdc.cdc_apply(target, log, ["id"], mode)
            assert rows(cdc.cdc_apply(once, log, ["id"], mode)) == rows(once)
        changes = cdc.coalesce_log(log, ["id"]).drop("_seq")
        once = merge.apply_merge(target, changes, ["id"], "_op")
        assert rows(merge.apply_merge(once, changes, ["id"], "_op")) == rows(once)
        state = dict(rows(target))
        for i, v, _, op in sorted(log_rows(seed, 25), key=lambda x: x[2]):
            state.pop(i, None)
            if op.upper() != "D":
                state[i] = v
        assert dict(rows(once)) == state


def test_subscriptions_are_independent(spark):
    path, a, b = fresh_path(spark, "log"), fresh_path(spark, "a"), fresh_path(spark, "b")
    spark.createDataFrame(log_rows(1, 5), LOG).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema(LOG).parquet(path)
    ca, cb = fresh_path(spark, "ca"), fresh_path(spark, "cb")
    streams.stream_log_to_sink(stream(), f'PARQUET:"{a}"', ca)
    spark.createDataFrame(log_rows(2, 5, 5), LOG).write.mode("append").parquet(path)
    streams.stream_log_to_sink(stream(), f'PARQUET:"{a}"', ca)
    streams.stream_log_to_sink(stream(), f'PARQUET:"{b}"', cb)
    assert spark.read.parquet(a).count() == 10 and rows(spark.read.parquet(a).select(F.col("_seq"))) == rows(spark.read.parquet(b).select(F.col("_seq")))


def package(number, cells):
    import json

    fields = [{"Name": n} for n in ("ID", "V", "OPER")]
    return json.dumps({"Encoding": "csv", "Attributes": {"message.batchIndex": number, "message.lastBatch": False, "Content": {"Kind": "Table", "Fields": fields}}, "Body": "\n".join(cells)})


def test_packages_are_merged_by_number(spark):
    """Numbers beyond a gap wait for it to close; a number at or below the position fails the stream."""
    import pytest

    path, bronze, checkpoint = (fresh_path(spark, x) for x in ("packages", "bronze", "checkpoint"))
    t = Target(spark, fresh_path(spark, "target"), ["id"])
    t.create(spark.createDataFrame([(9, "seed")], "id int, v string"))

    def prepare(raw):
        last = cdc.coalesce_log(packages.decode(raw, ["id", "v", "oper"]).withColumn("_place", F.struct("batch_index", "row_no")), ["id"], "_place")
        return last.select(F.col("id").cast("int").alias("id"), "v", F.when(F.col("oper") == "D", "D").otherwise("U").alias("_op"))

    def deliver(*made):
        spark.createDataFrame([(x,) for x in made], "payload string").coalesce(1).write.mode("append").parquet(path)
        streams.stream_packages(spark.readStream.schema("payload string").parquet(path), t, bronze, checkpoint, prepare)
        return rows(t.read()), t.state().watermark

    many = [package(n, [f"1,v{n},U", f"{n},own,U"]) for n in range(12)]
    assert deliver(many[2], many[10]) == ([(9, "seed")], None)
    assert deliver(many[1], many[0]) == ([(0, "own"), (1, "v2"), (2, "own"), (9, "seed")], "2")
    got, position = deliver(*[many[i] for i in (9, 8, 11, 3, 4, 6, 7)])
    assert position == "4" and (1, "v4") in got and (9, "seed") in got
    got, position = deliver(many[5])
    assert position == "11" and got == sorted([(1, "v11"), *[(n, "own") for n in range(12) if n != 1]], key=str)
    assert deliver(package(12, ["1,,D"]))[0] == [x for x in got if x[0] != 1]
    with pytest.raises(Exception, match="is not after 12"):
        deliver(package(3, ["1,old,U"]))
    assert rows(t.read()) == [x for x in got if x[0] != 1]


STAMPS = "k long, _seq long, _op string, _commit_ts timestamp, _applied_at timestamp"


def stamped(*made):
    import datetime as dt

    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    return [(k, i, op, at(c), at(a)) for i, (k, op, c, a) in enumerate(made)]


def run_twice(spark, made, *deliveries):
    path, out, checkpoint = (fresh_path(spark, x) for x in ("stream", "out", "checkpoint"))
    for part in deliveries:
        spark.createDataFrame(stamped(*part), STAMPS).coalesce(1).write.mode("append").parquet(path)
        stream = made(spark.readStream.schema(STAMPS).parquet(path))
        streams.append_available(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def test_first_apply_is_the_least_in_any_order(spark):
    """Of rows that come again the earliest apply counts, though it comes later; a change is given out once."""
    made = lambda log: streams.stream_first_apply(log, ["k"], "2 minutes")
    got = run_twice(spark, made, [(1, "U", 0, 70), (2, "I", 5, 9)], [(1, "I", 0, 4), (2, "D", 5, 60)], [(3, "U", 500, 501)], [(1, "D", 0, 1), (4, "U", 900, 901)])
    assert rows(got.select("k", "_op", F.col("latency_seconds").cast("double"))) == [(1, "I", 4.0), (2, "I", 4.0), (3, "U", 1.0)]


def test_windows_take_late_rows_until_the_safety_has_passed(spark):
    made = lambda log: streams.stream_windows(log, "10 seconds", "1 minute")
    got = run_twice(spark, made, [(1, "U", 0, 3), (2, "U", 0, 15)], [(3, "U", 0, 60), (4, "U", 0, 5)], [(5, "U", 0, 200)], [(6, "U", 0, 7), (7, "U", 0, 400)])
    starts = {(r.start.minute * 60 + r.start.second, r.n) for r in got.collect()}
    assert starts == {(0, 2), (10, 1), (60, 1), (200, 1)}  # the row of second 7 came after its window was given out
