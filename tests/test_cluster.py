"""Queries whose foreign table a driver must not keep to itself, where driver and executors are processes of their own."""

import importlib.util
import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

from tests.oracle import compare
from tidemark.plans import loads, registry, scenarios

RUN = """
import sys
from pyspark.sql import SparkSession
from tidemark.plans import loads, registry

name, data, base = sys.argv[1:]
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "700m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC"}
spark = SparkSession.builder.config(map=conf | {"spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse"}).getOrCreate()
registry.QUERIES[name](spark, data).write.parquet(f"{base}/out")
spark.stop()
"""


@pytest.mark.parametrize("name", ["L10_parallel_load", "L17_federated_query"])
def test_on_a_cluster(spark, sf_dir, tmp_path, name):
    home = tmp_path / "home"  # the executors' logs go to work in Spark's home
    (home / "work").mkdir(parents=True)
    for p in Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "PYTHONPATH": str(Path(__file__).parent.parent)}
    env = {k: v for k, v in env.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_AUTH", "_PYSPARK"))}
    ran = subprocess.run([sys.executable, "-c", RUN, name, sf_dir, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert not ran.returncode, ran.stderr[-3000:]
    compare(spark.read.parquet(f"{tmp_path}/out"), registry.ORACLE_SQL[name], sf_dir)


def test_filter_is_pushed_into_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(scenarios, "database", lambda spark: None)
    plan = loads.federated_query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan orc.*PushedFilters: \[[^]]*EqualTo\(toxic,0\)[^]]*\], ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>", plan) and "FileScan parquet" in plan
