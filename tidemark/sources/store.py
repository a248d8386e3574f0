"""A target that is merged run by run: every run writes rows and log as one job to a fresh path, and a pointer row last.

What a run has written counts once its pointer row is there, so a run that died is simply repeated, a run that finished does
nothing again, and readers see whole runs alone.  Paths that no pointer names, and those of older runs, may be removed by
whoever keeps the folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import same_keys
from .scratch import fresh_path

#: Changes are numbered within so many parts of their keys' hash range, one after another.
PARTS = 256
POINTER = "run_id long, rows string, log string, schema string, watermark string, log_seq long"
LOG = "_seq long, _op string, _run_id long, _commit_ts timestamp, _applied_at timestamp"


class Target:
    """Rows with these keys below a path.  One writer at a time; run ids must rise."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def create(self, rows: DataFrame) -> None:
        """The first rows, as run 0."""
        at = fresh_path(self.spark, "rows", self.path)
        rows.write.parquet(at)
        self._point(0, at, None, rows.schema, None, 0)

    def _point(self, run_id: int, at: str, log: str | None, schema: T.StructType, watermark: str | None, log_seq: int) -> None:
        fields = T.StructType.fromDDL(POINTER).fields
        row = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((run_id, at, log, schema.json(), watermark, log_seq), fields)]
        self.spark.range(0, 1, 1, 1).select(*row).write.mode("append").parquet(f"{self.path}/runs")

    def _runs(self) -> DataFrame:
        return self.spark.read.schema(POINTER).parquet(f"{self.path}/runs")

    def state(self) -> Row:
        """The pointer row of the last finished run."""
        return self._runs().orderBy(F.desc("run_id")).first()

    def read(self, state: Row | None = None) -> DataFrame:
        """The rows as the last finished run, or the one of a pointer row, left them."""
        state = state or self.state()
        return self.spark.read.schema(T.StructType.fromJson(_json(state.schema))).parquet(state.rows)

    def log(self) -> DataFrame:
        """The change log of all finished runs; columns that a target gained later are null before."""
        out = None
        for r in self._runs().where("log is not null").orderBy("run_id").collect():  # a row a run
            own = self.spark.read.schema(_with_log(T.StructType.fromJson(_json(r.schema)))).parquet(r.log)
            out = own if out is None else out.unionByName(own, allowMissingColumns=True)
        return out if out is not None else self.spark.createDataFrame([], _with_log(self.read().schema))

    def commit(self, run_id: int, changes: DataFrame, commit: Column, applied: Column, watermark: str | None = None, merge=None, log: bool = True) -> int:
        """Merge changes under a run; returns how many there were.  Of a run that has finished nothing is done again.

        merge(target, changes) defaults to an upsert by key; with it rows and log are one job, over one join.  Other merges
        and a log of theirs take a job each.  Changes that share a key fail the run.  The log has U for keys that the
        target held and else I, numbered on without gaps; its order within a run follows the keys' hash.  A quiet
        run stores its pointer alone.
        """
        before = self.state()
        if run_id <= before.run_id:
            return 0
        sizes = self._sizes(changes)
        n = sum(sizes.values())
        watermark = watermark if watermark is not None else before.watermark
        if not n:
            self._point(run_id, before.rows, None, T.StructType.fromJson(_json(before.schema)), watermark, before.log_seq)
            return 0
        old = self.read(before)
        at = fresh_path(self.spark, "run", self.path)
        if merge:
            merge(old, changes).select([F.col(f.name).cast(f.dataType).alias(f.name) for f in old.schema]).write.parquet(f"{at}/_part=rows")
            if log:
                self._upserted(old, changes, sizes, before.log_seq, run_id, commit, applied).where("_part = 'log'").drop("_part").write.parquet(f"{at}/_part=log")
        else:
            rows = self._upserted(old, changes, sizes, before.log_seq, run_id, commit, applied)
            (rows if log else rows.where("_part = 'rows'")).write.partitionBy("_part").parquet(at)
        self._point(run_id, f"{at}/_part=rows", f"{at}/_part=log" if log else None, old.schema, watermark, before.log_seq + (n if log else 0))
        return n

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(PARTS)).cast("int")

    def _sizes(self, changes: DataFrame) -> dict[int, int]:
        """Changes in each part; at most PARTS rows meet on the driver."""
        by = changes.groupBy(self._part().alias("p"), *self.keys).agg(F.count("*").alias("c"))
        by = by.groupBy("p").agg(F.sum("c").alias("n"), F.max(F.struct("c", *self.keys)).alias("worst")).collect()
        for r in by:
            if r.worst.c > 1:
                raise ValueError(f"key {tuple(r.worst[1:])} occurs {r.worst.c} times")
        return {r.p: r.n for r in by}

    def _upserted(self, old: DataFrame, changes: DataFrame, sizes: dict[int, int], base: int, run_id: int, commit: Column, applied: Column) -> DataFrame:
        """The merged rows and the log rows, told apart by _part, from one full outer join of target and changes."""
        offsets, at = [], base
        for p in range(PARTS):
            offsets.append(at)
            at += sizes.get(p, 0)
        place = F.row_number().over(Window.partitionBy("_p").orderBy(*self.keys))
        starts = F.expr(f"array({', '.join(f'{x}L' for x in offsets)})")
        news = changes.withColumn("_p", self._part()).withColumn("_seq", F.get(starts, F.col("_p")) + place)
        news = news.withColumns({"_commit_ts": commit.cast("timestamp"), "_applied_at": applied.cast("timestamp")})
        both = old.withColumn("_t", F.lit(True)).alias("a").join(news.alias("b"), same_keys(self.keys), "full_outer")
        changed, have = F.col("b._seq").isNotNull(), {c.lower() for c in changes.columns}
        pick = [F.when(changed, F.col(f"b.{f.name}")).otherwise(F.col(f"a.{f.name}")).cast(f.dataType).alias(f.name) if f.name.lower() in have else F.col(f"a.{f.name}") for f in old.schema]
        op = F.when(F.col("a._t"), "U").otherwise("I")
        rows = both.select(*pick, F.col("b._seq").alias("_seq"), op.alias("_op"), F.lit(run_id).cast("long").alias("_run_id"), F.col("b._commit_ts").alias("_commit_ts"), F.col("b._applied_at").alias("_applied_at"))
        parts = F.when(F.col("_seq").isNotNull(), F.array(F.lit("rows"), F.lit("log"))).otherwise(F.array(F.lit("rows")))
        return rows.withColumn("_part", F.explode(parts))


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def _with_log(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, *T.StructType.fromDDL(LOG).fields])
