"""Work in chunks that can be resumed, by a ledger of their states.

The ledger is a folder of small JSON files that are only ever added to: one for each change of a
chunk's state. The state that counts is the one of the last attempt, and within it the last to be
written. A chunk's output is a folder of its own that a new attempt replaces as a whole, so
whatever was left by an attempt that died is gone, and every row is there once.

PENDING: planned, never begun. RUNNING: begun; if no later state is there, its driver died. SUCCESS and
PARTIAL: over, without and with rows that failed. FAILED: the work raised an error."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, chunk int, attempt int, step int, status string, first_key string, last_key string, "
    "rows_attempted long, rows_written long, rows_failed long, at timestamp, error string"
)
STEPS = {"PENDING": 0, "RUNNING": 1, "SUCCESS": 2, "PARTIAL": 2, "FAILED": 2}
DONE = ("SUCCESS",)


class Ledger:
    """The states of the chunks of runs, in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, rows: list[dict]) -> None:
        now = datetime.now(timezone.utc)
        full = [{"at": now, **r, "step": STEPS[r["status"]]} for r in rows]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        df = self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], SCHEMA)
        df.coalesce(1).write.mode("append").json(self.path)

    def events(self) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)

    def states(self, run: str | None = None) -> DataFrame:
        e = self.events()
        return states(e if run is None else e.where(F.col("run_id") == run))


def states(events: DataFrame) -> DataFrame:
    """One row for each run and chunk: what was written last, of its last attempt."""
    last = Window.partitionBy("run_id", "chunk").orderBy(F.desc("attempt"), F.desc("step"), F.desc("at"))
    return events.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def summary(events: DataFrame) -> DataFrame:
    """One row for each run: chunks by state, rows, and whether there is anything left to do."""
    s = states(events)
    by = [F.count_if(F.col("status") == x).alias(x.lower()) for x in STEPS]
    out = s.groupBy("run_id").agg(F.count(F.lit(1)).alias("chunks"), *by, F.max("attempt").alias("attempts"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_attempted", "rows_written", "rows_failed")])
    return out.withColumn("left", F.col("chunks") - F.col("success"))


def cut(df: DataFrame, key: str, size: int) -> DataFrame:
    """df with `chunk`: ranges of the key of about `size` rows, none over twice that unless one key has
    more. Borders are those that the same rows give again; rows of one key share a chunk."""
    n = df.count()
    parts = max(1, -(-n // size))
    if parts == 1:
        return df.withColumn("chunk", F.lit(0))
    # counts of keys by a hash-free range sort: offsets of the partitions, then of the keys within
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("__c")).repartitionByRange(max(2, parts), key).sortWithinPartitions(key)
    keys = keys.withColumn("__p", F.spark_partition_id())
    sums = keys.groupBy("__p").agg(F.sum("__c").alias("__s"))
    sums = sums.withColumn("__o", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__s")  # a row for each partition
    within = Window.partitionBy("__p").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    placed = keys.withColumn("__b", F.coalesce(F.sum("__c").over(within), F.lit(0))).join(F.broadcast(sums), "__p")
    placed = placed.select(F.col(key).alias("__k"), F.floor((F.col("__b") + F.col("__o")) / size).cast("int").alias("chunk"))
    return df.join(placed, df[key].eqNullSafe(placed["__k"])).drop("__k")


@dataclass
class Outcome:
    done: list[int]
    skipped: list[int]


def run(df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out: str, ledger: Ledger, run_id: str, failed: Column | None = None, size: int = 100_000, most: int | None = None) -> Outcome:
    """Works through the chunks of df (its column `chunk`, or ranges of `key`) that are not SUCCESS yet.

    work takes the rows of a chunk and returns rows; those for which `failed` holds are counted, not
    written, and make the chunk PARTIAL, so it is done again the next time. Each chunk's rows go to
    out/run_id=.../chunk=..., replaced as a whole. An error marks the chunk FAILED and is raised again;
    chunks after it stay PENDING. `most` ends after so many chunks."""
    df = df if "chunk" in df.columns else cut(df, key, size)
    k = F.col(key)
    plan = {r["chunk"]: r for r in df.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min(k).cast("string").alias("a"), F.max(k).cast("string").alias("b")).orderBy("chunk").collect()}
    known = {r["chunk"]: r for r in ledger.states(run_id).collect()}
    row = lambda c, status, attempt, **more: {"run_id": run_id, "chunk": c, "attempt": attempt, "status": status, "first_key": plan[c]["a"], "last_key": plan[c]["b"], "rows_attempted": plan[c]["n"], **more}
    if fresh := [row(c, "PENDING", 0) for c in plan if c not in known]:
        ledger.add(fresh)
    todo = [c for c in plan if c not in known or known[c]["status"] not in DONE]
    outcome = Outcome([], [c for c in plan if c not in todo])
    bad = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    for c in todo[:most]:
        attempt = (known[c]["attempt"] if c in known else 0) + 1
        ledger.add([row(c, "RUNNING", attempt)])
        seen = Observation()
        try:
            got = work(df.where(F.col("chunk") == c).drop("chunk")).observe(seen, F.count_if(bad).alias("failed"), F.count_if(~bad).alias("written"))
            got.where(~bad).write.mode("overwrite").parquet(f"{out}/run_id={run_id}/chunk={c}")
            n = seen.get
        except Exception as e:
            ledger.add([row(c, "FAILED", attempt, rows_written=0, error=f"{type(e).__name__}: {e}"[:500])])
            raise
        status = "PARTIAL" if n["failed"] else "SUCCESS"
        ledger.add([row(c, status, attempt, rows_written=n["written"], rows_failed=n["failed"])])
        outcome.done.append(c)
    return outcome


def output(spark: SparkSession, out: str, ledger: Ledger, run_id: str) -> DataFrame:
    """Rows of the chunks that are SUCCESS or PARTIAL; what an attempt that died left is not read."""
    good = ledger.states(run_id).where("status IN ('SUCCESS', 'PARTIAL')").select("chunk")
    return spark.read.parquet(f"{out}/run_id={run_id}").join(F.broadcast(good), "chunk")
