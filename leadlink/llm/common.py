"""What the operators share: intermediate tables, distributed ranks and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset on one
    machine (tests), a temporary folder is made and set, and removed at exit; on a cluster, where
    executors do not share a temporary folder, RuntimeError asks for the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="leadlink-")
        atexit.register(shutil.rmtree, own, True)
        base = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Folders of the operators that run now, innermost last (see released()).
_open: list[list[Scratch]] = []


class Scratch:
    """Tables that one run of an operator writes to the shared folder, so that no plan is run
    twice and a lost executor costs only the tasks it held. The folder goes when the application
    ends, or earlier by drop() or released()."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        if _open:
            _open[-1].append(self)

    def table(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).parquet(f"{self.path}/{name}")
        give_back(self.spark)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        """Deletes a table that nothing reads any more (all of them without a name)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def released():
    """Deletes at the end what operators wrote within; for callers that have kept their results."""
    _open.append([])
    try:
        yield
    finally:
        for scratch in _open.pop():
            scratch.drop()


@contextmanager
def batches_of(spark: SparkSession, size: int):
    """Plans that run within give Python workers batches of about `size` bytes, as workers and JVM
    hold several copies of a batch. The session's own setting is back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def tidy() -> None:
    """Gives free memory back to the system at the end of a task, as its worker process lives on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


#: When the driver gave back memory last.
_given = [0.0]


def give_back(spark: SparkSession, every: float = 2.0) -> str | None:
    """tidy() for the driver and its JVM, at most once in `every` seconds: memory that Spark's native code
    (compression, class compilation) has freed goes back to the system, by the management command of
    JDK 17 and later (jcmd System.trim_native_heap), whose answer is returned. Others have none; they keep it."""
    from py4j.protocol import Py4JError

    if time.monotonic() - _given[0] < every:
        return None
    tidy()
    _given[0] = time.monotonic()
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    try:
        kinds, values = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by the interface's method, as the server's class is not open to reflection
        invoke = named("javax.management.MBeanServer").getMethod("invoke", kinds)
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:
        return None


def spread(rows: DataFrame, table: DataFrame, on: list[str], weight: str, total: int, shares: int = 10_000) -> DataFrame:
    """rows joined with table by not null columns `on`. The table has one row for each key, and in
    `weight` how many of rows (`total` in all) have it. Keys of over 1 / shares of all rows are less
    than `shares` in number: they are broadcast, and none of their rows moves. The other keys are
    shuffled; none of them is large. Give a written table, as it is read twice."""
    least = max(100, total // shares)
    hot = F.broadcast(table.where(F.col(weight) > least).drop(weight))
    rest = rows.join(hot.select(*on), on, "left_anti").join(table.where(F.col(weight) <= least).drop(weight), on)
    return rows.join(hot, on).unionByName(rest)


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a whole text; null has a key of its own."""
    t = F.coalesce(text, F.lit(""))
    return [
        F.when(text.isNull(), F.lit(-1)).otherwise(F.xxhash64(t)),
        F.xxhash64(F.lit(7), t),
    ]


def ranks(df: DataFrame, keys: list[str], order: list[str], out: str = "rank", buckets: int | None = None, also: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """Adds a gapless rank from 0 within each key. No key is sorted in one task: its rows are
    dealt to buckets by a hash of the order columns, the counts of the buckets (one row for
    each key and bucket) are summed up, and rows are numbered within a bucket. There is a bucket
    for every 10,000 of `total` rows (counted where it is not given), 256 at least.

    The rank follows (bucket, order columns), which is a fixed order for fixed rows. `also` has
    one row for each key, whose other columns are added on the way."""
    buckets = buckets or max(256, (df.count() if total is None else total) // 10_000)
    b, n, before = f"__b_{out}", f"__n_{out}", f"__o_{out}"
    df = df.withColumn(b, F.pmod(F.xxhash64(F.lit(out), *order), F.lit(buckets)).cast("int"))
    counts = df.groupBy(*keys, b).agg(F.count(F.lit(1)).alias(n))
    upto = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(upto), F.lit(0))).drop(n)
    if also is not None:
        named = also.withColumnsRenamed({k: f"__a_{k}" for k in keys})
        on = [counts[k].eqNullSafe(named[f"__a_{k}"]) for k in keys]
        counts = counts.join(named, on).drop(*[f"__a_{k}" for k in keys])
    counts = counts.withColumnsRenamed({k: f"__k_{k}" for k in [*keys, b]})
    on = [df[k].eqNullSafe(counts[f"__k_{k}"]) for k in [*keys, b]]
    within = Window.partitionBy(*keys, b).orderBy(*order)
    return (
        df.join(counts, on)
        .withColumn(out, F.col(before) + F.row_number().over(within) - 1)
        .drop(b, before, *[f"__k_{k}" for k in [*keys, b]])
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a chunk, reduced to one edge from each node to the smallest of its tree."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def components(scratch: Scratch, edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) with label the smallest node that can be reached, for every node of an edge.

    Alternating large-star and small-star steps (Kiveris et al., 2014), each a few joins and
    partial minima, written to the shared folder; nothing goes to the driver but two sums a
    step. Chunks of edges are reduced to trees before the first shuffle."""

    def reduced(batches):
        import pandas as pd

        for p in batches:
            x, y = forest(p["u"].to_numpy(), p["v"].to_numpy())
            yield pd.DataFrame({"u": x, "v": y})

    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInPandas(reduced, "u long, v long")
    now, step, last = scratch.table(pairs.distinct(), "cc0"), 0, None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        step += 1
        new = scratch.table(small.where("u <> v").distinct(), f"cc{step}")
        scratch.drop(f"cc{step - 1}")
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
