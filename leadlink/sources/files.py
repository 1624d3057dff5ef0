"""Sources and sinks: CSV, JSON, Parquet snapshots, run catalogue, artifacts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RENAMES, conform, strings


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options) -> DataFrame:
    """A projection of a database table; needs its driver on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files that a path, which may be a folder or hold a glob, stands for."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(place) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [x.getPath().toString() for x in inside if x.isFile() and not x.getPath().getName().startswith(("_", "."))]
    return sorted(found)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The columns of a contract, as text, found by the header of each file, whose names are trimmed;
    ValueError names those that a file lacks. Quotes, doubled quotes and line ends in fields are
    read; short rows are filled with nulls; the path may be a folder or hold a glob."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE"}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files_of(spark, path):
        by_header.setdefault(tuple(spark.read.csv(file, **options).columns), []).append(file)
    parts = []
    for header, files in by_header.items():
        names = [h.strip().lstrip("\ufeff") for h in header]
        if gone := [c for c in columns if c not in names]:
            raise ValueError(f"columns are missing in {files[0]}: {gone}")
        df = spark.read.csv(files, schema=strings(*[f"c{i}" for i in range(len(names))]), enforceSchema=True, **options)
        parts.append(df.select(*[F.col(f"c{names.index(c)}").alias(c) for c in columns]))
    df = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], strings(*columns))
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in columns})


def read_ids(spark: SparkSession, glob: str, columns: list[str], key: str) -> DataFrame:
    """Distinct, trimmed, filled ids of many files."""
    return read_csv(spark, glob, columns).select(F.trim(key).alias(key)).where(F.col(key) != "").distinct()


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The contract's columns in its order; others are left out, missing ones are empty."""
    conform(df, columns).write.csv(path, header=True, quote='"', escape='"')


def run_path(root: str, territory: int | str, run: str, dry_run: bool = False) -> str:
    for part in (str(territory), run):
        if not part or any(c in part for c in "/\\") or part in (".", ".."):
            raise ValueError(f"not a path segment: {part!r}")
    return f"{root}/{'dry_run_' if dry_run else ''}decisions/territory={territory}/run_id={run}"


def write_run(df: DataFrame, root: str, territory: int | str, run: str, dry_run: bool = False) -> str:
    path = run_path(root, territory, run, dry_run)
    df.write.mode("overwrite").parquet(path)
    return path


def run_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """territory, run_id and the time of the last change of each run, newest first."""
    df = spark.read.parquet(f"{root}/decisions").select("territory", "run_id", F.col("_metadata.file_modification_time").alias("t"))
    return df.groupBy("territory", "run_id").agg(F.max("t").alias("updated")).orderBy(F.desc("updated"), "territory", "run_id")


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def publish(df: DataFrame, root: str, stamp: str) -> str:
    """A new snapshot in a folder of its own. It counts once its last file, _SUCCESS, is there, so no
    reader ever finds a part of one, nor none where there was one."""
    path = f"{root}/snapshot={stamp}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return path


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The whole snapshot with the greatest stamp."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/snapshot=*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    if not len(found):
        raise FileNotFoundError(f"no whole snapshot in {root}")
    return spark.read.parquet(max(x.getPath().getParent().toString() for x in found))


def annotate(spark: SparkSession, path: str, run: str, lead_id: str, note: str) -> None:
    spark.createDataFrame([(run, lead_id, note)], "run_id string, lead_id string, note string").write.mode("append").parquet(path)
