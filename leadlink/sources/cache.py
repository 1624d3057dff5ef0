"""A cache of vectors, keyed by id, hash of the text, and model.

It is a table of files bucketed by id and hash. Looking rows up shuffles the rows that
ask, never the cache; a changed text or another model is a miss. Texts that have no vector are
kept too, with valid = false, so they are not asked for again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import embed

SCHEMA = "id string, text_hash string, model string, v array<double>, valid boolean"


def text_hash(text: Column) -> Column:
    """SHA-256 of the trimmed text; null for a blank one, which has no entry."""
    t = F.trim(text)
    return F.when(t != "", F.sha2(t, 256))


def create(spark: SparkSession, table: str, path: str, buckets: int = 64) -> None:
    """The empty cache, if it is not there yet. It stays in `path` when the catalogue goes."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({SCHEMA}) USING parquet OPTIONS (path '{path}') "
        f"CLUSTERED BY (id, text_hash) SORTED BY (id, text_hash) INTO {buckets} BUCKETS"
    )


def lookup(asked: DataFrame, cache: DataFrame, model: str) -> DataFrame:
    """Every row of asked (id, text and any others) with v, valid and state: hit, miss, or blank for texts
    that have no vector by rule. If an entry is there more than once, its copies are equal and one counts."""
    own = cache.where(F.col("model") == model).select("id", "text_hash", "v", "valid")
    # a bucket is grouped and joined where it lies, without a shuffle
    own = own.groupBy("id", "text_hash").agg(F.first("v").alias("v"), F.first("valid").alias("valid"))
    own = own.withColumnsRenamed({"id": "__id", "text_hash": "__h"})
    rows = asked.withColumn("__a", text_hash(F.col("text")))
    on = (F.col("id").cast("string") == F.col("__id")) & (F.col("__a") == F.col("__h"))
    state = F.when(F.col("__a").isNull(), "blank").when(F.col("__h").isNull(), "miss").otherwise("hit")
    return rows.join(own, on, "left").withColumn("state", state).drop("__id", "__h", "__a")


def fill(asked: DataFrame, table: str, model: str, embedder: Callable = embed.hashed, buckets: int = 64) -> int:
    """Embeds what the cache misses and appends it; returns how many rows that were. Each distinct
    text is embedded once, whatever the number of its ids. A batch that fails appends nothing for its
    texts, so they are misses the next time."""
    spark = asked.sparkSession
    missing = lookup(asked.select(F.col("id").cast("string").alias("id"), "text"), spark.table(table), model).where("state = 'miss'")
    missing = missing.select("id", F.trim("text").alias("text")).distinct()
    vectors = embed.embed_distinct(missing, ["text"], embedder)
    rows = missing.join(vectors, "text").select("id", text_hash(F.col("text")).alias("text_hash"), F.lit(model).alias("model"), "v", F.col("v").isNotNull().alias("valid"))
    seen = Observation()
    rows.repartition(buckets, "id", "text_hash").observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").insertInto(table)
    return seen.get["n"]


def vectors(asked: DataFrame, table: str, model: str, embedder: Callable = embed.hashed) -> DataFrame:
    """Every row of asked with its vector, embedding only what the cache lacks."""
    fill(asked, table, model, embedder)
    return lookup(asked, asked.sparkSession.table(table), model).drop("state")
