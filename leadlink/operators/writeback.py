"""Snapshot overlays: upserts, guarded write-back, audit rows. Tables are replaced, not updated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import scores

R = Rules()


def insert_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target and those rows whose key it lacks; of rows with one key, the first by all columns."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in rows.columns if c not in keys] or keys)
    rows = rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return target.unionByName(rows.join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.unionByName(target.join(rows.select(*keys), keys, "left_anti"))


def delete(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not among `keys`; null keys stay, and nulls among `keys` delete nothing."""
    return target.join(keys.select(*on), on, "left_anti")


def latest_decision(decisions: DataFrame, rules: Rules = R) -> DataFrame:
    """The decision that counts for each transaction: by priority, score, time, lead."""
    w = Window.partitionBy("pos_id").orderBy(F.desc("priority"), F.desc_nulls_last("final_score"), F.desc_nulls_last("created"), "lead_id")
    return decisions.withColumn("priority", scores.priority(F.col("match_type"), rules)).withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def overlay(transactions: DataFrame, decided: DataFrame, rules: Rules = R) -> DataFrame:
    """Transactions with lead_id, match_score and match_type of their decision, unless what they
    have is of higher priority; is_processed is set where a decision is taken over."""
    new = decided.select("pos_id", F.col("lead_id").alias("__l"), F.col("final_score").alias("__s"), F.col("match_type").alias("__t"), F.col("priority").alias("__p"))
    joined = transactions.join(new, "pos_id", "left")
    take = F.col("__p").isNotNull() & (F.col("__p") >= scores.priority(F.col("match_type"), rules))
    take = F.coalesce(take, F.lit(False))
    pick = lambda a, b: F.when(take, F.col(a)).otherwise(F.col(b))
    return joined.withColumns({"lead_id": pick("__l", "lead_id"), "match_score": pick("__s", "match_score"), "match_type": pick("__t", "match_type"), "is_processed": take | F.col("is_processed")}).drop("__l", "__s", "__t", "__p")


def lead_states(decisions: DataFrame, rules: Rules = R) -> DataFrame:
    """State of each lead: exact before potential before none."""
    exact = scores.is_exact(F.col("match_type"), F.col("final_score"), rules)
    maybe = F.lower("match_type").isin("fuzzy", "manual review") & (F.col("final_score") >= rules.floor)
    g = decisions.groupBy("lead_id").agg(F.bool_or(F.coalesce(exact, F.lit(False))).alias("e"), F.bool_or(F.coalesce(maybe, F.lit(False))).alias("p"), F.count(F.lit(1)).alias("n_decisions"))
    return g.select("lead_id", F.when(F.col("e"), "exact").when(F.col("p"), "potential").otherwise("none").alias("lead_state"), "n_decisions")


def write_back(decisions: DataFrame, transactions: DataFrame, leads: DataFrame, run: str, rules: Rules = R) -> tuple[DataFrame, DataFrame]:
    """New snapshots of transactions and leads. A lead that an exact decision of another run owns
    keeps its result unless this run is exact for it too."""
    own = decisions.where(F.col("match_run_id") == run)
    exact = scores.is_exact(F.col("match_type"), F.col("final_score"), rules)
    elsewhere = decisions.where((F.col("match_run_id") != run) & exact).select("lead_id", F.lit(True).alias("__owned")).distinct()
    states = lead_states(own, rules)
    joined = leads.join(states, "lead_id", "left").join(elsewhere, "lead_id", "left")
    free = F.col("lead_state").isNotNull() & (F.col("__owned").isNull() | (F.col("lead_state") == "exact"))
    return overlay(transactions, latest_decision(own, rules), rules), joined.withColumn("match_result", F.when(free, F.col("lead_state")).otherwise(F.col("match_result"))).drop("lead_state", "n_decisions", "__owned")


def ce_stubs(pairs: DataFrame, exact_pos: DataFrame) -> DataFrame:
    """Stub rows for pairs of class CE, without transactions that an exact match owns."""
    return pairs.where("fiscal_class = 'CE'").join(exact_pos.select("pos_id"), "pos_id", "left_anti").withColumns({"final_score": F.lit(0.0), "lifecycle_state": F.lit("Closed - Existing")})


def audit_row(decisions: DataFrame, run: str, status: str = "SUCCESS") -> DataFrame:
    """One row on a run, with its statistics as JSON in the order of their names."""
    g = decisions.where(F.col("match_run_id") == run).agg(F.count_distinct("lead_id").alias("lead_count"), F.count_distinct("pos_id").alias("pos_count"), F.count(F.lit(1)).alias("match_count"))
    stats = F.to_json(F.struct(F.col("lead_count").alias("leads"), F.col("match_count").alias("matches"), F.lit(run).alias("match_run_id"), F.col("pos_count").alias("transactions")))
    return g.select(F.lit(run).alias("match_id"), "lead_count", "pos_count", "match_count", stats.alias("stats"), F.lit(status).alias("status"))
