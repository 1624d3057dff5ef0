"""Steps around the match: source scans, purge, fallback columns, pages, tallies, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from . import matching

R = Rules()


def lead_scan(leads: DataFrame, accounts: DataFrame, done: DataFrame, decisions: DataFrame, scope: frozenset[int] | None = None, limit: int | None = None, rules: Rules = R) -> DataFrame:
    """Leads with their account, defaults filled in, without those that have vectors already or
    that an exact decision owns."""
    df = leads.where(matching.in_scope("territory", scope)).join(accounts, "account_id")
    df = matching.exclude_exact(matching.new_only(df, done, "lead_id"), "lead_id", decisions, rules=rules)
    df = df.withColumns({c: F.coalesce(c, F.lit("")) for c, k in df.dtypes if k == "string"}).orderBy("lead_id")
    return df if limit is None else df.limit(limit)


def pos_scan(transactions: DataFrame, done: DataFrame, decisions: DataFrame, scope: frozenset[int] | None = None, limit: int | None = None, rules: Rules = R) -> DataFrame:
    """Transactions not yet consumed, without vectors, that no exact decision owns."""
    df = transactions.where(~F.col("is_processed")).where(matching.in_scope("territory", scope))
    df = matching.exclude_exact(matching.new_only(df, done, "pos_id"), "pos_id", decisions, rules=rules)
    return df.orderBy("pos_id") if limit is None else df.orderBy("pos_id").limit(limit)


def purge(tables: dict[str, DataFrame], territory: int) -> dict[str, DataFrame]:
    """Snapshots without a territory: rows of its own, rows that hang on its leads, and accounts
    that no lead needs any more. An anti join, so null keys keep nothing from going."""
    leads = tables["lead"]
    gone = leads.where(F.col("territory") == territory).select("lead_id")
    out = {n: t.where(~F.col("territory").eqNullSafe(territory)) if "territory" in t.columns else t for n, t in tables.items()}
    for n, t in out.items():
        if n != "lead" and "lead_id" in t.columns and "territory" not in t.columns:
            out[n] = t.join(gone, "lead_id", "left_anti")
    if "account" in out:
        out["account"] = out["account"].join(out["lead"].select("account_id"), "account_id", "left_semi")
    return out


def fallback(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """The first filled one of several columns."""
    return df.withColumn(name, F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns]))


def blank_out(df: DataFrame, columns: list[str], where: Column) -> DataFrame:
    return df.withColumns({c: F.when(F.coalesce(where, F.lit(False)), None).otherwise(F.col(c)) for c in columns})


def keyset_page(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """The next page by key, for callers that cannot take a whole DataFrame."""
    return df.where(F.lit(True) if after is None else F.col(key) > after).orderBy(key).limit(n)


def without_collisions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Repeated ids get a suffix from the second on."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__n", n).withColumn(key, F.when(F.col("__n") > 1, F.concat(F.col(key), F.lit("-"), F.col("__n"))).otherwise(F.col(key))).drop("__n")


def knn_global(leads: DataFrame, pos: DataFrame, k: int = R.top_k, gate: float = R.recall_gate, allowed: bool = False) -> DataFrame:
    """Neighbours for leads without a territory, over all transactions: off unless allowed, as it
    compares every lead with every transaction, in parts by matrix products."""
    if not allowed:
        raise ValueError("global neighbours compare everything with everything; pass allowed=True")
    one = F.lit(0).alias("block")
    return matching.knn_matmul(leads.select(one, "lead_id", "v"), pos.select(one, "pos_id", "v"), "block", k, gate).drop("block")


def expected_relation(score: Column, closed: Column, rules: Rules = R) -> Column:
    return F.when(closed, "closed_existing").when(score >= rules.exact_score, "exact_single").when(score >= rules.floor, "fuzzy_candidate").otherwise("no_match")


def score_buckets(df: DataFrame) -> DataFrame:
    s = F.col("final_score")
    return df.groupBy("match_run_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(s >= 95).alias("n_95"), F.count_if((s >= 90) & (s < 95)).alias("n_90"), F.count_if((s >= 85) & (s < 90)).alias("n_85"), F.count_if((s >= 70) & (s < 85)).alias("n_70"))


def unmatched(n_leads: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row: leads, leads with a decision, and how many are left, never below 0."""
    m = decisions.agg(F.count_distinct("lead_id").alias("matched"))
    return n_leads.agg(F.count(F.lit(1)).alias("n_leads")).crossJoin(m).withColumn("unmatched", F.greatest(F.col("n_leads") - F.col("matched"), F.lit(0)))  # one row by one row


def artifacts(df: DataFrame, n: int = 20) -> DataFrame:
    """A JSON array of the n best scores, as a report shows it."""
    top = df.orderBy(F.desc_nulls_last("final_score"), "lead_id", "created").limit(n)
    rows = F.array_sort(F.collect_list(F.struct((-F.col("final_score")).alias("o"), "lead_id", "created")))
    return top.agg(F.to_json(F.transform(rows, lambda x: F.struct(x["lead_id"].alias("lead"), x["created"].alias("order")))).alias("artifacts"), F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def elapsed(start: Column, end: Column) -> Column:
    """Seconds as `1h 02m 03s`."""
    s = F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return F.format_string("%dh %02dm %02ds", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
