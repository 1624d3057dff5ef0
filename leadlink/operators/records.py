"""Rows looked up, merged, ordered and counted around a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import normalize, scores
from . import analytics

R = Rules()

# fixed values: the columns of a transaction's two further addresses
OMS_ADDRESS = ["oms_address_line_1", "oms_city", "oms_state", "oms_zip"]
OMS2_ADDRESS = ["oms_address_line_1_v2", "oms_city_2", "oms_state_2", "oms_zip_2"]


def distinct_in_order(values: list) -> list:
    """A short list of settings without repeats, each where it first stands."""
    return list(dict.fromkeys(values))


def drop_blank(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which any of the columns is filled."""
    return df.na.drop(how="all", subset=columns)


def real_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each territory that is no dry run and no verification."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return analytics.latest_per_key(runs.where(~flag("dry_run") & ~flag("verification")), ["territory"], [F.desc("created")])


def with_contacts(leads: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every lead, with e-mail and phone of its account where it has one; blanks as empty."""
    got = leads.join(accounts.select("account_id", "email", "phone"), "account_id", "left")
    return got.withColumns({c: F.coalesce(c, F.lit("")) for c in ("email", "phone")})


def side_by_side(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_primary", "_fuzzy")) -> DataFrame:
    """All rows of left with those of right; columns that both have, but the key, get a suffix."""
    both = [c for c in left.columns if c in right.columns and c != key]
    named = [df.withColumnsRenamed({c: c + s for c in both}) for df, s in zip((left, right), suffixes)]
    return named[0].join(named[1], key, "left")


def refreshed(df: DataFrame, details: DataFrame, key: str, changed: Column, columns: list[str]) -> DataFrame:
    """Columns of changed rows are looked up anew; the other rows, and those not found, stay."""
    found = details.select(F.col(key).alias("k_"), F.lit(True).alias("hit_"), *[F.col(c).alias(f"{c}_") for c in columns])
    take = F.coalesce(changed, F.lit(False)) & F.col("hit_").isNotNull()
    out = df.join(found, F.col(key) == F.col("k_"), "left")
    return out.select(*[F.when(take, F.col(f"{c}_")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def exact_backfill(transactions: DataFrame, decisions: DataFrame, rules: Rules = R) -> DataFrame:
    """Transactions whose newest exact decision they do not show yet take its lead, score and type."""
    exact = decisions.where(scores.is_exact(F.col("match_type"), F.col("final_score"), rules))
    best = analytics.latest_per_key(exact, ["pos_id"], [F.desc("created"), F.asc("lead_id")])
    best = best.select(F.col("pos_id").alias("p_"), F.col("lead_id").alias("l_"), F.coalesce("final_score", F.lit(rules.exact_score)).alias("s_"))
    shown = F.coalesce(F.lower("match_type").isin(*rules.exact_types), F.lit(False))
    take = F.col("p_").isNotNull() & ~shown
    new = {"lead_id": F.col("l_"), "match_score": F.col("s_"), "match_type": F.lit("Exact"), "is_processed": F.lit(True)}
    out = transactions.join(best, F.col("pos_id") == F.col("p_"), "left")
    return out.select(*[F.when(take, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in transactions.columns])


def table_counts(tables: dict[str, DataFrame], scope: Column | None = None) -> DataFrame:
    """table_name and n for each table, of the rows in scope where the table knows territories."""
    parts = [t.where(scope) if scope is not None and "territory" in t.columns else t for t in tables.values()]
    counts = [p.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, p in zip(tables, parts)]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


def score_range(df: DataFrame, kind: str) -> DataFrame:
    return df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.min("similarity_score").alias("lowest"), F.max("similarity_score").alias("highest"))


def output_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("final_score"), "lead_id", "pos_id")


def dry_run_rows(df: DataFrame, most: int = 1000) -> DataFrame:
    """What a dry run shows: the first rows of the output, over all batches."""
    return output_order(df).limit(most)


def by_territory(df: DataFrame, column: str = "territory") -> DataFrame:
    """Territories that are numbers in their order, then the others by name."""
    return df.orderBy(F.col(column).try_cast("bigint").asc_nulls_last(), F.col(column))


def territory_places(df: DataFrame, column: str = "territory") -> DataFrame:
    """Every territory with its place, from 1, in the order of by_territory(). Only the list of different
    territories is numbered in one task, not the rows."""
    order = Window.orderBy(F.col(column).try_cast("bigint").asc_nulls_last(), F.col(column))
    return df.select(column).distinct().select(column, F.row_number().over(order).cast("long").alias("place"))


def oms_address(columns: list[str]) -> Column:
    """One further address of a transaction, as addresses are normalised; empty without parts."""
    parts = [F.when(F.trim(c) != "", F.col(c)) for c in columns]
    return normalize.address(F.concat_ws(" ", *parts))


def loader_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key columns as the loader compares them: trimmed, in lower case; nulls stay."""
    return df.withColumns({f"key_{c}": F.lower(F.trim(F.col(c).cast("string"))) for c in columns})


def missing_ids(ids: DataFrame, known: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """Ids that the source lacks, in order; the first `most` of them for a report."""
    gone = ids.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti").orderBy(key)
    return gone if most is None else gone.limit(most)


def summary_check(summary: DataFrame, detail: DataFrame, components: list[str], least: int = 100) -> DataFrame:
    """One row: whether the summary's count is that of its rows, whether every component score is
    filled, and whether enough rows are not exact to tell anything."""
    c = detail.agg(
        F.count(F.lit(1)).alias("n_detail"),
        F.count_if(F.lower("match_type") != "exact").alias("n_not_exact"),
        *[F.count_if(F.col(x).isNull()).alias(f"no_{x}") for x in components],
    )
    n = summary.agg(F.sum("n").alias("n_summary"))
    out = c.crossJoin(n)  # one row by one row
    whole = (F.col("n_summary") == F.col("n_detail")) & (F.col("n_not_exact") >= least)
    for x in components:
        whole &= F.col(f"no_{x}") == 0
    return out.withColumn("verdict", F.when(whole, "PASS").otherwise("FAIL"))
