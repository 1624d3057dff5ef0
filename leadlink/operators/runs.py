"""What a run leaves behind: decisions with stubs, and new snapshots of transactions, leads and the audit.

The decisions of a run are written once; everything else is derived from that table, and counts are
observed while snapshots are written, so no table is read only to be counted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import scores
from ..sources.scratch import written
from . import matching, records

R = Rules()

# fixed values: the states of a decision, and who changes a transaction
EXACT, POTENTIAL, NO_MATCH, CLOSED_EXISTING = "Closed - Exact", "Potential", "No Match", "Closed - Existing"
BY, BY_CE = "leadlink", "leadlink_ce"


@dataclass
class Snapshots:
    """decisions: those of the run, stubs included. transactions and leads: whole tables, as they are
    after the run. audit: its row. counts: what was observed."""

    decisions: DataFrame
    transactions: DataFrame
    leads: DataFrame
    audit: DataFrame
    counts: dict[str, int]


def state(rules: Rules = R) -> Column:
    """Life-cycle state of a decision: exact types are exact whatever their score; others by score, so a
    stub, which has 0, is no match."""
    return (
        F.when(F.lower("match_type").isin(*rules.exact_types), EXACT)
        .when(F.lower("match_type").isin("fuzzy", "manual review") & (F.col("final_score") >= rules.floor), POTENTIAL)
        .otherwise(NO_MATCH)
    )


def with_stubs(decisions: DataFrame, pairs: DataFrame, run: str, created: Column) -> DataFrame:
    """Decisions of a run and a stub of score 0 for each pair of class CE that they do not have."""
    ce = pairs.where("fiscal_class = 'CE'").select("lead_id", "pos_id", "territory").distinct()
    ce = ce.join(decisions.select("lead_id", "pos_id"), ["lead_id", "pos_id"], "left_anti")
    stub = {"match_run_id": F.lit(run), "match_type": F.lit(CLOSED_EXISTING), "final_score": F.lit(0.0), "created": created}
    return decisions.unionByName(ce.withColumns(stub), allowMissingColumns=True)


def winners(decisions: DataFrame, leads: DataFrame, transactions: DataFrame, rules: Rules = R) -> DataFrame:
    """The decision that counts for each transaction, with priority, lifecycle_state and primary_transaction:
    of the exact ones of a lead the earliest by fiscal order. Decisions whose lead or transaction
    is in neither table do not count; stubs are of the lowest priority."""
    fiscal = transactions.select("pos_id", "pos_year", "pos_period", F.coalesce("pos_week", F.lit(0)).alias("pos_week"))
    own = decisions.select("match_run_id", "lead_id", "pos_id", "match_type", "final_score", "created")
    own = own.join(leads.select("lead_id"), "lead_id", "left_semi").join(fiscal, "pos_id")
    best = Window.partitionBy("pos_id").orderBy(F.desc("priority"), F.desc_nulls_last("final_score"), F.desc_nulls_last("created"), "lead_id")
    own = own.withColumn("priority", scores.priority(F.col("match_type"), rules)).withColumn("__n", F.row_number().over(best)).where("__n = 1").drop("__n")
    own = own.withColumn("lifecycle_state", state(rules))
    return matching.with_primary(own, rules, F.col("lifecycle_state") == EXACT)


def shown_priority(rules: Rules = R) -> Column:
    """Priority of what a transaction shows; an exact type below the exact score is none."""
    t = F.lower(F.coalesce("match_type", F.lit("")))
    own = scores.is_exact(F.col("match_type"), F.col("match_score"), rules)
    return F.when(F.coalesce(own, F.lit(False)), 3).when(t == "fuzzy", 2).when(t == "manual review", 1).otherwise(0)


def transactions_after(transactions: DataFrame, won: DataFrame, stubs: DataFrame, at: Column, rules: Rules = R) -> DataFrame:
    """All transactions. One with a decision whose priority is that of what it shows, or higher, takes lead,
    score, type, primary flag and comment, and is processed; stubs have the lowest priority, and where one is
    not taken over its transaction is processed all the same."""
    new = won.select(
        F.col("pos_id").alias("__p"), F.col("lead_id").alias("__l"), F.col("final_score").alias("__s"), F.col("match_type").alias("__t"), F.col("priority").alias("__n"), F.col("primary_transaction").alias("__f"),
        F.concat(F.lit("match_run_id="), F.col("match_run_id").cast("string"), F.lit("; lifecycle_state="), F.col("lifecycle_state")).alias("__c"),
    )
    ce = stubs.select(F.col("pos_id").alias("__q")).distinct()
    joined = transactions.join(new, F.col("pos_id") == F.col("__p"), "left").join(ce, F.col("pos_id") == F.col("__q"), "left")
    take = F.coalesce(F.col("__n") >= shown_priority(rules), F.lit(False))
    mark = F.col("__q").isNotNull() & ~take
    values = {"lead_id": "__l", "match_score": "__s", "match_type": "__t", "primary_transaction": "__f", "matching_comments": "__c"}
    out = {c: F.when(take, F.col(v)).otherwise(F.col(c)) for c, v in values.items()}
    out["is_processed"] = take | mark | F.coalesce("is_processed", F.lit(False))
    out["process_datetime"] = F.when(take | mark, at).otherwise(F.col("process_datetime"))
    out["updated_by"] = F.when(take, BY).when(mark, BY_CE).otherwise(F.col("updated_by"))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in transactions.columns], take.alias("__taken"), mark.alias("__marked"))


def leads_after(leads: DataFrame, decisions: DataFrame, transactions: DataFrame, others: DataFrame, rules: Rules = R) -> DataFrame:
    """All leads. One with decisions of the run takes the best of their states: exact, then potential, then
    none; but a lead that another run, or a transaction as it is after the run, owns exactly is changed by
    an exact decision only."""
    own = decisions.join(transactions.select("pos_id"), "pos_id", "left_semi").withColumn("__s", state(rules))
    is_type = F.lower("match_type").isin(*rules.exact_types)
    g = own.groupBy(F.col("lead_id").alias("__l")).agg(F.bool_or(F.col("__s") == EXACT).alias("__e"), F.bool_or(F.col("__s") == POTENTIAL).alias("__p"), F.bool_or(F.coalesce(is_type, F.lit(False))).alias("__x"))
    owned = others.where(scores.is_exact(F.col("match_type"), F.col("final_score"), rules)).select("lead_id")
    shown = transactions.where(scores.is_exact(F.col("match_type"), F.col("match_score"), rules)).select("lead_id")
    owned = owned.unionByName(shown).where("lead_id IS NOT NULL").distinct().select(F.col("lead_id").alias("__o"))
    joined = leads.join(g, F.col("lead_id") == F.col("__l"), "left").join(owned, F.col("lead_id") == F.col("__o"), "left")
    free = F.col("__l").isNotNull() & (F.col("__x") | F.col("__o").isNull())
    new = F.when(F.col("__e"), EXACT).when(F.col("__p"), POTENTIAL).otherwise(NO_MATCH)
    out = {"match_result": F.when(free, new).otherwise(F.col("match_result")), "updated_by": F.when(free, BY).otherwise(F.col("updated_by"))}
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in leads.columns], free.alias("__changed"))


def audit(decisions: DataFrame, run: str, processed: int, dry: bool, wrote: bool, scope: str, at: Column) -> DataFrame:
    """One row on the run: counts, statistics as JSON by name, status and comments."""
    g = decisions.agg(F.count_distinct("pos_id").cast("int").alias("pos_count"), F.count(F.lit(1)).cast("int").alias("match_count"))
    own = F.struct(
        F.lit(dry).alias("dry_run"), F.lit(run).alias("match_run_id"), F.col("match_count").alias("match_rows"),
        F.col("pos_count").alias("matched_pos"), F.lit(processed).cast("int").alias("processed_leads"),
    )
    comments = f"match_run_id={run}; warehouse_scope={scope}; dry_run={dry}; business_writeback={'enabled' if wrote else 'skipped'}"
    return g.select(
        F.lit(run).alias("match_id"), F.lit(processed).cast("int").alias("lead_count"), "pos_count", "match_count", F.to_json(own).alias("stats"),
        F.lit("DRY_RUN" if dry else "COMPLETED").alias("status"), at.alias("update_date"), F.lit(comments).alias("comments"),
    )


def finish(
    decided: DataFrame, pairs: DataFrame, transactions: DataFrame, leads: DataFrame, run: str, others: DataFrame | None = None, dry: bool = False,
    write_anyway: bool = False, scope: str = "ALL", at: Column | None = None, rules: Rules = R, most: int = 1000,
) -> Snapshots:
    """Ends a run from its decisions and its scored pairs (with fiscal_class).

    A dry run keeps the first `most` decisions of the output, makes no stubs, and leaves both tables
    alone unless write_anyway. decided has match_run_id, lead_id, pos_id, territory, match_type,
    final_score and created; transactions have pos_year, pos_period, pos_week, lead_id, match_score, match_type,
    primary_transaction, matching_comments, is_processed, process_datetime and updated_by; leads have
    match_result and updated_by. others: decisions of other runs. Further columns are kept."""
    at = F.current_timestamp() if at is None else at
    kept = records.dry_run_rows(decided, most) if dry else with_stubs(decided, pairs, run, at)
    seen = {n: Observation() for n in ("decisions", "transactions", "leads")}
    kept = written(kept.observe(seen["decisions"], F.count(F.lit(1)).alias("n"), F.count_if(F.col("match_type") == CLOSED_EXISTING).alias("stubs")), "decisions")
    counts = {"decisions": seen["decisions"].get["n"], "stubs": seen["decisions"].get["stubs"], "transactions": 0, "processed": 0, "leads": 0}
    wrote = counts["decisions"] > 0 and (not dry or write_anyway)
    others = kept.limit(0) if others is None else others
    if wrote:
        won, stubs = winners(kept, leads, transactions, rules), kept.where(F.col("match_type") == CLOSED_EXISTING)
        after = transactions_after(transactions, won, stubs, at, rules)
        after = written(after.observe(seen["transactions"], F.count_if("__taken").alias("n"), F.count_if("__marked").alias("marked")), "transactions")
        transactions = after.drop("__taken", "__marked")
        changed = leads_after(leads, kept, transactions, others, rules)
        changed = written(changed.observe(seen["leads"], F.count_if("__changed").alias("n")), "leads")
        leads = changed.drop("__changed")
        counts |= {"transactions": seen["transactions"].get["n"], "processed": seen["transactions"].get["marked"], "leads": seen["leads"].get["n"]}
    processed = pairs.select("lead_id").distinct().count()
    return Snapshots(kept, transactions, leads, audit(kept, run, processed, dry, wrote, scope, at), counts)
