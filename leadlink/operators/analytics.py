"""Report, handoff checks, score distributions, rollups, search, graph and data quality."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import scores
from . import matching

R = Rules()


# ---- handoff of the exact engine ----
def with_handoff_class(df: DataFrame, rules: Rules = R) -> DataFrame:
    return df.withColumn("handoff_class", scores.handoff_class(F.col("match_result"), F.col("similarity_score"), F.col("pos_id"), F.col("closed_existing_flag"), rules))


def duplicate_owners(final: DataFrame) -> DataFrame:
    """Transactions that several leads own: number of leads, best score, the leads, and whether
    more than one lead has the best score (ambiguous) or one wins (conflict)."""
    each = final.groupBy("pos_id", "lead_id").agg(F.max("similarity_score").alias("s"))
    w = Window.partitionBy("pos_id")
    top = each.withColumn("best", F.max("s").over(w))
    g = top.groupBy("pos_id").agg(F.count(F.lit(1)).alias("n_leads"), F.max("best").alias("max_score"), F.array_join(F.array_sort(F.collect_list(F.col("lead_id").cast("string"))), ",").alias("leads"), F.count_if(F.col("s") == F.col("best")).alias("n_top"))
    return g.where("n_leads > 1").withColumn("disposition", F.when(F.col("n_top") > 1, "ambiguous").otherwise("conflict"))


def source_alignment(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: distinct ids, those that the source has, and the share of it in percent."""
    own, there = ids.select(key).where(F.col(key).isNotNull()).distinct(), known.select(key).distinct().withColumn("__k", F.lit(1))
    j = own.join(there, key, "left")
    return j.agg(F.count(F.lit(1)).alias("n_ids"), F.count("__k").alias("n_found"), F.round(F.coalesce(F.try_divide(F.count("__k") * 100.0, F.count(F.lit(1))), F.lit(0.0)), 2).alias("overlap_pct"))


# ---- distributions ----
def score_stats(df: DataFrame, score: str = "final_score") -> DataFrame:
    s = F.col(score)
    return df.agg(F.count(s).alias("n"), F.round(F.avg(s), 4).alias("mean"), F.round(F.median(s), 4).alias("median"), F.round(F.stddev_samp(s), 4).alias("sd"), F.min(s).alias("lowest"), F.max(s).alias("highest"))


def histogram(df: DataFrame, score: str = "final_score", low: int = 70, high: int = 100) -> DataFrame:
    """Counts of [low, low + 1) to [high, high + 1); empty bins stay, what is outside goes."""
    bins = df.sparkSession.range(low, high + 1).select(F.col("id").alias("bin"))
    counts = df.where((F.col(score) >= low) & (F.col(score) < high + 1)).groupBy(F.floor(score).cast("long").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    return bins.join(counts, F.col("bin") == F.col("b"), "left").select("bin", F.coalesce("c", F.lit(0)).alias("n"))


def peak(df: DataFrame, score: str = "final_score", rules: Rules = R) -> DataFrame:
    """The fullest bin (the first of equals), its share of all rows, and whether it is a spike."""
    h = histogram(df, score)
    g = h.agg(F.max(F.struct("n", (-F.col("bin")).alias("b"))).alias("p"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    share = F.coalesce(F.try_divide(F.col("p.n").cast("double"), F.col("total")), F.lit(0.0))
    return g.crossJoin(total).select((-F.col("p.b")).alias("peak_bin"), F.col("p.n").alias("peak_n"), F.round(share, 6).alias("peak_share"), (share > rules.spike).alias("spike"))  # one row by one row


def band_counts(df: DataFrame, score: str = "final_score", rules: Rules = R) -> DataFrame:
    return df.groupBy(scores.band(F.col(score), rules).alias("band")).agg(F.count(F.lit(1)).alias("n"))


def review_workload(df: DataFrame, rules: Rules = R) -> DataFrame:
    s, n = F.col("final_score"), F.count(F.lit(1))
    pct = lambda c: F.round(F.coalesce(F.try_divide(F.count_if(c) * 100.0, n), F.lit(0.0)), 2)
    tail = s < rules.floor + 5
    review = F.lower("match_type") == "manual review"
    return df.agg(n.alias("n"), F.count_if(tail).alias("n_tail"), pct(tail).alias("tail_pct"), F.count_if(review).alias("n_review"), pct(review).alias("review_pct"))


def lifecycle_split(df: DataFrame, rules: Rules = R) -> DataFrame:
    exact = scores.is_exact(F.col("match_type"), F.col("final_score"), rules)
    fuzzy = F.lower("match_type").isin("fuzzy", "manual review")
    s = F.col("final_score")
    return df.agg(F.count_if(exact).alias("closed_exact"), F.count_if(fuzzy & (s >= rules.high)).alias("fuzzy_high"), F.count_if(fuzzy & (s >= rules.floor) & (s < rules.high)).alias("potential"))


def integrity(counts: DataFrame) -> DataFrame:
    """From rows, embedded and exact_claimed of each territory: the gap and a verdict."""
    gap = F.col("n_rows") - F.col("n_embedded") - F.col("n_exact")
    return counts.withColumns({"gap": gap, "verdict": F.when(gap > 0, "suspect: rows without vector").when(gap < 0, "suspect: more vectors than rows").otherwise("clean")})


def fleet(df: DataFrame, rules: Rules = R) -> DataFrame:
    """By territory and over all (territory null): decisions, exact ones and their share."""
    exact = F.count_if(scores.is_exact(F.col("match_type"), F.col("final_score"), rules))
    g = df.rollup("territory").agg(F.count(F.lit(1)).alias("n"), exact.alias("n_exact"))
    return g.withColumn("exact_share", F.round(F.coalesce(F.try_divide(F.col("n_exact").cast("double"), F.col("n")), F.lit(0.0)), 6))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def coverage(df: DataFrame) -> DataFrame:
    """coverage_pct of `done` among `total`, to one place; no rows count as one."""
    return df.withColumn("coverage_pct", F.round(F.col("done") * 100.0 / F.greatest(F.col("total"), F.lit(1)), 1))


def duplicate_keys(df: DataFrame, keys: list[str], limit: int = 10) -> DataFrame:
    """The report of the most repeated keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), *keys).limit(limit)


def sample_per_band(df: DataFrame, n: int = 5, rules: Rules = R) -> DataFrame:
    banded = df.withColumn("band", scores.band(F.col("final_score"), rules))
    w = Window.partitionBy("band").orderBy(F.desc("final_score"), "lead_id", "pos_id")
    return banded.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def state_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def counts_map(df: DataFrame, column: str) -> DataFrame:
    """One row with the counts of a column's values as a map."""
    g = state_counts(df, column)
    return g.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(column), F.col("n"))))).alias("counts"))


# ---- report and search ----
def star(decisions: DataFrame, leads: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Decisions with their lead, its account and their transaction."""
    return decisions.join(leads, "lead_id").join(accounts, "account_id").join(transactions, "pos_id")


@dataclass(frozen=True)
class SearchParams:
    lead: str = ""
    pos: str = ""
    match_type: str = ""
    lifecycle: str = ""
    min_score: float = 0
    max_score: float = 0
    primary_only: bool = False
    review_only: bool = False
    sort: str = "final_score"
    descending: bool = True
    limit: int = 100


def search(df: DataFrame, p: SearchParams) -> tuple[DataFrame, DataFrame]:
    """(rows, total): total counts before the limit, which is held between 1 and 10000. A score
    bound of 0 filters nothing; a missing score reads as 0; the upper bound is exclusive."""
    s = F.coalesce("final_score", F.lit(0.0))
    for on, c in (
        (p.lead, F.col("lead_id").cast("string").contains(p.lead)),
        (p.pos, F.col("pos_id").cast("string").contains(p.pos)),
        (p.match_type, F.col("match_type") == p.match_type),
        (p.lifecycle, F.col("lifecycle_state") == p.lifecycle if p.lifecycle else None),
        (p.min_score, s >= p.min_score),
        (p.max_score, s < p.max_score),
        (p.primary_only, F.col("primary_transaction") if p.primary_only else None),
        (p.review_only, F.col("match_type") == "Manual Review"),
    ):
        if on:
            df = df.where(c)
    order = F.desc_nulls_last(p.sort) if p.descending else F.asc_nulls_last(p.sort)
    rows = df.orderBy(order, "lead_id", "pos_id").limit(min(max(p.limit, 1), 10_000))
    return rows, df.agg(F.count(F.lit(1)).alias("total"))


def graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): one node for each lead and transaction, one edge for each decision, with score,
    match_type, lifecycle_state and primary_transaction; the last two are derived where df has none."""
    if "lifecycle_state" not in df.columns:
        df = df.withColumn("lifecycle_state", scores.lifecycle(F.col("match_type"), F.col("final_score")))
    if "primary_transaction" not in df.columns:
        df = matching.with_primary(df)
    leads = df.select(F.lit("Lead").alias("kind"), F.col("lead_id").cast("string").alias("id"))
    pos = df.select(F.lit("Pos").alias("kind"), F.col("pos_id").cast("string").alias("id"))
    edges = df.select(F.col("lead_id").cast("string").alias("source"), F.col("pos_id").cast("string").alias("target"), F.coalesce("final_score", F.lit(0.0)).alias("score"), "match_type", "lifecycle_state", "primary_transaction")
    return leads.union(pos).distinct(), edges


def territory_graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As graph(), with territories and, where there is one, members."""
    nodes, edges = graph(df)
    place = df.select(F.lit("Warehouse"), F.col("territory").cast("string"))
    member = df.where("coalesce(trim(member), '') <> ''").select(F.lit("Member"), F.trim("member"))
    at = df.select(F.col("pos_id").cast("string").alias("source"), F.col("territory").cast("string").alias("target"), F.lit("AT_WAREHOUSE").alias("edge"))
    belongs = df.where("coalesce(trim(member), '') <> ''").select(F.col("pos_id").cast("string"), F.trim("member"), F.lit("BELONGS_TO"))
    matched = edges.select("source", "target", F.lit("MATCHED_TO"))
    return nodes.union(place).union(member).distinct(), matched.union(at).union(belongs).distinct()


# ordered keyword rules: the first that fits gives the intent
INTENTS = [
    ("review", ("review", "ambiguous", "manual")),
    ("exact", ("exact", "closed")),
    ("potential", ("potential", "fuzzy", "likely")),
    ("unmatched", ("unmatched", "no match", "missing")),
    ("summary", ("summary", "overview", "how many", "count")),
]


def plan_question(text: str, hint: str = "") -> tuple[str, SearchParams]:
    """Intent of a question, and the search that answers it."""
    t = f"{text} {hint}".lower()
    intent = next((name for name, words in INTENTS if any(w in t for w in words)), "general")
    params = {"review": SearchParams(review_only=True, limit=5), "exact": SearchParams(min_score=100, limit=5), "potential": SearchParams(min_score=70, max_score=100, limit=5)}
    return intent, params.get(intent, SearchParams(limit=5))


def answer(df: DataFrame, text: str, hint: str = "") -> DataFrame:
    """Up to five samples with the total beside them."""
    _, params = plan_question(text, hint)
    rows, total = search(df, params)
    return rows.crossJoin(total)  # total is one row


# ---- quality ----
def band_audit(df: DataFrame, rules: Rules = R) -> DataFrame:
    """Scores of what is not exact: range, how many reach 100 or miss the floor, PASS or FAIL."""
    s = F.col("final_score")
    rest = df.where(~F.coalesce(F.lower("match_type").isin(*rules.exact_types), F.lit(False)))
    g = rest.agg(F.count(F.lit(1)).alias("n"), F.min(s).alias("lowest"), F.max(s).alias("highest"), F.count_if(s >= rules.exact_score).alias("n_too_high"), F.count_if(s < rules.floor).alias("n_too_low"))
    return g.withColumn("verdict", F.when((F.col("n_too_high") == 0) & (F.col("n_too_low") == 0), "PASS").otherwise("FAIL"))


def reconciliation(decisions: DataFrame, transactions: DataFrame, rules: Rules = R) -> DataFrame:
    """How many transactions have an exact decision but are not marked as exact."""
    exact = decisions.where(scores.is_exact(F.col("match_type"), F.col("final_score"), rules)).select("pos_id").distinct()
    bad = exact.join(transactions, "pos_id").where(~F.coalesce(F.lower("tx_type").isin(*rules.exact_types), F.lit(False)))
    return bad.agg(F.count(F.lit(1)).alias("n_unreconciled")).withColumn("verdict", F.when(F.col("n_unreconciled") == 0, "PASS").otherwise("FAIL"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")


def diagnose(counts: DataFrame) -> DataFrame:
    """From n_leads, n_pos and n_embedded of each territory: what is wrong, and the coverage."""
    empty, no_pos, no_leads = (F.col("n_leads") == 0) & (F.col("n_pos") == 0), F.col("n_pos") == 0, F.col("n_leads") == 0
    finding = F.when(empty, "empty").when(no_pos, "leads without transactions").when(no_leads, "transactions without leads").when(F.col("n_embedded") < F.col("n_pos"), "transactions without vectors").otherwise("ok")
    pct = F.round(F.col("n_embedded") * 100.0 / F.greatest(F.col("n_pos"), F.lit(1)), 1)
    return counts.withColumns({"finding": finding, "coverage_pct": pct})
