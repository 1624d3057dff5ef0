"""The whole match: exact pairs, vectors, candidates, scores, resolution, and the run's tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import Rules
from .functions import embed, normalize, scores, vectors
from .operators import matching, neighbours, records, writeback
from .sources.scratch import written

R = Rules()
KEYS = ["territory", "business_name", "address", "city", "state", "zip"]


@dataclass
class Run:
    decisions: DataFrame
    candidates: DataFrame
    ce_stubs: DataFrame


def identity(df: DataFrame, prefix: str) -> DataFrame:
    """Keys of the exact join and the texts that are embedded, from raw columns."""
    c = F.col
    return df.select(
        f"{prefix}_id", "territory", c("year").alias(f"{prefix}_year"), c("period").alias(f"{prefix}_period"), c("week").alias(f"{prefix}_week"),
        normalize.text(c("name"), True).alias("business_name"), normalize.address(c("street")).alias("address"), normalize.text(c("town"), True).alias("city"),
        normalize.state(c("region")).alias("state"), normalize.zip_code(c("postcode")).alias("zip"),
        normalize.email(c("email")).alias(f"{prefix}_email"), normalize.phone(c("phone")).alias(f"{prefix}_phone"),
    )


def variants(pos: DataFrame, rules: Rules) -> tuple[DataFrame, list[str], list[str]]:
    """pos_id and a transaction's texts by variant, normalised as the first ones, with the contacts
    that go with each address; the columns of names and of addresses. Later variants are in
    columns of the same names with _2, _3; those that are not there are null."""
    raw = lambda n, i: F.col(x) if (x := n if i == 0 else f"{n}_{i + 1}") in pos.columns else F.lit(None).cast("string")
    blank = lambda x: F.nullif(x, F.lit(""))
    names, addresses = ({x: f"{kind}_{x}" for x in range(1 + max(s[at] for s in rules.sets))} for at, kind in enumerate(("name", "address")))
    cols = [blank(normalize.text(raw("name", i), True)).alias(c) for i, c in names.items()]
    for i, c in addresses.items():
        parts = [normalize.address(raw("street", i)), normalize.text(raw("town", i), True), normalize.state(raw("region", i)), normalize.zip_code(raw("postcode", i))]
        text = F.concat_ws(" ", *parts)
        cols += [F.when(F.trim(text) != "", text).alias(c), normalize.email(raw("email", i)).alias(f"email_{i}"), normalize.phone(raw("phone", i)).alias(f"phone_{i}")]
    return pos.select("pos_id", *cols), list(names.values()), list(addresses.values())


def eligible(leads: DataFrame, pos: DataFrame, decisions: DataFrame | None = None, rules: Rules = R) -> tuple[DataFrame, DataFrame]:
    """Leads and transactions that a run may match: no transaction that is processed already; none, and
    no lead, that an exact decision owns or that an exactly matched transaction shows (columns
    is_processed, lead_id, match_type and match_score of pos, where it has them)."""
    if "is_processed" in pos.columns:
        pos = pos.where(~F.coalesce("is_processed", F.lit(False)))
    if decisions is not None:
        leads = matching.exclude_exact(leads, "lead_id", decisions, rules=rules)
        pos = matching.exclude_exact(pos, "pos_id", decisions, rules=rules)
    if {"lead_id", "match_type", "match_score"} <= set(pos.columns):
        own = scores.is_exact(F.col("match_type"), F.col("match_score"), rules)
        leads = leads.join(pos.where(own).select("lead_id"), "lead_id", "left_anti")
        pos = pos.where(~F.coalesce(own, F.lit(False)))
    return leads, pos


def vectored(df: DataFrame, key: str, texts: list[str], known: DataFrame) -> DataFrame:
    """df with a vector {text}_v for each column of texts, which go; one join, whatever their number."""
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(t).alias("c"), F.col(t).alias("text")) for t in texts])).alias("e")).select(key, "e.*")
    found = long.join(known, "text").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("c", "v"))).alias("__v"))
    return df.drop(*texts).join(found, key, "left").withColumns({f"{t}_v": F.col("__v")[t] for t in texts}).drop("__v")


def candidates(x: DataFrame, y: DataFrame, recall: dict[str, tuple[str, str]], rules: Rules) -> DataFrame:
    """lead_id, pos_id, raw and rank of every pair that any way of recall finds (a vector column of leads and
    one of transactions): the best score and rank it has by any. One pruned search for all of them, in
    which a territory has a block for each way, so what one finds does not take the place of what
    another finds."""
    ways = lambda df, side, key: df.where("territory IS NOT NULL").select(
        key, F.explode(F.array(*[F.struct(F.concat_ws("|", F.col("territory").cast("string"), F.lit(w)).alias("block"), F.col(c[side]).alias("v")) for w, c in recall.items()])).alias("e")
    ).select(key, "e.*")
    found = neighbours.nearest(ways(x, 0, "lead_id"), ways(y, 1, "pos_id"), "block", rules.top_k, rules.recall_gate)
    return found.groupBy("lead_id", "pos_id").agg(F.max("raw").alias("raw"), F.min("rank").alias("rank"))


def match(leads: DataFrame, pos: DataFrame, run: str, rules: Rules = R, embedder=embed.hashed, accounts: DataFrame | None = None, decisions: DataFrame | None = None) -> Run:
    """Leads and transactions have id, territory, year, period, week, name, street, town, region,
    postcode, email and phone; transactions may have more of the last seven (see variants). Every
    pair that the combined text (name and address) or an address variant recalls is scored once by the
    best of the sets. Leads with an account_id take their contacts from `accounts`, where it is given;
    what decisions of earlier runs, or the transactions themselves, own exactly is left out."""
    leads, pos = eligible(leads, pos, decisions, rules)
    if accounts is not None:
        leads = records.with_contacts(leads.drop("email", "phone"), accounts)
    a, b = identity(leads, "lead"), identity(pos, "pos")
    exact = matching.exact_pairs(a, b, KEYS)  # in whatever fiscal order
    exact = written(exact.select("lead_id", "pos_id", "territory", "pos_year", "pos_period", "pos_week", F.lit(rules.exact_score).alias("final_score"), F.lit("Exact").alias("match_type"), F.lit(None).cast("int").alias("winning_set")), "exact")
    rest_a, rest_b = a.join(exact.select("lead_id"), "lead_id", "left_anti"), b.join(exact.select("pos_id"), "pos_id", "left_anti")
    rest_a = rest_a.withColumn("address_text", F.nullif(F.trim(F.concat_ws(" ", "address", "city", "state", "zip")), F.lit("")))
    both = lambda n, t: F.nullif(normalize.joined(F.col(n), F.col(t)), F.lit(""))
    rest_a = rest_a.withColumn("combined", both("business_name", "address_text"))
    texts, names, addresses = variants(pos, rules)
    rest_b = rest_b.select("pos_id", "territory", "pos_year", "pos_period", "pos_week").join(texts, "pos_id").withColumn("combined", both(names[0], addresses[0]))
    every = rest_a.select(F.array("business_name", "address_text", "combined").alias("t")).union(rest_b.select(F.array(*names, *addresses, "combined")))
    known = written(embed.embed_distinct(every.select(F.explode("t").alias("text")), ["text"], embedder), "vectors")
    x = written(vectored(rest_a, "lead_id", ["business_name", "address_text", "combined"], known), "leads")
    x = x.select("territory", "lead_id", "lead_year", "lead_period", "lead_week", "lead_email", "lead_phone", F.col("business_name_v").alias("name_v"), F.col("address_text_v").alias("v"), F.col("combined_v").alias("lead_combined_v"))
    y = written(vectored(rest_b, "pos_id", [*names, *addresses, "combined"], known), "transactions")
    near = candidates(x, y, {"combined": ("lead_combined_v", "combined_v")} | {c: ("v", f"{c}_v") for c in addresses}, rules)
    pairs = matching.with_fiscal_class(near.join(x, "lead_id").join(y.drop("territory"), "pos_id"), rules)
    # a lead without a name scores 0 by each name that the transaction has
    name = lambda c: F.when(F.col(f"{c}_v").isNotNull(), F.coalesce(vectors.score(F.col("name_v"), F.col(f"{c}_v")), F.lit(0.0)))
    pairs = pairs.withColumn("combined_score", vectors.score(F.col("lead_combined_v"), F.col("combined_v")))
    pairs = pairs.withColumns({f"{c}_s": name(c) for c in names} | {f"{c}_s": vectors.score(F.col("v"), F.col(f"{c}_v")) for c in addresses})
    scored = matching.score_sets(pairs, [f"{c}_s" for c in names], [f"{c}_s" for c in addresses], rules)
    own = lambda kind: F.element_at(F.array(*[F.col(f"{kind}_{s[1]}") for s in rules.sets]), F.col("winning_set"))
    same = lambda kind: scores.same_contact(F.col(f"lead_{kind}"), own(kind))
    none = F.lit(False)
    scored = scored.withColumns({"email_boost": scores.boost(same("email"), none, rules), "phone_boost": scores.boost(none, same("phone"), rules)})
    scored = scored.withColumn("final_score", scores.final_score(F.col("best_score") + F.col("email_boost") + F.col("phone_boost"), rules))
    spare = [f"{c}_{e}" for c in (*names, *addresses) for e in "vs"] + [f"{k}_{i}" for i in range(len(addresses)) for k in ("email", "phone")]
    scored = written(scored.drop("name_v", "v", "lead_combined_v", "combined_v", *spare), "candidates")
    fuzzy = matching.resolve(scored.where("fiscal_class = 'NORMAL'"), rules)
    more = ["combined_score", "name_score", "address_score", "email_boost", "phone_boost"]
    decided = matching.combine(exact, fuzzy.select(*exact.columns, *more)).withColumn("match_run_id", F.lit(run))
    decided = decided.withColumn("lifecycle_state", scores.lifecycle(F.col("match_type"), F.col("final_score"), rules))
    return Run(matching.with_primary(decided, rules), matching.debug_candidates(scored, rules), writeback.ce_stubs(scored, exact))
