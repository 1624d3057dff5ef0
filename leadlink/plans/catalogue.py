"""Every query of the driver contract, with its SQL twin.

The driver's tables hold no leads or transactions, so proxies stand for them: orders and line items
for decisions and transactions, customers for accounts, embeddings for vectors, with their label as
territory. A proxy is one SELECT that both engines run; what is tested is the operator above it."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import embed, fiscal, normalize, scores, vectors
from ..operators import analytics, matching, records, steps, writeback
from ..schemas import OUTPUT_36, conform

QUERIES: dict = {}
SQL: dict[str, str] = {}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings clients"
#: The synthetic vectors are far apart, so the gate and floor of these queries are lower.
GATE = Rules(recall_gate=15.0, floor=15.0, medium=20.0, high=25.0)


def proxy(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Runs a proxy's SELECT on the Parquet files of sf_dir."""
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(TABLES.split())})\b", lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet` {m[2]}", sql))


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


PERIOD = "CAST(least(13, floor((dayofyear({0}) - 1) / 28) + 1) AS INT)"
WEEK = "CAST(floor((dayofyear({0}) - 1) / 7) + 1 AS INT)"
# lead, transaction and decision rows from orders; several orders share a transaction
DECISIONS = f"""SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'run1' ELSE 'run2' END AS match_run_id,
 o_custkey AS lead_id, o_orderkey - o_orderkey % 4 AS pos_id, o_orderkey AS created, CAST(o_custkey % 25 AS INT) AS territory,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Exact' WHEN '2-HIGH' THEN 'Fuzzy' WHEN '3-MEDIUM' THEN 'Fuzzy' WHEN '4-NOT SPECIFIED' THEN 'Manual Review' ELSE 'No Match' END AS match_type,
 CAST(CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 100 END WHEN '5-LOW' THEN NULL ELSE 60 + (o_orderkey * 37 + o_custkey * 11) % 3900 / 100 END AS DOUBLE) AS raw_score,
 CAST(year(o_orderdate) AS INT) AS pos_year, {PERIOD.format("o_orderdate")} AS pos_period, {WEEK.format("o_orderdate")} AS pos_week, o_totalprice AS order_amount, o_orderstatus AS status
 FROM orders"""
DECIDED = f"SELECT *, round(raw_score, 2) AS final_score FROM ({DECISIONS}) d0"
TRANSACTIONS = "SELECT DISTINCT o_orderkey - o_orderkey % 4 AS pos_id FROM orders"
EXACT = "(lower(match_type) IN ('exact', 'exact match', 'exact_match', 'match', 'deterministic') AND (final_score IS NULL OR final_score >= 100))"
PRIORITY = "CASE WHEN lower({0}) IN ('exact', 'exact match', 'exact_match', 'match', 'deterministic') THEN 3 WHEN lower({0}) = 'fuzzy' THEN 2 WHEN lower({0}) = 'manual review' THEN 1 ELSE 0 END"
FUZZY = "lower(match_type) IN ('fuzzy', 'manual review')"
BAND = "CASE WHEN final_score >= 100 THEN 'Exact' WHEN final_score >= 90 THEN 'High' WHEN final_score >= 85 THEN 'Medium' WHEN final_score >= 70 THEN 'Low' ELSE 'Below' END"
LIFE = f"CASE WHEN {EXACT} THEN 'Closed - Exact' WHEN {FUZZY} AND final_score >= 70 THEN 'Potential' ELSE 'No Match' END"
SCORED = f"SELECT * FROM ({DECIDED}) d1 WHERE final_score IS NOT NULL AND final_score < 100"


def decisions(spark, d, sql=DECIDED):
    return proxy(spark, d, sql)


def embeddings(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    return e.select(F.col("label").alias("territory"), "vec_id", "embedding")


# ---- nearest neighbours ----
PAIRS = """pairs AS (
  SELECT a.label AS territory, a.vec_id AS lead_id, b.vec_id AS pos_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) * 100 AS raw
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
), knn AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY territory, lead_id ORDER BY raw DESC, pos_id) AS rank FROM pairs WHERE raw >= 15) WHERE rank <= 20
)"""
KNN_SQL = f"WITH {PAIRS} SELECT territory, lead_id, pos_id, round(raw, 2) AS score, CAST(rank AS INT) AS rank FROM knn"


def knn(spark, d, by=matching.knn_blocked, **options):
    e = embeddings(spark, d)
    left = e.select("territory", F.col("vec_id").alias("lead_id"), F.col("embedding").alias("v"))
    right = e.select("territory", F.col("vec_id").alias("pos_id"), F.col("embedding").alias("v"))
    return by(left, right, "territory", k=20, gate=GATE.recall_gate, distinct_ids=True, **options)


@query("q_knn_blocked_topk", KNN_SQL)
def q_knn(spark, d):
    return knn(spark, d).select("territory", "lead_id", "pos_id", F.round("raw", 2).alias("score"), "rank")


@query("q_knn_matmul", KNN_SQL)
def q_knn_matmul(spark, d):
    return knn(spark, d, matching.knn_matmul).select("territory", "lead_id", "pos_id", F.round("raw", 2).alias("score"), "rank")


RESOLVED = f"""{PAIRS}, scored AS (SELECT territory, lead_id, pos_id, least(99.999::DOUBLE, round(raw, 2)) AS final_score FROM knn),
ranked AS (
  SELECT *, row_number() OVER w AS n, lead(final_score) OVER w AS next_score FROM scored WHERE final_score >= 15
  WINDOW w AS (PARTITION BY pos_id ORDER BY final_score DESC, lead_id)
), resolved AS (
  SELECT territory, lead_id, pos_id, final_score, next_score,
    CASE WHEN next_score IS NOT NULL AND round(final_score - next_score, 6) <= 3 THEN 'Manual Review' ELSE 'Fuzzy' END AS match_type
  FROM ranked WHERE n = 1
)"""


def resolved(spark, d):
    found = knn(spark, d).withColumn("final_score", scores.final_score(F.col("raw"), GATE))
    return matching.resolve(found, GATE).select("territory", "lead_id", "pos_id", "final_score", "next_score", "match_type")


@query("q_resolve_one_to_one", f"WITH {RESOLVED} SELECT * FROM resolved")
def q_resolve(spark, d):
    return resolved(spark, d)


# set by set, as the contract has them: name 0, 1, 0, 1, 0, 2 by address 0, 0, 1, 1, 2, 2; NaN counts as 0
SIX_SQL = f"""WITH {PAIRS}, v AS (
  SELECT territory, lead_id, pos_id, raw, CASE WHEN pos_id % 7 = 0 THEN NULL WHEN pos_id % 11 = 0 THEN 0 ELSE raw END AS n1, CASE WHEN pos_id % 4 = 0 THEN NULL ELSE raw * 0.9 END AS n2,
    CASE WHEN pos_id % 5 = 0 THEN NULL WHEN pos_id % 6 = 0 THEN 0 ELSE raw * 1.05 END AS n3, CASE WHEN pos_id % 13 = 0 THEN NULL ELSE raw * 0.8 + 2 END AS a1, CASE WHEN pos_id % 3 = 0 THEN NULL ELSE raw END AS a2, CASE WHEN pos_id % 2 = 0 THEN NULL ELSE raw * 1.1 END AS a3 FROM knn
), s AS (
  SELECT *, (4 * a1 + 3 * n1) / 7 AS set1, (4 * a1 + 3 * n2) / 7 AS set2, (4 * a2 + 3 * n1) / 7 AS set3, (4 * a2 + 3 * n2) / 7 AS set4, (4 * a3 + 3 * n1) / 7 AS set5, (4 * a3 + 3 * n3) / 7 AS set6 FROM v
), g AS (
  SELECT *, greatest(coalesce(set1, -1), coalesce(set2, -1), coalesce(set3, -1), coalesce(set4, -1), coalesce(set5, -1), coalesce(set6, -1)) AS best FROM s
), w AS (
  SELECT *, CASE best WHEN set1 THEN 1 WHEN set2 THEN 2 WHEN set3 THEN 3 WHEN set4 THEN 4 WHEN set5 THEN 5 ELSE 6 END AS w FROM g WHERE best >= 0
) SELECT lead_id, pos_id, round(best, 2) AS best_score, CAST(w AS INT) AS winning_set,
  round(CASE WHEN w IN (1, 3, 5) THEN n1 WHEN w IN (2, 4) THEN n2 ELSE n3 END, 2) AS name_score, round(CASE WHEN w <= 2 THEN a1 WHEN w <= 4 THEN a2 ELSE a3 END, 2) AS address_score FROM w"""


def six(spark, d):
    raw, p, nan = F.col("raw"), F.col("pos_id"), F.lit(float("nan"))
    v = knn(spark, d).withColumns({
        "n1": F.when(p % 7 == 0, None).when(p % 11 == 0, nan).otherwise(raw), "n2": F.when(p % 4 != 0, raw * 0.9), "n3": F.when(p % 5 == 0, None).when(p % 6 == 0, nan).otherwise(raw * 1.05),
        "a1": F.when(p % 13 != 0, raw * 0.8 + 2), "a2": F.when(p % 3 != 0, raw), "a3": F.when(p % 2 != 0, raw * 1.1),
    })
    return matching.score_sets(v, ["n1", "n2", "n3"], ["a1", "a2", "a3"], GATE)


@query("q_six_set_best", SIX_SQL)
def q_six(spark, d):
    r = lambda c: F.round(c, 2).alias(c)
    return six(spark, d).select("lead_id", "pos_id", r("best_score"), "winning_set", r("name_score"), r("address_score"))


@query("q_reasoning", f"""WITH x AS ({SIX_SQL}) SELECT lead_id, pos_id,
  printf('address %.2f, name %.2f, boost %.0f: %.2f by %s', address_score, name_score, 0.0::DOUBLE, least(99.999::DOUBLE, round((address_score * 4 + name_score * 3) / 7, 2)),
    CASE WHEN abs(address_score - name_score) < 1 THEN 'balanced' WHEN address_score > name_score THEN 'address' ELSE 'name' END) AS match_reasoning,
  abs(least(99.999::DOUBLE, round((address_score * 4 + name_score * 3) / 7, 2)) - best_score) <= 0.0100001 AS checked FROM x""")
def q_reasoning(spark, d):
    s = q_six(spark, d)
    text, _ = scores.reasoning(F.col("address_score"), F.col("name_score"), F.lit(0.0), F.col("best_score"))
    again = scores.final_score(scores.set_score(F.col("address_score"), F.col("name_score")))
    return s.select("lead_id", "pos_id", text.alias("match_reasoning"), (F.abs(again - F.col("best_score")) <= 0.0100001).alias("checked"))


@query("q_boosts_cap", f"""WITH {PAIRS} SELECT lead_id, pos_id, CASE WHEN lead_id % 7 = pos_id % 7 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS email_boost,
  CASE WHEN lead_id % 5 = pos_id % 5 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS phone_boost,
  least(99.999::DOUBLE, round(raw * 2 + CASE WHEN lead_id % 7 = pos_id % 7 THEN 5 ELSE 0 END + CASE WHEN lead_id % 5 = pos_id % 5 THEN 5 ELSE 0 END, 2)) AS final_score FROM knn""")
def q_boosts(spark, d):
    e, p = F.col("lead_id") % 7 == F.col("pos_id") % 7, F.col("lead_id") % 5 == F.col("pos_id") % 5
    n = F.lit(False)
    return knn(spark, d).select("lead_id", "pos_id", scores.boost(e, n).alias("email_boost"), scores.boost(n, p).alias("phone_boost"), scores.final_score(F.col("raw") * 2 + scores.boost(e, p)).alias("final_score"))


# every client, with the contacts of its account as a lead's and its own as a transaction's
# (the table has no phones: the nation's number stands for them, written in two ways)
CLIENTS = "SELECT client_id AS pos_id, master_id AS account_id, email AS own_email, '1-206-' || lpad(CAST(nation_id AS STRING), 7, '0') AS own_phone FROM clients"
CLIENT_CONTACTS = "SELECT client_id AS account_id, min(email) AS email, '(206) ' || lpad(CAST(min(nation_id) AS STRING), 7, '0') AS phone FROM clients GROUP BY client_id"
DIGITS = "regexp_replace(coalesce({0}, ''), '[^0-9]', '', 'g')"
PHONE = f"CASE WHEN length({DIGITS}) = 11 AND {DIGITS} LIKE '1%' THEN substr({DIGITS}, 2) WHEN length({DIGITS}) = 10 THEN {DIGITS} ELSE '' END"
MAIL = "lower(trim(coalesce({0}, '')))"


@query("q_contact_boosts", f"""WITH x AS (SELECT pos_id, c.account_id, {MAIL.format("email")} AS email, {PHONE.format("phone")} AS phone, {MAIL.format("own_email")} AS own_email, {PHONE.format("own_phone")} AS own_phone
  FROM ({CLIENTS}) c LEFT JOIN ({CLIENT_CONTACTS}) a ON a.account_id = c.account_id),
 b AS (SELECT *, CASE WHEN email <> '' AND email = own_email THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS email_boost, CASE WHEN phone <> '' AND phone = own_phone THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END AS phone_boost FROM x)
 SELECT *, least(99.999::DOUBLE, round(91 + email_boost + phone_boost, 2)) AS final_score FROM b""")
def q_contacts_boost(spark, d):
    x = records.with_contacts(proxy(spark, d, CLIENTS), proxy(spark, d, CLIENT_CONTACTS))
    x = x.withColumns({c: normalize.email(F.col(c)) for c in ("email", "own_email")} | {c: normalize.phone(F.col(c)) for c in ("phone", "own_phone")})
    same, none = {k: scores.same_contact(F.col(k), F.col(f"own_{k}")) for k in ("email", "phone")}, F.lit(False)
    x = x.withColumns({"email_boost": scores.boost(same["email"], none), "phone_boost": scores.boost(none, same["phone"])})
    return x.withColumn("final_score", scores.final_score(F.lit(91.0) + F.col("email_boost") + F.col("phone_boost")))


@query("q_l2_normalize", """SELECT vec_id, CAST(len(embedding) AS INT) AS dim,
  round(list_sum(list_transform(embedding::DOUBLE[], lambda x: round(x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 8))), 5) AS total FROM embeddings""")
def q_l2(spark, d):
    v = embeddings(spark, d).withColumn("u", vectors.l2_normalize(F.col("embedding")))
    return v.select("vec_id", F.size("u").alias("dim"), F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query("q_debug_candidates", f"""WITH {PAIRS} SELECT lead_id, pos_id, round(raw, 2) AS final_score, c AS fiscal_class,
  CASE WHEN c <> 'NORMAL' THEN c WHEN round(raw, 2) >= 20 THEN 'Potential' ELSE 'No Match' END AS decision
  FROM (SELECT *, CASE pos_id % 4 WHEN 0 THEN 'CE' WHEN 1 THEN 'OAF' ELSE 'NORMAL' END AS c FROM knn)""")
def q_debug(spark, d):
    c = F.col("pos_id") % 4
    p = knn(spark, d).withColumns({"final_score": F.round("raw", 2), "fiscal_class": F.when(c == 0, "CE").when(c == 1, "OAF").otherwise("NORMAL")})
    return matching.debug_candidates(p, Rules(floor=20.0)).select("lead_id", "pos_id", "final_score", "fiscal_class", "decision")


# ---- identity, fiscal order ----
@query("q_exact_identity_join", """SELECT c.c_custkey AS lead_id, s.s_suppkey AS pos_id, c.c_nationkey AS territory FROM customer c JOIN supplier s
  ON c.c_nationkey = s.s_nationkey AND substr(c.c_name, 10) = substr(s.s_name, 10)
  AND CAST(c.c_custkey % 100 AS INT) = CAST(s.s_suppkey % 100 AS INT)
  UNION ALL SELECT c.c_custkey, a.c_custkey, c.c_nationkey FROM customer c JOIN customer a ON c.c_nationkey = a.c_nationkey AND upper(c.c_name) = upper(a.c_name) AND c.c_mktsegment = a.c_mktsegment""")
def q_exact(spark, d):
    c, s = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("customer", "supplier"))
    number = lambda x: normalize.digits(F.col(x))
    leads = c.select(F.col("c_custkey").alias("lead_id"), F.col("c_nationkey").alias("territory"), number("c_name").alias("k1"), (F.col("c_custkey") % 100).cast("int").alias("k2"))
    pos = s.select(F.col("s_suppkey").alias("pos_id"), F.col("s_nationkey").alias("territory"), number("s_name").alias("k1"), (F.col("s_suppkey") % 100).cast("int").alias("k2"))
    first = matching.exact_pairs(leads, pos, ["territory", "k1", "k2"]).select("lead_id", "pos_id", "territory")
    key = lambda i: c.select(F.col("c_custkey").alias(i), F.col("c_nationkey").alias("territory"), normalize.text(F.col("c_name"), True).alias("k1"), F.col("c_mktsegment").alias("k2"))
    return first.union(matching.exact_pairs(key("lead_id"), key("pos_id"), ["territory", "k1", "k2"]).select("lead_id", "pos_id", "territory"))


FISCAL = f"""SELECT l_orderkey AS lead_id, l_partkey AS pos_id, l_linenumber AS line,
 CAST(year(o_orderdate) AS INT) AS lead_year, {PERIOD.format("o_orderdate")} AS lead_period, {WEEK.format("o_orderdate")} AS lead_week,
 CAST(year(l_shipdate) AS INT) AS pos_year, {PERIOD.format("l_shipdate")} AS pos_period, {WEEK.format("l_shipdate")} AS pos_week
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
FISCAL_CLASS = "CASE WHEN NOT (pos_year < lead_year OR pos_year = lead_year AND pos_period < lead_period) THEN 'NORMAL' WHEN (lead_year - pos_year) * 13 + lead_period - pos_period <= 6 THEN 'CE' ELSE 'OAF' END"


@query("q_fiscal_three_way", f"SELECT lead_id, pos_id, line, (lead_year - pos_year) * 13 + lead_period - pos_period AS gap, {FISCAL_CLASS} AS fiscal_class FROM ({FISCAL})")
def q_fiscal(spark, d):
    return matching.with_fiscal_class(proxy(spark, d, FISCAL)).select("lead_id", "pos_id", "line", "gap", "fiscal_class")


@query("q_fiscal_week_grain", f"""SELECT lead_id, pos_id, line, CASE WHEN NOT (pos_year < lead_year OR pos_year = lead_year AND (pos_period < lead_period OR pos_period = lead_period AND pos_week < lead_week)) THEN 'NORMAL'
  WHEN (lead_year - pos_year) * 13 + lead_period - pos_period <= 6 THEN 'CE' ELSE 'OAF' END AS fiscal_class, (pos_year, pos_period, pos_week) < (lead_year, lead_period, lead_week) AS predates FROM ({FISCAL})""")
def q_fiscal_week(spark, d):
    f = proxy(spark, d, FISCAL)
    c = [F.col(x) for x in ("lead_year", "lead_period", "lead_week", "pos_year", "pos_period", "pos_week")]
    return f.select("lead_id", "pos_id", "line", fiscal.fiscal_class(*c, Rules(grain="week")).alias("fiscal_class"), fiscal.predates(*c).alias("predates"))


@query("q_fiscal_shift", f"""SELECT lead_id, pos_id, line, CAST(floor((lead_year * 13 + lead_period - 1 - 5) / 13) AS INT) AS year_before, CAST((lead_year * 13 + lead_period - 1 - 5) % 13 + 1 AS INT) AS period_before FROM ({FISCAL})""")
def q_shift(spark, d):
    y, p = fiscal.shift_back(F.col("lead_year"), F.col("lead_period"), 5)
    return proxy(spark, d, FISCAL).select("lead_id", "pos_id", "line", y.alias("year_before"), p.alias("period_before"))


@query("q_primary_transaction", f"""SELECT lead_id, pos_id, created, coalesce(final_score >= 70, false) AND row_number() OVER (PARTITION BY lead_id, coalesce(final_score >= 70, false) ORDER BY pos_year, pos_period, pos_week, pos_id, created) = 1 AS primary_transaction FROM ({DECIDED})""")
def q_primary(spark, d):
    # several orders are one transaction here, so the order's key breaks ties
    return matching.with_primary(decisions(spark, d).withColumn("p", F.col("pos_id")).withColumn("pos_id", F.struct("p", "created"))).select("lead_id", F.col("p").alias("pos_id"), "created", "primary_transaction")


@query("q_primary_exact_only", f"""SELECT lead_id, created, {EXACT} AND row_number() OVER (PARTITION BY lead_id, coalesce({EXACT}, false) ORDER BY pos_year, pos_period, pos_week, created) = 1 AS primary_transaction FROM ({DECIDED}) WHERE match_type <> 'No Match'""")
def q_primary_exact(spark, d):
    x = decisions(spark, d).where("match_type <> 'No Match'").withColumn("pos_id", F.col("created"))
    return matching.with_primary(x, qualifies=scores.is_exact(F.col("match_type"), F.col("final_score"))).select("lead_id", "created", "primary_transaction")


# ---- decisions and write-back ----
LATEST = f"""latest AS (SELECT * FROM (SELECT *, {PRIORITY.format("match_type")} AS priority,
  row_number() OVER (PARTITION BY pos_id ORDER BY {PRIORITY.format("match_type")} DESC, final_score DESC NULLS LAST, created DESC, lead_id) AS n FROM ({DECIDED})) WHERE n = 1)"""


@query("q_decision_priority", f"WITH {LATEST} SELECT pos_id, lead_id, match_type, priority, final_score FROM latest")
def q_priority(spark, d):
    return writeback.latest_decision(decisions(spark, d)).select("pos_id", "lead_id", "match_type", "priority", "final_score")


@query("q_lifecycle_rollup", f"""SELECT lead_id, CASE WHEN bool_or({EXACT}) THEN 'exact' WHEN bool_or({FUZZY} AND final_score >= 70) THEN 'potential' ELSE 'none' END AS lead_state, count(*) AS n_decisions FROM ({DECIDED}) GROUP BY lead_id""")
def q_rollup(spark, d):
    return writeback.lead_states(decisions(spark, d))


HAD = "CASE WHEN pos_id % 8 = 0 THEN 'Exact' WHEN pos_id % 12 = 4 THEN 'Fuzzy' END"


def snapshot(spark, d):
    t = proxy(spark, d, TRANSACTIONS)
    return t.withColumns({"match_type": F.expr(HAD), "lead_id": F.lit(-1).cast("long"), "match_score": F.lit(80.0), "is_processed": F.col("pos_id") % 16 == 0})


@query("q_guarded_overlay", f"""WITH {LATEST}, t AS (SELECT pos_id, {HAD} AS match_type, -1::BIGINT AS lead_id, 80.0::DOUBLE AS match_score, pos_id % 16 = 0 AS is_processed FROM ({TRANSACTIONS})),
 j AS (SELECT t.*, l.lead_id AS nl, l.final_score AS ns, l.match_type AS nt, coalesce(l.priority >= {PRIORITY.format("t.match_type")}, false) AS take FROM t LEFT JOIN latest l ON l.pos_id = t.pos_id)
 SELECT pos_id, CASE WHEN take THEN nl ELSE lead_id END AS lead_id, CASE WHEN take THEN ns ELSE match_score END AS match_score, CASE WHEN take THEN nt ELSE match_type END AS match_type, take OR is_processed AS is_processed FROM j""")
def q_overlay(spark, d):
    return writeback.overlay(snapshot(spark, d), writeback.latest_decision(decisions(spark, d))).select("pos_id", "lead_id", "match_score", "match_type", "is_processed")


@query("q_write_back_leads", f"""WITH d AS ({DECIDED}), s AS (
  SELECT lead_id, CASE WHEN bool_or({EXACT}) THEN 'exact' WHEN bool_or({FUZZY} AND final_score >= 70) THEN 'potential' ELSE 'none' END AS st FROM d WHERE match_run_id = 'run2' GROUP BY lead_id),
 o AS (SELECT DISTINCT lead_id FROM d WHERE match_run_id <> 'run2' AND {EXACT})
 SELECT c_custkey AS lead_id, CASE WHEN s.st IS NOT NULL AND (o.lead_id IS NULL OR s.st = 'exact') THEN s.st ELSE 'old' END AS match_result
 FROM customer LEFT JOIN s ON s.lead_id = c_custkey LEFT JOIN o ON o.lead_id = c_custkey""")
def q_write_back(spark, d):
    leads = proxy(spark, d, "SELECT c_custkey AS lead_id, 'old' AS match_result FROM customer")
    return writeback.write_back(decisions(spark, d), snapshot(spark, d), leads, "run2")[1]


@query("q_ce_stubs", f"""SELECT lead_id, pos_id, line, 0.0::DOUBLE AS final_score, 'Closed - Existing' AS lifecycle_state FROM ({FISCAL}) f WHERE {FISCAL_CLASS} = 'CE'
  AND NOT EXISTS (SELECT 1 FROM ({DECIDED}) x WHERE x.pos_id = f.pos_id AND {EXACT})""")
def q_stubs(spark, d):
    exact = decisions(spark, d).where(scores.is_exact(F.col("match_type"), F.col("final_score")))
    return writeback.ce_stubs(matching.with_fiscal_class(proxy(spark, d, FISCAL)), exact).select("lead_id", "pos_id", "line", "final_score", "lifecycle_state")


@query("q_exact_exclusion_anti", f"SELECT c_custkey AS lead_id, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM ({DECIDED}) x WHERE x.lead_id = c_custkey AND {EXACT} AND status = 'F') ")
def q_exclusion(spark, d):
    leads = proxy(spark, d, "SELECT c_custkey AS lead_id, c_name FROM customer")
    return matching.exclude_exact(leads, "lead_id", decisions(spark, d).where("status = 'F'"))


@query("q_new_only_anti", "SELECT c_custkey, c_name, coalesce(nullif(trim(c_mktsegment), ''), 'none') AS segment FROM customer WHERE NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = c_custkey) ")
def q_new_only(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_name", F.coalesce(normalize.filled(F.col("c_mktsegment")), F.lit("none")).alias("segment"))
    return matching.new_only(c, embeddings(spark, d).withColumnRenamed("vec_id", "c_custkey"), "c_custkey")


@query("q_semi_current_run", f"""WITH d AS ({DECIDED}) SELECT c_custkey AS lead_id, EXISTS (SELECT 1 FROM d WHERE d.lead_id = c_custkey AND match_run_id = 'run2' AND {EXACT}) AS exact_now,
  EXISTS (SELECT 1 FROM d WHERE d.lead_id = c_custkey AND match_run_id <> 'run2' AND {EXACT}) AS exact_before FROM customer""")
def q_semi(spark, d):
    exact = decisions(spark, d).where(scores.is_exact(F.col("match_type"), F.col("final_score")))
    flags = exact.groupBy("lead_id").agg(F.bool_or(F.col("match_run_id") == "run2").alias("exact_now"), F.bool_or(F.col("match_run_id") != "run2").alias("exact_before"))
    leads = proxy(spark, d, "SELECT c_custkey AS lead_id FROM customer")
    return leads.join(flags, "lead_id", "left").select("lead_id", F.coalesce("exact_now", F.lit(False)).alias("exact_now"), F.coalesce("exact_before", F.lit(False)).alias("exact_before"))


@query("q_combine_exact_fuzzy", f"""WITH d AS ({DECIDED}), e AS (SELECT lead_id, pos_id, created, match_type FROM d WHERE {EXACT}), f AS (SELECT lead_id, pos_id, created, match_type FROM d WHERE {FUZZY} AND final_score >= 70)
  SELECT * FROM e UNION ALL SELECT * FROM f WHERE lead_id NOT IN (SELECT lead_id FROM e) AND pos_id NOT IN (SELECT pos_id FROM e)""")
def q_combine(spark, d):
    x = decisions(spark, d).select("lead_id", "pos_id", "created", "match_type", "final_score")
    exact = x.where(scores.is_exact(F.col("match_type"), F.col("final_score"))).drop("final_score")
    fuzzy = x.where(F.lower("match_type").isin("fuzzy", "manual review") & (F.col("final_score") >= 70)).drop("final_score")
    return matching.combine(exact, fuzzy)


CUSTOMERS = "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer"


@query("q_id_overlay_upsert", f"""WITH c AS ({CUSTOMERS}), n AS (SELECT s_suppkey * 3 AS id, s_name AS name, s_nationkey AS nation FROM supplier) SELECT * FROM n UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM n)""")
def q_upsert(spark, d):
    return writeback.upsert(proxy(spark, d, CUSTOMERS), proxy(spark, d, "SELECT s_suppkey * 3 AS id, s_name AS name, s_nationkey AS nation FROM supplier"), ["id"])


@query("q_insert_do_nothing", f"""WITH c AS ({CUSTOMERS}), n AS (SELECT s_suppkey * 40 - s_suppkey % 2 * 40 AS id, s_name AS name, s_nationkey AS nation FROM supplier)
  SELECT * FROM c UNION ALL SELECT id, name, nation FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name, nation) AS r FROM n) WHERE r = 1 AND id NOT IN (SELECT id FROM c)""")
def q_insert(spark, d):
    return writeback.insert_new(proxy(spark, d, CUSTOMERS), proxy(spark, d, "SELECT s_suppkey * 40 - s_suppkey % 2 * 40 AS id, s_name AS name, s_nationkey AS nation FROM supplier"), ["id"])


@query("q_not_in_vs_anti", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def q_delete(spark, d):
    # nulls among the keys delete nothing, where NOT IN would keep no row
    keys = proxy(spark, d, "SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT CAST(NULL AS BIGINT) AS id FROM region")
    return writeback.delete(proxy(spark, d, CUSTOMERS), keys, ["id"])


@query("q_audit_json", f"""WITH g AS (SELECT count(DISTINCT lead_id) AS l, count(DISTINCT pos_id) AS p, count(*) AS m FROM ({DECIDED}) WHERE match_run_id = 'run2')
  SELECT 'run2' AS match_id, l AS lead_count, p AS pos_count, m AS match_count, '{{"leads":' || l || ',"matches":' || m || ',"match_run_id":"run2","transactions":' || p || '}}' AS stats, 'SUCCESS' AS status, 'run2' AS run_in_stats FROM g""")
def q_audit(spark, d):
    return writeback.audit_row(decisions(spark, d), "run2").withColumn("run_in_stats", F.get_json_object("stats", "$.match_run_id"))


# ---- text ----
WORDS = "SELECT doc_id, text FROM documents"


@query("q_normalize_text", r"SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS normal FROM documents")
def q_text(spark, d):
    return proxy(spark, d, WORDS).select("doc_id", F.md5(normalize.text(F.col("text")).cast("binary")).alias("normal"))


STREETS = "p_partkey || ' ' || p_name || CASE p_partkey % 6 WHEN 0 THEN ' street' WHEN 1 THEN '  Avenue' WHEN 2 THEN ' Road Streetcar' WHEN 3 THEN ' drive' WHEN 4 THEN ' LANE lane' ELSE ' boulevard' END"
ADDRESS = "upper(trim(regexp_replace(a, '\\s+', ' ', 'g')))"
for _long, _short in normalize.STREETS:
    ADDRESS = f"regexp_replace({ADDRESS}, '\\b{_long}\\b', '{_short}', 'g')"


@query("q_normalize_address", f"SELECT p_partkey, {ADDRESS} AS address FROM (SELECT p_partkey, {STREETS} AS a FROM part)")
def q_address(spark, d):
    return proxy(spark, d, f"SELECT p_partkey, {STREETS} AS a FROM part").select("p_partkey", normalize.address(F.col("a")).alias("address"))


@query("q_normalize_zip_state", r"SELECT c_custkey, left(upper(trim(c_mktsegment)), 2) AS state, left(regexp_replace(c_name, '\D', '', 'g'), 5) AS zip FROM customer")
def q_zip(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", normalize.state(F.col("c_mktsegment")).alias("state"), normalize.zip_code(F.col("c_name")).alias("zip"))


PHONES = "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '1-' || (2065550000 + c_custkey) WHEN 1 THEN '(206) 555 ' || (1000 + c_custkey % 9000) ELSE '555-0100' END AS phone, '  ' || c_name || '@Example.COM ' AS mail FROM customer"


@query("q_normalize_phone_email", rf"""SELECT c_custkey, CASE WHEN length(d) = 10 THEN d WHEN length(d) = 11 AND d LIKE '1%' THEN substr(d, 2) ELSE '' END AS phone, lower(trim(mail)) AS email
  FROM (SELECT *, regexp_replace(phone, '\D', '', 'g') AS d FROM ({PHONES}))""")
def q_phone(spark, d):
    return proxy(spark, d, PHONES).select("c_custkey", normalize.phone(F.col("phone")).alias("phone"), normalize.email(F.col("mail")).alias("email"))


PLACES = "SELECT c_custkey, c_name, c_mktsegment, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("q_identity_concat", f"""SELECT c_custkey, upper(c_name) AS business_name, upper(n_name || ' ' || r_name) AS full_address, upper(c_name || ' ' || n_name || ' ' || r_name) AS combined_field FROM ({PLACES})""")
def q_identity(spark, d):
    return normalize.with_identity(proxy(spark, d, PLACES), "c_name", ["n_name", "r_name"]).select("c_custkey", "business_name", "full_address", "combined_field")


@query("q_variant_texts", f"""SELECT c_custkey, upper(c_name || ' ' || n_name) AS variant_combined, upper(c_name) AS variant_name_0, upper(c_mktsegment) AS variant_name_1, upper(n_name) AS variant_address_0, upper(r_name) AS variant_address_1 FROM ({PLACES})""")
def q_variants(spark, d):
    return normalize.with_variants(proxy(spark, d, PLACES), ["c_name", "c_mktsegment"], ["n_name", "r_name"]).drop("c_name", "c_mktsegment", "n_name", "r_name")


RAW = "SELECT event_id, CASE event_id % 5 WHEN 0 THEN ' nan ' WHEN 1 THEN '12.5' WHEN 2 THEN 'x' WHEN 3 THEN 'None' ELSE ' 7 ' END AS number, CASE event_id % 4 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'yes ' WHEN 2 THEN '0' END AS flag, event_type FROM events"


@query("q_safe_casts", f"""SELECT event_id, CASE WHEN lower(trim(number)) IN ('', 'nan', 'none', '<na>') THEN 0.0::DOUBLE ELSE coalesce(try_cast(trim(number) AS DOUBLE), 0.0::DOUBLE) END AS number,
  coalesce(lower(trim(flag)) IN ('true', '1', 'yes', 't'), false) AS flag, CASE WHEN lower(trim(number)) IN ('', 'nan', 'none', '<na>') THEN '' ELSE trim(number) END AS t FROM ({RAW})""")
def q_casts(spark, d):
    return proxy(spark, d, RAW).select("event_id", normalize.safe_double(F.col("number")).alias("number"), normalize.safe_bool(F.col("flag")).alias("flag"), normalize.safe_text(F.col("number")).alias("t"))


@query("q_json_path", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CASE WHEN event_type = 'view' THEN props ELSE event_type || '; ' || props END AS comment FROM events""")
def q_json(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    old = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), normalize.append_comment(old, F.col("props")).alias("comment"))


@query("q_override_policy", f"""SELECT created, CASE WHEN e >= 100 THEN e ELSE coalesce(s, e) END AS score, CASE WHEN final_score >= 100 THEN NULL WHEN final_score >= 90 THEN 'High' WHEN final_score >= 85 THEN 'Medium' WHEN final_score >= 70 THEN 'Low' END AS subtier,
  CASE WHEN {FUZZY} THEN 'Potential' WHEN final_score >= 100 THEN 'Match' ELSE '' END AS match_result, {LIFE} AS lifecycle_state
  FROM (SELECT *, CASE WHEN created % 3 = 0 THEN 100.0::DOUBLE WHEN created % 3 = 1 THEN 60.0::DOUBLE END AS e, final_score AS s FROM ({DECIDED}))""")
def q_override(spark, d):
    e = F.when(F.col("created") % 3 == 0, 100.0).when(F.col("created") % 3 == 1, 60.0)
    t, s = F.col("match_type"), F.col("final_score")
    return decisions(spark, d).select("created", scores.override(e, s).alias("score"), scores.subtier(s).alias("subtier"), scores.match_result(t, s).alias("match_result"), scores.lifecycle(t, s).alias("lifecycle_state"))


# ---- handoff ----
HANDOFF = """SELECT o_orderkey, o_custkey AS lead_id, CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(o_orderkey - o_orderkey % 6 AS {0}) END AS pos_id,
 CASE o_orderstatus WHEN 'F' THEN 'Match' WHEN 'O' THEN 'Potential' ELSE '' END AS match_result, CAST(60 + o_orderkey * 13 % 95 AS DOUBLE) AS similarity_score, o_orderkey % 5 = 0 AS closed_existing_flag FROM orders"""
H_CLASS = "CASE WHEN trim(pos_id) <> '' AND match_result = 'Match' AND similarity_score >= 100 THEN 'final_exact' WHEN trim(pos_id) <> '' AND match_result = 'Potential' AND similarity_score >= 70 AND similarity_score < 100 THEN 'deterministic_potential' WHEN closed_existing_flag THEN 'closed_existing' ELSE 'invalid' END"


def handoff(spark, d):
    return analytics.with_handoff_class(proxy(spark, d, HANDOFF.format("STRING")))


@query("q_handoff_classify", f"SELECT o_orderkey, {H_CLASS} AS handoff_class FROM ({HANDOFF.format('VARCHAR')})")
def q_handoff(spark, d):
    return handoff(spark, d).select("o_orderkey", "handoff_class")


@query("q_duplicate_ownership", f"""WITH e AS (SELECT pos_id, lead_id, max(similarity_score) AS s FROM ({HANDOFF.format('VARCHAR')}) WHERE {H_CLASS} = 'final_exact' GROUP BY ALL),
  b AS (SELECT *, max(s) OVER (PARTITION BY pos_id) AS best FROM e)
  SELECT pos_id, count(*) AS n_leads, max(best) AS max_score, string_agg(CAST(lead_id AS VARCHAR), ',' ORDER BY CAST(lead_id AS VARCHAR)) AS leads, count(*) FILTER (s = best) AS n_top,
  CASE WHEN count(*) FILTER (s = best) > 1 THEN 'ambiguous' ELSE 'conflict' END AS disposition FROM b GROUP BY pos_id HAVING count(*) > 1""")
def q_owners(spark, d):
    return analytics.duplicate_owners(handoff(spark, d).where("handoff_class = 'final_exact'"))


@query("q_source_alignment", """SELECT count(*) AS n_ids, count(*) FILTER (k IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) AS n_found,
  round(count(*) FILTER (k IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) * 100.0::DOUBLE / count(*), 2) AS overlap_pct FROM (SELECT DISTINCT c_custkey AS k FROM customer)""")
def q_alignment(spark, d):
    ids, known = proxy(spark, d, "SELECT c_custkey AS k FROM customer"), proxy(spark, d, "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'")
    return analytics.source_alignment(ids, known, "k")


# ---- distributions ----
@query("q_score_stats", f"SELECT count(final_score) AS n, round(avg(final_score), 4) AS mean, round(median(final_score), 4) AS median, round(stddev_samp(final_score), 4) AS sd, min(final_score) AS lowest, max(final_score) AS highest FROM ({SCORED})")
def q_stats(spark, d):
    return analytics.score_stats(decisions(spark, d, SCORED))


BINS = f"SELECT b.bin, count(s.final_score) AS n FROM (SELECT unnest(range(70, 101)) AS bin) b LEFT JOIN ({SCORED}) s ON s.final_score >= b.bin AND s.final_score < b.bin + 1 GROUP BY b.bin"


@query("q_histogram31", BINS)
def q_histogram(spark, d):
    return analytics.histogram(decisions(spark, d, SCORED))


@query("q_peak_bin", f"""WITH h AS ({BINS}), t AS (SELECT count(*) AS total FROM ({SCORED})) SELECT bin AS peak_bin, n AS peak_n, round(n / total, 6) AS peak_share, n / total > 0.15 AS spike FROM h, t ORDER BY n DESC, bin LIMIT 1""")
def q_peak(spark, d):
    return analytics.peak(decisions(spark, d, SCORED))


@query("q_band_counts", f"SELECT {BAND} AS band, count(*) AS n FROM ({SCORED}) GROUP BY ALL")
def q_bands(spark, d):
    return analytics.band_counts(decisions(spark, d, SCORED))


@query("q_review_workload", f"""SELECT count(*) AS n, count(*) FILTER (final_score < 75) AS n_tail, round(count(*) FILTER (final_score < 75) * 100.0::DOUBLE / count(*), 2) AS tail_pct,
  count(*) FILTER (match_type = 'Manual Review') AS n_review, round(count(*) FILTER (match_type = 'Manual Review') * 100.0::DOUBLE / count(*), 2) AS review_pct FROM ({SCORED})""")
def q_review(spark, d):
    return analytics.review_workload(decisions(spark, d, SCORED))


@query("q_lifecycle_split", f"SELECT count(*) FILTER ({EXACT}) AS closed_exact, count(*) FILTER ({FUZZY} AND final_score >= 90) AS fuzzy_high, count(*) FILTER ({FUZZY} AND final_score >= 70 AND final_score < 90) AS potential FROM ({DECIDED})")
def q_split(spark, d):
    return analytics.lifecycle_split(decisions(spark, d))


INTEGRITY = "SELECT c_nationkey AS territory, count(*) AS n_rows, count(vec_id) AS n_embedded, sum(CASE WHEN vec_id IS NULL AND c_custkey % 3 = 0 THEN 1 ELSE 0 END) AS x FROM customer LEFT JOIN embeddings ON vec_id = c_custkey GROUP BY c_nationkey"


@query("q_integrity_gap", f"""SELECT territory, n_rows - n_embedded - x AS gap, CASE WHEN n_rows - n_embedded - x > 0 THEN 'suspect: rows without vector' WHEN n_rows - n_embedded - x < 0 THEN 'suspect: more vectors than rows' ELSE 'clean' END AS verdict FROM (SELECT territory, n_rows, n_embedded, CAST(x AS BIGINT) AS x FROM ({INTEGRITY}))""")
def q_integrity(spark, d):
    return analytics.integrity(proxy(spark, d, INTEGRITY).withColumnRenamed("x", "n_exact")).select("territory", "gap", "verdict")


@query("q_fleet_rollup", f"SELECT coalesce(CAST(territory AS VARCHAR), 'ALL') AS territory, count(*) AS n, count(*) FILTER ({EXACT}) AS n_exact, round(count(*) FILTER ({EXACT}) / count(*), 6) AS exact_share FROM ({DECIDED}) GROUP BY ROLLUP (territory)")
def q_fleet(spark, d):
    return analytics.fleet(decisions(spark, d)).withColumn("territory", F.coalesce(F.col("territory").cast("string"), F.lit("ALL")))


@query("q_latest_per_key", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def q_latest(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    return analytics.latest_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("q_latest_run", f"SELECT territory, match_run_id, created FROM (SELECT *, row_number() OVER (PARTITION BY territory ORDER BY created DESC) AS n FROM ({DECIDED})) WHERE n = 1")
def q_latest_run(spark, d):
    return analytics.latest_per_key(decisions(spark, d), ["territory"], [F.desc("created")]).select("territory", "match_run_id", "created")


COVER = "SELECT c_nationkey AS territory, count(*) AS total, count(o) AS done FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders WHERE o_orderstatus = 'P') x ON o = c_custkey GROUP BY c_nationkey"


@query("q_coverage_pct", f"SELECT territory, total, done, round(done * 100.0::DOUBLE / greatest(total, 1), 1) AS coverage_pct FROM ({COVER})")
def q_coverage(spark, d):
    return analytics.coverage(proxy(spark, d, COVER))


@query("q_dup_key_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10")
def q_dup(spark, d):
    return analytics.duplicate_keys(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("q_sample_per_band", f"SELECT band, lead_id, created, final_score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY final_score DESC, lead_id, created) AS rank FROM (SELECT *, {BAND} AS band FROM ({SCORED}))) WHERE rank <= 5")
def q_sample(spark, d):
    return analytics.sample_per_band(decisions(spark, d, SCORED).withColumn("pos_id", F.col("created"))).select("band", "lead_id", "created", "final_score", "rank")


@query("q_state_counts", f"SELECT lifecycle_state, count(*) AS n FROM (SELECT {LIFE} AS lifecycle_state FROM ({DECIDED})) GROUP BY ALL")
def q_states(spark, d):
    return analytics.state_counts(decisions(spark, d).withColumn("lifecycle_state", scores.lifecycle(F.col("match_type"), F.col("final_score"))), "lifecycle_state")


# ---- report, search, graph ----
@query("q_search_filter_sort", f"SELECT lead_id, pos_id, created, final_score FROM ({DECIDED}) WHERE CAST(lead_id AS VARCHAR) LIKE '%1%' AND match_type = 'Fuzzy' AND coalesce(final_score, 0) >= 75 AND coalesce(final_score, 0) < 95 ORDER BY final_score DESC, lead_id, pos_id, created LIMIT 100")
def q_search(spark, d):
    x = decisions(spark, d).withColumns({"p": F.col("pos_id"), "pos_id": F.struct("pos_id", "created")})
    rows, _ = analytics.search(x, analytics.SearchParams(lead="1", match_type="Fuzzy", min_score=75, max_score=95))
    return rows.select("lead_id", F.col("p").alias("pos_id"), "created", "final_score")


@query("q_search_total", f"SELECT count(*) AS total FROM ({DECIDED}) WHERE match_type = 'Manual Review'")
def q_search_total(spark, d):
    return analytics.search(decisions(spark, d), analytics.SearchParams(review_only=True))[1]


@query("q_graph_nodes", f"SELECT 'Lead' AS kind, CAST(lead_id AS VARCHAR) AS id FROM ({DECIDED}) UNION SELECT 'Pos', CAST(pos_id AS VARCHAR) FROM ({DECIDED})")
def q_nodes(spark, d):
    return analytics.graph(decisions(spark, d))[0]


@query("q_graph_edges", f"""WITH d AS (SELECT *, CASE WHEN created % 2 = 0 THEN 'm' || created % 50 ELSE ' ' END AS member FROM ({DECIDED}))
  SELECT CAST(lead_id AS VARCHAR) AS source, CAST(pos_id AS VARCHAR) AS target, 'MATCHED_TO' AS edge FROM d UNION SELECT CAST(pos_id AS VARCHAR), CAST(territory AS VARCHAR), 'AT_WAREHOUSE' FROM d
  UNION SELECT CAST(pos_id AS VARCHAR), member, 'BELONGS_TO' FROM d WHERE trim(member) <> ''""")
def q_edges(spark, d):
    member = F.when(F.col("created") % 2 == 0, F.concat(F.lit("m"), F.col("created") % 50)).otherwise(" ")
    edges = analytics.territory_graph(decisions(spark, d).withColumn("member", member))[1]
    return edges.toDF("source", "target", "edge")


@query("q_graph_match_edges", f"""SELECT CAST(lead_id AS VARCHAR) AS source, CAST(created AS VARCHAR) AS target, coalesce(final_score, 0) AS score, match_type,
  CASE WHEN {EXACT} THEN 'Closed - Exact' WHEN lower(match_type) IN ('fuzzy', 'manual review') AND final_score >= 70 THEN 'Potential' ELSE 'No Match' END AS lifecycle_state,
  coalesce(final_score >= 70, false) AND row_number() OVER (PARTITION BY lead_id, coalesce(final_score >= 70, false) ORDER BY pos_year, pos_period, pos_week, created) = 1 AS primary_transaction FROM ({DECIDED})""")
def q_match_edges(spark, d):
    # several orders are one transaction here, so the order's key stands for it
    return analytics.graph(decisions(spark, d).withColumn("pos_id", F.col("created")))[1]


@query("q_report_star_join", f"""SELECT d.created, d.lead_id, d.pos_id, c_name AS business_name, n_name AS city, round(coalesce(d.order_amount, 0), 2) AS u_order_amount_rounded, CASE WHEN {FUZZY} THEN 'Potential' WHEN final_score >= 100 THEN 'Match' ELSE '' END AS match_result
  FROM ({DECIDED}) d JOIN customer ON c_custkey = d.lead_id JOIN nation ON n_nationkey = c_nationkey JOIN ({TRANSACTIONS}) t ON t.pos_id = d.pos_id""")
def q_report(spark, d):
    leads = proxy(spark, d, "SELECT c_custkey AS lead_id, c_name AS business_name, c_nationkey AS account_id FROM customer")
    accounts = proxy(spark, d, "SELECT n_nationkey AS account_id, n_name AS city FROM nation")
    s = analytics.star(decisions(spark, d), leads, accounts, proxy(spark, d, TRANSACTIONS))
    return s.select("created", "lead_id", "pos_id", "business_name", "city", F.round(F.coalesce("order_amount", F.lit(0.0)), 2).alias("u_order_amount_rounded"), scores.match_result(F.col("match_type"), F.col("final_score")).alias("match_result"))


# ---- quality ----
@query("q_score_band_audit", f"""SELECT count(*) AS n, min(final_score) AS lowest, max(final_score) AS highest, count(*) FILTER (final_score >= 100) AS n_too_high, count(*) FILTER (final_score < 70) AS n_too_low,
  CASE WHEN count(*) FILTER (final_score >= 100) = 0 AND count(*) FILTER (final_score < 70) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM ({DECIDED}) WHERE match_type <> 'Exact'""")
def q_band_audit(spark, d):
    return analytics.band_audit(decisions(spark, d))


@query("q_reconciliation", f"""SELECT count(*) AS n_unreconciled, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT DISTINCT pos_id FROM ({DECIDED}) WHERE {EXACT}) e
  JOIN (SELECT pos_id, {HAD} AS tx_type FROM ({TRANSACTIONS})) t USING (pos_id) WHERE NOT coalesce(lower(tx_type) = 'exact', false)""")
def q_reconcile(spark, d):
    return analytics.reconciliation(decisions(spark, d), snapshot(spark, d).withColumnRenamed("match_type", "tx_type"))


@query("q_orphan_keys", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')")
def q_orphans(spark, d):
    child = proxy(spark, d, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
    return analytics.orphans(child, proxy(spark, d, "SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderstatus <> 'P'"), "l_orderkey")


DIAGNOSE = """SELECT n_nationkey AS territory, coalesce(l, 0) AS n_leads, coalesce(p, 0) AS n_pos, coalesce(e, 0) AS n_embedded FROM nation
 LEFT JOIN (SELECT c_nationkey AS k, count(*) AS l FROM customer GROUP BY c_nationkey) a ON a.k = n_nationkey
 LEFT JOIN (SELECT s_nationkey AS k, count(*) AS p FROM supplier GROUP BY s_nationkey) b ON b.k = n_nationkey
 LEFT JOIN (SELECT label AS k, count(*) AS e FROM embeddings GROUP BY label) c ON c.k = n_nationkey"""


@query("q_territory_diagnostics", f"""SELECT *, CASE WHEN n_leads = 0 AND n_pos = 0 THEN 'empty' WHEN n_pos = 0 THEN 'leads without transactions' WHEN n_leads = 0 THEN 'transactions without leads' WHEN n_embedded < n_pos THEN 'transactions without vectors' ELSE 'ok' END AS finding,
  round(n_embedded * 100.0::DOUBLE / greatest(n_pos, 1), 1) AS coverage_pct FROM ({DIAGNOSE})""")
def q_diagnose(spark, d):
    return analytics.diagnose(proxy(spark, d, DIAGNOSE))


@query("q_embed_hash")
def q_embed(spark, d):
    # hashed n-grams have no SQL; the tests hold them against a plain loop
    c = proxy(spark, d, "SELECT c_name AS a, c_mktsegment AS b FROM customer")
    return embed.embed_distinct(c, ["a", "b"]).select("text", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 4).alias("norm"))


# ---- steps around the match ----
LEADS = "SELECT c_custkey AS lead_id, c_nationkey AS account_id, CAST(c_custkey % 25 AS INT) AS territory, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS name FROM customer"
ACCOUNTS = "SELECT n_nationkey AS account_id, n_name AS city FROM nation"


@query("q_lead_source_scan", f"""SELECT lead_id, account_id, territory, coalesce(name, '') AS name, city FROM ({LEADS}) l JOIN ({ACCOUNTS}) USING (account_id) WHERE territory IN (3, 4, 5, 6)
  AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = l.lead_id) AND NOT EXISTS (SELECT 1 FROM ({DECIDED}) x WHERE x.lead_id = l.lead_id AND {EXACT})""")
def q_lead_scan(spark, d):
    done = embeddings(spark, d).select(F.col("vec_id").alias("lead_id"))
    return steps.lead_scan(proxy(spark, d, LEADS), proxy(spark, d, ACCOUNTS), done, decisions(spark, d), frozenset({3, 4, 5, 6})).select("lead_id", "account_id", "territory", "name", "city")


@query("q_pos_source_scan", f"""SELECT pos_id FROM ({TRANSACTIONS}) t WHERE pos_id % 16 <> 0 AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = t.pos_id) AND NOT EXISTS (SELECT 1 FROM ({DECIDED}) x WHERE x.pos_id = t.pos_id AND {EXACT})""")
def q_pos_scan(spark, d):
    done = embeddings(spark, d).select(F.col("vec_id").alias("pos_id"))
    t = proxy(spark, d, TRANSACTIONS).withColumn("is_processed", F.col("pos_id") % 16 == 0)
    return steps.pos_scan(t, done, decisions(spark, d)).select("pos_id")


@query("q_purge_territory", f"SELECT DISTINCT account_id, city FROM ({ACCOUNTS}) a WHERE EXISTS (SELECT 1 FROM ({LEADS}) l WHERE l.account_id = a.account_id AND territory <> 4 AND account_id IS NOT NULL)")
def q_purge(spark, d):
    return steps.purge({"lead": proxy(spark, d, LEADS), "account": proxy(spark, d, ACCOUNTS)}, 4)["account"]


# seven tables: four with a territory of their own, two that hang on leads, and accounts
HELD = {
    "lead": ("lead_id", LEADS), "account": ("account_id", ACCOUNTS), "decision": ("created", DECIDED),
    "vector": ("vec_id", "SELECT vec_id, label AS territory FROM embeddings"), "audit": ("audit_id", "SELECT s_suppkey AS audit_id, s_nationkey AS territory FROM supplier"),
    "contact": ("contact_id", "SELECT c_custkey + 1 AS contact_id, c_custkey AS lead_id FROM customer"), "note": ("note_id", "SELECT l_orderkey * 8 + l_linenumber AS note_id, l_partkey AS lead_id FROM lineitem"),
}
GONE = f"SELECT lead_id FROM ({LEADS}) g WHERE territory = 4"
STAYS = {
    "account": f"account_id IN (SELECT account_id FROM ({LEADS}) s WHERE territory IS DISTINCT FROM 4)",
    "contact": f"lead_id IS NULL OR lead_id NOT IN ({GONE})",
    "note": f"lead_id IS NULL OR lead_id NOT IN ({GONE})",
}


@query("q_purge_tables", " UNION ALL ".join(f"SELECT '{n}' AS held, CAST({k} AS BIGINT) AS id FROM ({t}) {n}_ WHERE {STAYS.get(n, 'territory IS DISTINCT FROM 4')}" for n, (k, t) in HELD.items()))
def q_purge_all(spark, d):
    left = steps.purge({n: proxy(spark, d, t) for n, (_, t) in HELD.items()}, 4)
    parts = [left[n].select(F.lit(n).alias("held"), F.col(k).cast("long").alias("id")) for n, (k, _) in HELD.items()]
    return reduce(DataFrame.union, parts)


@query("q_fallback_blank_out", f"SELECT lead_id, CASE WHEN lead_id % 4 = 0 THEN NULL ELSE coalesce(name, city) END AS shown FROM ({LEADS}) JOIN ({ACCOUNTS}) USING (account_id)")
def q_fallback(spark, d):
    j = proxy(spark, d, LEADS).join(proxy(spark, d, ACCOUNTS), "account_id")
    return steps.blank_out(steps.fallback(j, "shown", ["name", "city"]), ["shown"], F.col("lead_id") % 4 == 0).select("lead_id", "shown")


@query("q_keyset_page", "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 40 ORDER BY c_custkey LIMIT 100")
def q_page(spark, d):
    return steps.keyset_page(proxy(spark, d, "SELECT c_custkey, c_name FROM customer"), "c_custkey", 40, 100)


@query("q_id_decollision", """SELECT CASE WHEN n > 1 THEN k || '-' || n ELSE k END AS k, l_partkey, l_quantity FROM
  (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_tax, l_discount) AS n FROM (SELECT *, l_orderkey || ':' || l_linenumber AS k FROM lineitem))""")
def q_collide(spark, d):
    x = proxy(spark, d, "SELECT *, concat(l_orderkey, ':', l_linenumber) AS k FROM lineitem")
    return steps.without_collisions(x, "k", ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_tax", "l_discount"]).select("k", "l_partkey", "l_quantity")


@query("q_set_operations", """SELECT 'union' AS op, k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'both', k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
  UNION ALL SELECT 'only', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier)""")
def q_sets(spark, d):
    c, s = (proxy(spark, d, f"SELECT {x}_nationkey AS k FROM {t}") for x, t in (("c", "customer"), ("s", "supplier")))
    a, b = proxy(spark, d, "SELECT c_custkey AS k FROM customer"), proxy(spark, d, "SELECT s_suppkey AS k FROM supplier")
    tag = lambda df, op: df.select(F.lit(op).alias("op"), F.col("k").cast("long").alias("k"))
    return tag(c.union(s).distinct(), "union").union(tag(c.intersect(s), "both")).union(tag(a.distinct().join(b, "k", "left_anti"), "only"))


@query("q_expected_relation", f"SELECT created, CASE WHEN created % 13 = 0 THEN 'closed_existing' WHEN final_score >= 100 THEN 'exact_single' WHEN final_score >= 70 THEN 'fuzzy_candidate' ELSE 'no_match' END AS expected_relation FROM ({DECIDED})")
def q_expected(spark, d):
    return decisions(spark, d).select("created", steps.expected_relation(F.col("final_score"), F.col("created") % 13 == 0).alias("expected_relation"))


@query("q_score_buckets", f"""SELECT match_run_id, count(*) AS n, count(*) FILTER (final_score >= 95) AS n_95, count(*) FILTER (final_score >= 90 AND final_score < 95) AS n_90, count(*) FILTER (final_score >= 85 AND final_score < 90) AS n_85,
  count(*) FILTER (final_score >= 70 AND final_score < 85) AS n_70 FROM ({DECIDED}) GROUP BY match_run_id""")
def q_buckets(spark, d):
    return steps.score_buckets(decisions(spark, d))


@query("q_unmatched_leads", f"SELECT n_leads, matched, greatest(n_leads - matched, 0) AS unmatched FROM (SELECT count(*) AS n_leads FROM customer), (SELECT count(DISTINCT lead_id) AS matched FROM ({DECIDED}))")
def q_unmatched(spark, d):
    return steps.unmatched(proxy(spark, d, LEADS), decisions(spark, d))


@query("q_json_artifacts", f"""WITH t AS (SELECT * FROM ({DECIDED}) ORDER BY final_score DESC NULLS LAST, lead_id, created LIMIT 20)
  SELECT '[' || string_agg('{{"lead":' || lead_id || ',"order":' || created || '}}', ',' ORDER BY final_score DESC, lead_id, created) || ']' AS artifacts, count(*) AS n FROM t""")
def q_artifacts(spark, d):
    return steps.artifacts(decisions(spark, d))


@query("q_null_counts", f"SELECT count(*) AS n, count(*) FILTER (final_score IS NULL) AS null_final_score, count(*) FILTER (match_type IS NULL) AS null_match_type FROM ({DECIDED})")
def q_nulls(spark, d):
    return steps.null_counts(decisions(spark, d), ["final_score", "match_type"])


@query("q_elapsed", """SELECT user_id, printf('%dh %02dm %02ds', s // 3600, s // 60 % 60, s % 60) AS elapsed FROM (SELECT user_id, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS s FROM events GROUP BY user_id)""")
def q_elapsed(spark, d):
    g = spark.read.parquet(f"{d}/events.parquet").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return g.select("user_id", steps.elapsed(F.col("a"), F.col("b")).alias("elapsed"))


@query("q_report_36", f"""SELECT CAST(lead_id AS VARCHAR) AS lead_id, CAST(pos_id AS VARCHAR) AS pos_id, match_type, final_score AS similarity_score, pos_year AS fiscal_year_transaction, order_amount, 36::BIGINT AS n_columns FROM ({DECIDED})""")
def q_report_36(spark, d):
    x = decisions(spark, d).withColumns({"similarity_score": F.col("final_score"), "fiscal_year_transaction": F.col("pos_year"), "lead_id": F.col("lead_id").cast("string"), "pos_id": F.col("pos_id").cast("string")})
    out = conform(x, OUTPUT_36)
    return out.select("lead_id", "pos_id", "match_type", "similarity_score", "fiscal_year_transaction", "order_amount", F.lit(len(out.columns)).cast("long").alias("n_columns"))


# ---- records around a run ----
COMMENTED = f"""SELECT created, match_type, final_score, CASE WHEN created % 3 = 0 THEN 'Shop' ELSE '' END AS pos_business_name, CASE WHEN created % 4 = 0 THEN '1 Oak St' END AS address_line_one,
 CASE WHEN created % 5 = 0 THEN 'a@x.org' ELSE '' END AS email, CASE WHEN created % 6 = 0 THEN '2065550100' END AS phone, CASE WHEN created % 7 < 3 THEN '98000' ELSE '' END AS zip_code, CASE WHEN created % 8 < 3 THEN 'Town' END AS city, CASE WHEN created % 9 < 4 THEN 'WA' ELSE '' END AS state,
 CASE WHEN created % 10 = 0 THEN NULL ELSE CAST(created % 6 + 1 AS INT) END AS winning_set, CASE WHEN created % 11 = 0 THEN NULL ELSE CAST(created % 997 AS DOUBLE) / 10 END AS business_name_score, CASE WHEN created % 12 = 0 THEN NULL ELSE CAST(created % 991 AS DOUBLE) / 10 END AS full_address_score,
 CAST(CASE WHEN created % 3 = 1 THEN 5 ELSE 0 END AS DOUBLE) AS email_boost, CAST(CASE WHEN created % 5 = 1 THEN 5 END AS DOUBLE) AS phone_boost, created % 4 = 1 AS primary_transaction FROM ({DECIDED}) d2"""


@query("q_comment_builder", f"""SELECT created, CASE WHEN lower(trim(match_type)) = 'exact' THEN
   'Complete Match (score ' || CAST(coalesce(final_score, 0) AS VARCHAR) || '/' || CAST(coalesce(final_score, 0) AS VARCHAR) || ').' ||
   CASE WHEN f = '' THEN '' ELSE ' Fields matched: ' || f || '.' END
  ELSE 'Fuzzy match (set ' || coalesce(CAST(winning_set AS VARCHAR), '') || ', score ' || printf('%.2f', coalesce(final_score, 0)) || ').' ||
   CASE WHEN business_name_score IS NULL THEN '' ELSE ' name_score=' || printf('%.1f', business_name_score) END || CASE WHEN full_address_score IS NULL THEN '' ELSE ' addr_score=' || printf('%.1f', full_address_score) END ||
   CASE WHEN email_boost <> 0 THEN ' email_boost=+' || printf('%.0f', email_boost) ELSE '' END || CASE WHEN phone_boost <> 0 THEN ' phone_boost=+' || printf('%.0f', phone_boost) ELSE '' END END ||
  CASE WHEN primary_transaction THEN ' Designated as primary transaction (earliest fiscal period for this lead).' ELSE '' END AS matching_comments
  FROM (SELECT *, concat_ws(', ', CASE WHEN pos_business_name <> '' THEN 'business_name -> oms_company' END, CASE WHEN address_line_one <> '' THEN 'address_line_one -> oms_address_line_1' END, CASE WHEN email <> '' THEN 'email -> oms_email_1' END,
   CASE WHEN phone <> '' THEN 'phone -> oms_phone_1' END, CASE WHEN zip_code <> '' THEN 'zip_code -> oms_zip' END, CASE WHEN city <> '' THEN 'city -> oms_city' END, CASE WHEN state <> '' THEN 'state -> oms_state' END) AS f FROM ({COMMENTED}))""")
def q_comment(spark, d):
    x = proxy(spark, d, COMMENTED)
    return x.select("created", scores.comment(x.columns).alias("matching_comments"))


BLANKS = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS address FROM customer"


@query("q_drop_all_null", f"SELECT * FROM ({BLANKS}) WHERE name IS NOT NULL OR address IS NOT NULL")
def q_drop_blank(spark, d):
    return records.drop_blank(proxy(spark, d, BLANKS), ["name", "address"])


RUNS = "SELECT CAST(o_custkey % 25 AS INT) AS territory, o_orderkey AS created, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 3 = 0 END AS dry_run, o_orderkey % 4 = 0 AS verification FROM orders"


@query("q_latest_real_run", f"SELECT territory, max(created) AS created FROM ({RUNS}) WHERE NOT coalesce(dry_run, false) AND NOT coalesce(verification, false) GROUP BY territory")
def q_real_runs(spark, d):
    return records.real_runs(proxy(spark, d, RUNS)).select("territory", "created")


CONTACTS = "SELECT n_nationkey AS account_id, lower(n_name) || '@x.org' AS email, CASE WHEN n_nationkey % 2 = 0 THEN '206555010' || n_nationkey END AS phone FROM nation WHERE n_nationkey % 3 <> 0"


@query("q_contacts_left_join", f"SELECT lead_id, coalesce(email, '') AS email, coalesce(phone, '') AS phone FROM ({LEADS}) l LEFT JOIN ({CONTACTS}) a ON a.account_id = l.account_id")
def q_contacts(spark, d):
    return records.with_contacts(proxy(spark, d, LEADS), proxy(spark, d, CONTACTS)).select("lead_id", "email", "phone")


@query("q_suffix_merge", """SELECT c_custkey AS k, c_name AS name_primary, s_name AS name_fuzzy, CAST(c_nationkey AS VARCHAR) AS nation_primary, CAST(s_nationkey AS VARCHAR) AS nation_fuzzy FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def q_side_by_side(spark, d):
    left, right = proxy(spark, d, "SELECT c_custkey AS k, c_name AS name, CAST(c_nationkey AS STRING) AS nation FROM customer"), proxy(spark, d, "SELECT s_suppkey AS k, s_name AS name, CAST(s_nationkey AS STRING) AS nation FROM supplier")
    return records.side_by_side(left, right, "k")


@query("q_detail_lookup", """SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 AND s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def q_refreshed(spark, d):
    left, right = proxy(spark, d, "SELECT c_custkey AS k, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer"), proxy(spark, d, "SELECT s_suppkey AS k, s_name AS name FROM supplier")
    return records.refreshed(left, right, "k", F.col("k") % 2 == 0, ["name"])


@query("q_exact_backfill", f"""WITH e AS (SELECT * FROM (SELECT pos_id, lead_id, coalesce(final_score, 100) AS s, row_number() OVER (PARTITION BY pos_id ORDER BY created DESC, lead_id) AS n FROM ({DECIDED}) WHERE {EXACT}) WHERE n = 1),
 t AS (SELECT pos_id, {HAD} AS match_type, -1::BIGINT AS lead_id, 80.0::DOUBLE AS match_score, pos_id % 16 = 0 AS is_processed FROM ({TRANSACTIONS})),
 j AS (SELECT t.*, e.lead_id AS nl, e.s, e.pos_id IS NOT NULL AND NOT coalesce(lower(match_type) = 'exact', false) AS take FROM t LEFT JOIN e ON e.pos_id = t.pos_id)
 SELECT pos_id, CASE WHEN take THEN 'Exact' ELSE match_type END AS match_type, CASE WHEN take THEN nl ELSE lead_id END AS lead_id, CASE WHEN take THEN s ELSE match_score END AS match_score, take OR is_processed AS is_processed FROM j""")
def q_backfill(spark, d):
    return records.exact_backfill(snapshot(spark, d), decisions(spark, d))


@query("q_table_counts", f"SELECT 'leads' AS table_name, count(*) AS n FROM ({LEADS}) WHERE territory IN (3, 4) UNION ALL SELECT 'accounts', count(*) FROM ({ACCOUNTS}) UNION ALL SELECT 'decisions', count(*) FROM ({DECIDED}) WHERE territory IN (3, 4)")
def q_counts(spark, d):
    tables = {"leads": proxy(spark, d, LEADS), "accounts": proxy(spark, d, ACCOUNTS), "decisions": decisions(spark, d)}
    return records.table_counts(tables, matching.in_scope("territory", frozenset({3, 4})))


@query("q_score_range", f"SELECT handoff_class, count(*) AS n, min(similarity_score) AS lowest, max(similarity_score) AS highest FROM (SELECT *, {H_CLASS} AS handoff_class FROM ({HANDOFF.format('VARCHAR')})) GROUP BY handoff_class")
def q_range(spark, d):
    return records.score_range(handoff(spark, d), "handoff_class")


@query("q_dry_run_cap", f"SELECT lead_id, pos_id, created, final_score FROM ({DECIDED}) ORDER BY final_score DESC NULLS LAST, lead_id, created LIMIT 50")
def q_dry_run(spark, d):
    # several orders are one transaction here, so the order's key stands for it
    x = decisions(spark, d).withColumns({"p": F.col("pos_id"), "pos_id": F.col("created")})
    return records.dry_run_rows(x, 50).select("lead_id", F.col("p").alias("pos_id"), "created", "final_score")


@query("q_territory_order", f"SELECT territory, row_number() OVER (ORDER BY try_cast(territory AS BIGINT) NULLS LAST, territory) AS place FROM (SELECT DISTINCT CASE WHEN territory % 6 = 0 THEN 'T' || territory ELSE CAST(territory AS VARCHAR) END AS territory FROM ({LEADS}))")
def q_territories(spark, d):
    t = proxy(spark, d, LEADS).select(F.when(F.col("territory") % 6 == 0, F.concat(F.lit("T"), "territory")).otherwise(F.col("territory").cast("string")).alias("territory"))
    return records.territory_places(t)


OMS = "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_custkey || ' oak street' END AS oms_address_line_1, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Town' END AS oms_city, CASE WHEN c_custkey % 2 = 0 THEN 'wa' END AS oms_state, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '98001-22' END AS oms_zip FROM customer"
OMS_TEXT = ADDRESS.replace("a, '\\s+'", "concat_ws(' ', CASE WHEN trim(oms_address_line_1) <> '' THEN oms_address_line_1 END, CASE WHEN trim(oms_city) <> '' THEN oms_city END, CASE WHEN trim(oms_state) <> '' THEN oms_state END, CASE WHEN trim(oms_zip) <> '' THEN oms_zip END), '\\s+'")


@query("q_oms_address", f"SELECT c_custkey, {OMS_TEXT} AS full_oms_address FROM ({OMS})")
def q_oms(spark, d):
    return proxy(spark, d, OMS).select("c_custkey", records.oms_address(records.OMS_ADDRESS).alias("full_oms_address"))


@query("q_loader_keys", f"SELECT lead_id, lower(trim(name)) AS key_name, CAST(territory AS VARCHAR) AS key_territory FROM (SELECT lead_id, '  ' || name || ' ' AS name, territory FROM ({LEADS}))")
def q_keys(spark, d):
    x = proxy(spark, d, LEADS).withColumn("name", F.concat(F.lit("  "), "name", F.lit(" ")))
    return records.loader_keys(x, ["name", "territory"]).select("lead_id", "key_name", "key_territory")


@query("q_missing_ids", "SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ORDER BY k LIMIT 100")
def q_missing(spark, d):
    ids, known = proxy(spark, d, "SELECT c_custkey AS k FROM customer"), proxy(spark, d, "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'")
    return records.missing_ids(ids, known, "k", 100)


@query("q_summary_check", f"""SELECT n_detail, n_not_exact, no_final_score, n_summary, CASE WHEN n_summary = n_detail AND n_not_exact >= 100 AND no_final_score = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM
 (SELECT count(*) AS n_detail, count(*) FILTER (lower(match_type) <> 'exact') AS n_not_exact, count(*) FILTER (final_score IS NULL) AS no_final_score FROM ({DECIDED})), (SELECT CAST(count(*) AS BIGINT) AS n_summary FROM ({DECIDED}))""")
def q_summary(spark, d):
    x = decisions(spark, d)
    return records.summary_check(x.groupBy("match_type").agg(F.count(F.lit(1)).alias("n")), x, ["final_score"])
