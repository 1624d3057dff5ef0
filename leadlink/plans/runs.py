"""Queries around whole runs: pruned search, the end of a run, chunks with their ledger, consume-once,
and the cache of vectors. Importing it adds them to those of the catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import matching, neighbours, runs
from ..sources import cache
from ..sources.scratch import folder, written
from ..streaming import chunks, consume
from .catalogue import DECIDED, EXACT, FISCAL_CLASS, HAD, KNN_SQL, PERIOD, PRIORITY, TRANSACTIONS, WEEK, knn, proxy, query


@query("q_knn_pruned", KNN_SQL)
def q_knn_pruned(spark, d):
    found = knn(spark, d, neighbours.nearest)
    return found.select("territory", "lead_id", "pos_id", F.round("raw", 2).alias("score"), F.col("rank").cast("int").alias("rank"))


# ---- the end of a run: every column of decisions, transactions, leads and audit ----
# pairs of which some are of class CE: a lead of the day an item was shipped, a transaction of the day it was ordered
PAIRED = f"""SELECT o_custkey AS lead_id, l_partkey * 4 AS pos_id, CAST(o_custkey % 25 AS INT) AS territory,
 CAST(year(l_shipdate) AS INT) AS lead_year, {PERIOD.format("l_shipdate")} AS lead_period, {WEEK.format("l_shipdate")} AS lead_week,
 CAST(year(o_orderdate) AS INT) AS pos_year, {PERIOD.format("o_orderdate")} AS pos_period, {WEEK.format("o_orderdate")} AS pos_week
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
OWN = "SELECT match_run_id, lead_id, pos_id, territory, match_type, final_score, created FROM ({0}) own WHERE match_run_id {1} 'run2'"
# transactions as they were, with every kind of decision shown on them
SHOWN = f"""SELECT pos_id, CAST(1995 + pos_id % 3 AS INT) AS pos_year, CAST(pos_id % 13 + 1 AS INT) AS pos_period,
 CAST(CASE WHEN pos_id % 5 = 0 THEN NULL ELSE pos_id % 52 + 1 END AS INT) AS pos_week,
 CASE WHEN pos_id % 7 = 0 THEN pos_id % 1000 END AS lead_id, CAST(CASE WHEN pos_id % 3 = 0 THEN 100 ELSE 80 END AS DOUBLE) AS match_score,
 {HAD} AS match_type, pos_id % 7 = 0 AS primary_transaction, 'before' AS matching_comments,
 CASE WHEN pos_id % 11 <> 0 THEN pos_id % 16 = 0 END AS is_processed, CAST(1 AS BIGINT) AS process_datetime, 'loader' AS updated_by
 FROM ({TRANSACTIONS}) shown"""
PROSPECTS = "SELECT c_custkey AS lead_id, c_name AS name, 'before' AS match_result, 'loader' AS updated_by FROM customer WHERE c_custkey % 17 <> 0"
TYPES = "('exact', 'exact match', 'exact_match', 'match', 'deterministic')"
STATE = f"CASE WHEN lower(match_type) IN {TYPES} THEN 'Closed - Exact' WHEN lower(match_type) IN ('fuzzy', 'manual review') AND final_score >= 70 THEN 'Potential' ELSE 'No Match' END"
AFTER = f"""WITH d AS ({OWN.format(DECIDED, "=")}), p AS ({PAIRED}), t AS ({SHOWN}), l AS ({PROSPECTS}),
 ce AS (SELECT DISTINCT lead_id, pos_id, territory FROM p WHERE {FISCAL_CLASS} = 'CE' AND NOT EXISTS (SELECT 1 FROM d WHERE d.lead_id = p.lead_id AND d.pos_id = p.pos_id)),
 k AS (SELECT * FROM d UNION ALL SELECT 'run2', lead_id, pos_id, territory, 'Closed - Existing', 0.0::DOUBLE, 99 FROM ce),
 ranked AS (SELECT k.match_run_id, k.lead_id, k.pos_id, k.match_type, k.final_score, {PRIORITY.format("k.match_type")} AS priority, {STATE.replace("match_type", "k.match_type")} AS state, pos_year, pos_period, coalesce(pos_week, 0) AS pos_week,
   row_number() OVER (PARTITION BY k.pos_id ORDER BY {PRIORITY.format("k.match_type")} DESC, k.final_score DESC NULLS LAST, k.created DESC NULLS LAST, k.lead_id) AS n
   FROM k JOIN t ON t.pos_id = k.pos_id WHERE k.lead_id IN (SELECT lead_id FROM l)),
 won AS (SELECT *, state = 'Closed - Exact' AND row_number() OVER (PARTITION BY lead_id, state = 'Closed - Exact' ORDER BY pos_year, pos_period, pos_week, pos_id) = 1 AS first FROM ranked WHERE n = 1),
 marked AS (SELECT t.*, won.lead_id AS l2, won.final_score AS s2, won.match_type AS t2, won.first AS f2, won.state,
   coalesce(won.priority >= CASE WHEN lower(t.match_type) IN {TYPES} AND (t.match_score IS NULL OR t.match_score >= 100) THEN 3 WHEN lower(t.match_type) = 'fuzzy' THEN 2 WHEN lower(t.match_type) = 'manual review' THEN 1 ELSE 0 END, false) AS take,
   t.pos_id IN (SELECT pos_id FROM ce) AS stub FROM t LEFT JOIN won ON won.pos_id = t.pos_id),
 tx AS (SELECT pos_id, pos_year, pos_period, pos_week, CASE WHEN take THEN l2 ELSE lead_id END AS lead_id, CASE WHEN take THEN s2 ELSE match_score END AS match_score,
   CASE WHEN take THEN t2 ELSE match_type END AS match_type, CASE WHEN take THEN f2 ELSE primary_transaction END AS primary_transaction,
   CASE WHEN take THEN 'match_run_id=run2; lifecycle_state=' || state ELSE matching_comments END AS matching_comments,
   take OR stub OR coalesce(is_processed, false) AS is_processed, CASE WHEN take OR stub THEN 99 ELSE process_datetime END AS process_datetime,
   CASE WHEN take THEN 'leadlink' WHEN stub THEN 'leadlink_ce' ELSE updated_by END AS updated_by FROM marked),
 owned AS (SELECT lead_id FROM ({OWN.format(DECIDED, "<>")}) o WHERE {EXACT} UNION SELECT lead_id FROM tx WHERE lower(match_type) IN {TYPES} AND (match_score IS NULL OR match_score >= 100) AND lead_id IS NOT NULL),
 g AS (SELECT lead_id, bool_or(state = 'Closed - Exact') AS e, bool_or(state = 'Potential') AS p FROM (SELECT lead_id, {STATE} AS state FROM k WHERE pos_id IN (SELECT pos_id FROM t)) s GROUP BY lead_id),
 lx AS (SELECT l.lead_id, l.name, CASE WHEN g.e OR g.lead_id IS NOT NULL AND o.lead_id IS NULL THEN CASE WHEN g.e THEN 'Closed - Exact' WHEN g.p THEN 'Potential' ELSE 'No Match' END ELSE match_result END AS match_result,
   CASE WHEN g.e OR g.lead_id IS NOT NULL AND o.lead_id IS NULL THEN 'leadlink' ELSE updated_by END AS updated_by FROM l LEFT JOIN g ON g.lead_id = l.lead_id LEFT JOIN owned o ON o.lead_id = l.lead_id)
"""


def finished(spark, d) -> runs.Snapshots:
    own, others = (proxy(spark, d, OWN.format(DECIDED, how)) for how in ("=", "<>"))
    pairs = matching.with_fiscal_class(proxy(spark, d, PAIRED))
    at = F.lit(99).cast("long")
    return runs.finish(own, pairs, proxy(spark, d, SHOWN), proxy(spark, d, PROSPECTS), "run2", others, at=at)


@query("q_run_decisions", f"{AFTER} SELECT * FROM k")
def q_run_decisions(spark, d):
    return finished(spark, d).decisions


@query("q_run_transactions", f"{AFTER} SELECT * REPLACE (coalesce(lead_id, -1) AS lead_id, coalesce(pos_week, -1) AS pos_week) FROM tx")
def q_run_transactions(spark, d):
    return finished(spark, d).transactions.fillna(-1, ["lead_id", "pos_week"])


@query("q_run_leads", f"{AFTER} SELECT * FROM lx")
def q_run_leads(spark, d):
    return finished(spark, d).leads


@query("q_run_audit", f"""{AFTER}, c AS (SELECT count(*)::INT AS m, count(DISTINCT pos_id)::INT AS q, (SELECT count(DISTINCT lead_id)::INT FROM p) AS n FROM k)
 SELECT 'run2' AS match_id, n AS lead_count, q AS pos_count, m AS match_count,
 '{{"dry_run":false,"match_run_id":"run2","match_rows":' || m || ',"matched_pos":' || q || ',"processed_leads":' || n || '}}' AS stats, 'COMPLETED' AS status,
 99::BIGINT AS update_date, 'match_run_id=run2; warehouse_scope=ALL; dry_run=False; business_writeback=enabled' AS comments FROM c""")
def q_run_audit(spark, d):
    return finished(spark, d).audit


# ---- chunks, streams, cache ----
def chunked(spark, d) -> tuple[DataFrame, chunks.Ledger, str]:
    """Customers in four chunks; a first run ends after two of them, a second one goes on."""
    at = f"{folder(spark)}/chunks-{uuid.uuid4().hex}"
    ledger = chunks.Ledger(spark, f"{at}/ledger")
    rows = chunks.cut(proxy(spark, d, "SELECT c_custkey AS lead_id, c_name AS name, c_acctbal AS balance FROM customer"), "lead_id", max(1, proxy(spark, d, "SELECT c_custkey FROM customer").count() // 4))
    rows = written(rows, "chunked")
    work = lambda df: df.withColumn("name", F.upper("name"))
    for most in (2, None):
        chunks.run(rows, "lead_id", work, f"{at}/out", ledger, "run2", F.col("balance") < 0, most=most)
    return chunks.output(spark, f"{at}/out", ledger, "run2"), ledger, at


@query("q_chunk_output", "SELECT c_custkey AS lead_id, upper(c_name) AS name, c_acctbal AS balance FROM customer WHERE NOT coalesce(c_acctbal < 0, false)")
def q_chunk_output(spark, d):
    return chunked(spark, d)[0].select("lead_id", "name", "balance")


@query("q_chunk_ledger", """SELECT 'run2' AS run_id, count(*) AS rows_attempted, count(*) FILTER (NOT coalesce(c_acctbal < 0, false)) AS rows_written,
 count(*) FILTER (c_acctbal < 0) AS rows_failed, 0::BIGINT AS unfinished FROM customer""")
def q_chunk_ledger(spark, d):
    found = chunks.summary(chunked(spark, d)[1].events())
    return found.select("run_id", "rows_attempted", "rows_written", "rows_failed", (F.col("pending") + F.col("running") + F.col("failed")).alias("unfinished"))


@query("q_consume_once", "SELECT l_orderkey AS pos_id, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_orderkey")
def q_consume_once(spark, d):
    at, schema = f"{folder(spark)}/consume-{uuid.uuid4().hex}", T.StructType([T.StructField("l_orderkey", T.LongType())])
    for _ in range(2):  # a second start finds nothing that is new; as a pattern, the path may be one file
        consume.consume(spark, f"{d}/lineitem.parque[t]", f"{at}/target", f"{at}/state", schema, "l_orderkey").awaitTermination()
    got = spark.read.schema(schema).parquet(f"{at}/target")
    return got.groupBy(F.col("l_orderkey").alias("pos_id")).agg(F.count(F.lit(1)).alias("n"))


ASKED = "SELECT c_custkey AS id, c_nationkey AS nation, CASE WHEN c_custkey % 13 = 0 THEN ' ' WHEN c_custkey % 13 = 1 THEN NULL ELSE c_name END AS text FROM customer"


@query("q_cache_states", f"""SELECT id, CASE WHEN coalesce(trim(text), '') = '' THEN 'blank' WHEN nation < 12 AND id % 10 <> 0 THEN 'hit' ELSE 'miss' END AS state,
 coalesce(trim(text), '') <> '' AND nation < 12 AND id % 10 <> 0 AS valid FROM ({ASKED}) a""")
def q_cache_states(spark, d):
    """Some ids are cached, some of them under another text or model than is asked for."""
    table, at = f"cache_{uuid.uuid4().hex}", f"{folder(spark)}/cache-{uuid.uuid4().hex}"
    cache.create(spark, table, at, 8)
    try:
        asked = proxy(spark, d, ASKED)
        known = asked.where("nation < 12").withColumn("text", F.when(F.col("id") % 10 == 0, F.concat("text", F.lit(" & co"))).otherwise(F.col("text")))
        cache.fill(known, table, "hashed", buckets=8)
        cache.fill(asked.where("nation >= 12"), table, "another", buckets=8)
        return written(cache.lookup(asked, spark.table(table), "hashed").select("id", "state", F.coalesce("valid", F.lit(False)).alias("valid")), "asked")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
