"""Runs: pruned search, remote vectors, chunks that fail, streams, file mode and the end of a run."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlink.config import Rules
from leadlink.functions import remote
from leadlink.operators import filemode, matching, neighbours
from leadlink.plans import catalogue
from leadlink.schemas import DEBUG_13
from leadlink.sources import cache
from leadlink.streaming import chunks, consume


def unit_rows(rng, n, block, spread=0.2):
    centres = rng.standard_normal((6, 12))
    x = centres[rng.integers(0, 6, n)] + rng.normal(0, spread, (n, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, block[i % len(block)], v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("gate, most, k", [(65.0, 16, 5), (-100.0, 8, 3), (99.9, 16, 5)])
def test_pruned_search_against_every_pair(spark, gate, most, k):
    rng = np.random.default_rng(int(gate) + 200)
    a = unit_rows(rng, 60, [1, 1, 1, 2]) + [(900, 1, None), (901, None, [1.0] * 12), (902, 9, [1.0] * 12)]
    b = unit_rows(rng, 400, [1, 1, 1, 2, None]) + [(901, 1, None)]
    b += [(2000 + i, *b[3][1:]) for i in range(8)]  # ties
    left = spark.createDataFrame(a, "lead_id long, territory int, v array<double>")
    right = spark.createDataFrame(b, "pos_id long, territory int, v array<double>")
    found = neighbours.search(left, neighbours.build(right, "territory", most), k, gate, size=64)
    got = sorted((r.territory, r.lead_id, r["rank"], r.pos_id) for r in found.found.collect())
    want = []
    for i, t, v in a:
        near = sorted((-round(float(np.dot(v, w)) * 100, 9), j) for j, u, w in b if t is not None and t == u and v and w)
        want += [(t, i, r + 1, j) for r, (s, j) in enumerate([x for x in near if -x[0] >= gate][:k])]
    assert got == sorted(want)
    done = {r.territory: r for r in neighbours.work(found, left, right, "territory").collect()}
    assert all(r.scored + r.pruned == r.pairs and r.pruned >= 0 for r in done.values())
    assert gate < 65 or sum(r.pruned for r in done.values()) > 0


def test_requests_are_tried_again():
    waits, calls = [], []

    def client(fails):
        def call(texts):
            calls.append(len(texts))
            if len(calls) <= len(fails):
                if isinstance(fails[len(calls) - 1], Exception):
                    raise fails[len(calls) - 1]
                return [[0.0]] * fails[len(calls) - 1]
            return [[1.0]] * len(texts)

        return call

    policy = remote.Policy(tries=4, base=1.0, jitter=0.5, longest=3.0)
    run = lambda *fails: (calls.clear(), waits.clear(), remote.request(client(fails), ["a", "b"], policy, waits.append, lambda: 1.0))[2]
    assert run() == ([[1.0]] * 2, 1, None) and waits == []
    assert run(TimeoutError(), 1, remote.Retryable("quota")) == ([[1.0]] * 2, 4, None) and waits == [1.5, 2.5, 3.0]
    v, n, error = run(*[ConnectionError("gone")] * 4)
    assert v == [None, None] and n == 4 and error == "ConnectionError: gone" and len(waits) == 3
    assert run(ValueError("no"))[1:] == (1, "ValueError: no") and waits == []
    assert run(1, 1, 1, 1)[2] == "WrongCount: 2 texts gave 1 vectors"
    with pytest.raises(ValueError):
        remote.Policy(tries=0)


def test_failed_texts_are_rows(spark):
    def client(texts):
        if any("bad" in t for t in texts):
            raise ValueError("refused")
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([("ab",), (" ab ",), ("bad",), ("",), (None,), ("abc",)], "text string")
    rows = remote.embedded(df, client, remote.Policy(batch=1, at_once=2)).cache()
    got = sorted((r.text, r.v, r.calls, r.error) for r in rows.collect())
    assert got == [("ab", [2.0], 1, None), ("abc", [3.0], 1, None), ("bad", None, 1, "ValueError: refused")]
    assert [tuple(r) for r in remote.failures(rows).collect()] == [("ValueError: refused", 1, 1)]


def test_a_run_that_fails_goes_on_where_it_ended(spark, tmp_path):
    df = chunks.cut(spark.range(100).withColumnRenamed("id", "k"), "k", 30)
    sizes = [r["count"] for r in df.groupBy("chunk").count().orderBy("chunk").collect()]
    assert sum(sizes) == 100 and max(sizes) <= 60 and len(sizes) == 4
    ledger, out, seen = chunks.Ledger(spark, f"{tmp_path}/ledger"), f"{tmp_path}/out", []

    def work(rows, broken=True):
        seen.append(rows.count())
        if broken and len(seen) == 3:
            return rows.withColumn("x", F.raise_error(F.lit("down")))
        return rows.withColumn("x", F.col("k") * 2)

    with pytest.raises(Exception, match="down"):
        chunks.run(df, "k", work, out, ledger, "r")
    states = {r.chunk: r.status for r in ledger.states("r").collect()}
    assert states == {0: "SUCCESS", 1: "SUCCESS", 2: "FAILED", 3: "PENDING"}
    assert chunks.output(spark, out, ledger, "r").count() == sum(sizes[:2])
    # a driver that died within a chunk leaves RUNNING, and perhaps files
    ledger.add([{"run_id": "r", "chunk": 3, "attempt": 1, "status": "RUNNING"}])
    again = chunks.run(df, "k", lambda rows: work(rows, False), out, ledger, "r")
    assert again == chunks.Outcome([2, 3], [0, 1])
    rows = chunks.output(spark, out, ledger, "r").select("k", "x").collect()
    assert sorted(tuple(r) for r in rows) == [(k, 2 * k) for k in range(100)]
    assert chunks.run(df, "k", work, out, ledger, "r").done == []
    partial = chunks.run(df, "k", lambda rows: rows, out, ledger, "s", failed=F.col("k") == 7)
    assert partial.done == [0, 1, 2, 3]
    assert [r.status for r in ledger.states("s").orderBy("chunk").collect()] == ["PARTIAL", "SUCCESS", "SUCCESS", "SUCCESS"]
    assert chunks.summary(ledger.events().where("run_id = 's'")).first()["left"] == 1


@pytest.mark.parametrize("seconds", [None, 3600])
def test_consumed_once_over_restarts(spark, tmp_path, seconds):
    schema = T.StructType([T.StructField("pos_id", T.LongType()), T.StructField("at", T.StringType())])
    put = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    go = lambda: consume.consume(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", schema, seconds=seconds).awaitTermination()
    put((1, "09:00"), (2, "09:00"), (None, "09:00"), (2, "09:00"))
    go()
    put((2, "10:00"), (3, "08:00"), (1, "07:00"))  # repeated, and late
    go()
    go()
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "09:00"), (2, "09:00"), (3, "08:00")]


def test_cache_embeds_only_what_it_lacks(spark, tmp_path):
    table = f"c{random.randrange(10**9)}"
    cache.create(spark, table, f"{tmp_path}/cache", 4)
    asked = spark.createDataFrame([(1, "a"), (2, "a "), (3, None), (4, "b"), (1, "a")], "id long, text string")
    assert cache.fill(asked, table, "m", buckets=4) == 3
    assert cache.fill(asked, table, "m", buckets=4) == 0
    changed = asked.withColumn("text", F.when(F.col("id") == 4, "c").otherwise(F.col("text")))
    states = {(r.id, r.state) for r in cache.lookup(changed, spark.table(table), "m").collect()}
    assert states == {(1, "hit"), (2, "hit"), (3, "blank"), (4, "miss")}
    assert {r.state for r in cache.lookup(asked, spark.table(table), "other").collect()} == {"miss", "blank"}
    v = {r.id: r.v for r in cache.vectors(changed, table, "m").collect()}
    assert v[3] is None and v[1] == v[2] and v[4] is not None
    spark.sql(f"DROP TABLE {table}")


def test_every_pair_and_every_unmet_row_has_a_reason(spark):
    row = "lead_id long, pos_id long, warehouse_number int, expected_relation string, combined_similarity double, best_score double, name_score double, address_score double, email_boost double, phone_boost double, final_score double, winning_set int, fiscal_class string"
    pairs = spark.createDataFrame([
        (1, 1, 7, "same", 88.125, 80.0, 70.0, 85.126, 5.0, 0.0, 85.0, 2, "NORMAL"),
        (1, 2, 7, None, 70.0, 60.0, 60.0, 60.0, 0.0, 0.0, 60.0, 1, "NORMAL"),
        (2, 1, 7, None, 70.0, None, None, None, None, None, None, None, "NORMAL"),
        (2, 3, 7, None, 70.0, None, None, None, None, None, None, None, "CE"),
        (2, 4, 7, None, 70.0, None, None, None, None, None, None, None, "OAF"),
    ], row)
    leads = spark.createDataFrame([(1, 7, True), (2, 7, True), (3, 8, True), (4, 8, False), (5, 8, None)], "lead_id long, warehouse_number int, has_vector boolean")
    pos = spark.createDataFrame([(i, 7, i != 6, f"e{i}") for i in range(1, 7)], "pos_id long, warehouse_number int, has_vector boolean, expected_relation string")
    frame = filemode.candidate_frame(pairs, leads, pos, Rules())
    assert frame.columns == DEBUG_13
    rows = {(r.lead_id, r.pos_id): r for r in frame.collect()}
    assert {k: r.decision for k, r in rows.items()} == {
        (1, 1): "Potential", (1, 2): "No Match", (2, 1): "NO_EMBEDDING", (2, 3): "CE", (2, 4): "OAF",
        (3, None): "No Match", (4, None): "NO_EMBEDDING", (5, None): "NO_EMBEDDING", (None, 5): "No Match", (None, 6): "NO_EMBEDDING",
    }
    assert tuple(rows[1, 1])[2:11] == (7, "same", 88.13, 70.0, 85.13, 5.0, 0.0, 85.0, 2)
    assert rows[None, 5].expected_relation == "e5" and rows[2, 3].final_score is None and all(r.reason for r in rows.values())
    assert {r.decision: r.n for r in filemode.tally(frame).collect()} == {"Potential": 1, "No Match": 3, "NO_EMBEDDING": 4, "CE": 1, "OAF": 1}


def test_blocked_search_scores_as_sql(spark):
    # equal vectors tie whatever place of a product they have; null components, other lengths and other blocks find nothing; NaN goes first
    rng = np.random.default_rng(5)
    a, b = unit_rows(rng, 30, [1, 1, 2]), unit_rows(rng, 300, [1, 1, 2, None])
    b += [(2000 + i, *b[3 + 4 * (i % 3)][1:]) for i in range(60)]
    b += [(3000 + i, 1, b[0][2]) for i in range(60)]
    odd = [(900, 1, None), (901, 1, [1.0, None] + [0.0] * 10), (902, 1, [1.0, 2.0]), (903, 9, [1.0] * 12), (904, 2, [float("nan")] * 12), (905, 1, [])]
    left = spark.createDataFrame(a + odd, "lead_id long, territory int, v array<double>")
    right = spark.createDataFrame(b + odd, "pos_id long, territory int, v array<double>")
    got = sorted((r.territory, r.lead_id, r["rank"], r.pos_id, str(r.raw)) for r in matching.knn_blocked(left, right, "territory", 7, 20.0, True, size=64).collect())
    want = []
    for i, t, v in a + odd:
        near = []
        for j, u, w in b + odd:
            if t is not None and t == u and i != j and v is not None and w is not None and len(v) == len(w) and None not in v + w:
                s = 0.0
                for x, y in zip(v, w):
                    s += x * y
                if not s * 100 < 20.0:
                    near.append((s == s, -s * 100 if s == s else 0, j, s * 100))
        want += [(t, i, r + 1, j, str(s)) for r, (_, _, j, s) in enumerate(sorted(near)[:7])]
    assert got == sorted(want)


@pytest.mark.parametrize("name", ["q_knn_blocked_topk", "q_boosts_cap", "q_debug_candidates", "q_reasoning", "q_resolve_one_to_one", "q_six_set_best"])
def test_pairs_are_scored_by_products(spark, name):
    # pair by pair, 10,256 vectors took over a minute and 100,000 did not end in time
    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "zip_with" not in plan and "embedding" in plan


def test_pruned_search_of_any_lengths(spark):
    # vectors that are not of length 1, zero or not finite; cells larger than a part; and a lead goes to a part, not to each cell
    rng = np.random.default_rng(6)
    b = [(i, t, (np.array(v) * (0.2 + i % 5)).tolist()) for i, t, v in unit_rows(rng, 500, [1, 1, 1, 2, None], 0.05)]
    b += [(900, 1, [0.0] * 12), (901, 2, [float("nan")] * 12), (902, 1, [float("inf")] + [0.5] * 11)]
    df = spark.createDataFrame(b, "id long, territory int, v array<double>")
    left, right = df.withColumnRenamed("id", "lead_id"), df.withColumnRenamed("id", "pos_id")
    rows = lambda f: sorted((r.territory, r.lead_id, r["rank"], r.pos_id, str(r.raw)) for r in f.collect())
    found = neighbours.search(left, neighbours.build(right, "territory", 64), 5, 10.0, True, size=32)
    assert rows(found.found) == rows(matching.knn_blocked(left, right, "territory", 5, 10.0, True))
    # before, one row for each query and cell, with its vector
    wide = neighbours.search(left, neighbours.build(right, "territory", 64), 5, -1e9, True)
    assert wide.visits.count() <= 2 * df.where("territory IS NOT NULL").count()
