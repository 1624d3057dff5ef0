"""The linkage engine on small tables, with the unit vectors of the matching contract."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlink.config import Rules, load_rules, parse_limit, parse_scope
from leadlink.functions import embed, fiscal, normalize, scores, vectors
from leadlink.operators import analytics, matching, writeback
from leadlink.schemas import INTERNAL_25, OUTPUT_36, conform, validate_contract
from leadlink.sources import files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "f, given, wanted",
    [
        (normalize.state, " wa ", "WA"),
        (normalize.state, "Texas", "TE"),
        (normalize.state, None, ""),
        (normalize.zip_code, "98225-1234", "98225"),
        (normalize.zip_code, "9-8", "98"),
        (normalize.phone, "1-425-555-0100", "4255550100"),
        (normalize.phone, "555-0100", ""),
        (lambda x: normalize.text(x, True), "  Acme   Widgets ", "ACME WIDGETS"),
        (normalize.address, "12 Oak Street", "12 OAK ST"),
        (normalize.address, "1 Streetcar Avenue", "1 STREETCAR AVE"),
        (normalize.email, " A@B.C ", "a@b.c"),
        (normalize.safe_bool, "Yes ", True),
        (normalize.safe_double, "nan", 0.0),
        (normalize.safe_double, "1.5", 1.5),
    ],
)
def test_normalize(spark, f, given, wanted):
    assert one(spark, f(F.lit(given).cast("string"))) == wanted


def test_set_score_vectors(spark):
    f = lambda a, n: one(spark, scores.final_score(scores.set_score(F.lit(a), F.lit(n))))
    assert [f(99.42, 100.0), f(88.5, 75.0), f(71.0, 68.0)] == [99.67, 82.71, 69.71]
    assert one(spark, scores.final_score(F.lit(98.0) + scores.boost(F.lit(True), F.lit(True)))) == 99.999


@pytest.mark.parametrize("lead, pos, wanted", [((2024, 10), (2024, 4), "CE"), ((2024, 10), (2024, 3), "OAF"), ((2024, 10), (2024, 10), "NORMAL"), ((2024, 2), (2023, 9), "CE")])
def test_fiscal(spark, lead, pos, wanted):
    c = [F.lit(x) for x in (*lead, 1, *pos, 1)]
    assert one(spark, fiscal.fiscal_class(*c)) == wanted


@pytest.mark.parametrize(
    "scores_, winner, kind",
    [([91.0, 90.0], 91.0, "Manual Review"), ([91.0, 87.0], 91.0, "Fuzzy"), ([71.0, 69.0], 71.0, "Fuzzy"), ([91.0, 88.0], 91.0, "Manual Review")],
)
def test_resolve(spark, scores_, winner, kind):
    df = spark.createDataFrame([(i, 1, s) for i, s in enumerate(scores_)], "lead_id int, pos_id int, final_score double")
    row = matching.resolve(df).first()
    assert (row["final_score"], row["match_type"]) == (winner, kind)


def test_best_set_takes_lowest_of_equals(spark):
    b = one(spark, scores.best_set([F.lit(5.0), F.lit(None).cast("double"), F.lit(7.0), F.lit(7.0)]))
    assert (b["score"], b["set"]) == (7.0, 3)


def test_handoff(spark):
    rows = [("Match", 150.0, "p", False, "final_exact"), ("Match", 100.0, "p", False, "final_exact"), ("Potential", 95.0, "p", False, "deterministic_potential"), ("Potential", 70.0, "p", False, "deterministic_potential"), ("", 0.0, " ", True, "closed_existing"), ("Match", 99.0, "p", False, "invalid"), (None, None, None, None, "invalid")]
    df = spark.createDataFrame(rows, "match_result string, similarity_score double, pos_id string, closed_existing_flag boolean, wanted string")
    assert analytics.with_handoff_class(df).where("handoff_class <> wanted").count() == 0


def test_duplicate_owners(spark):
    df = spark.createDataFrame([("a", "1", 150.0), ("b", "1", 120.0), ("a", "2", 150.0), ("b", "2", 150.0), ("a", "3", 150.0)], "lead_id string, pos_id string, similarity_score double")
    assert {r["pos_id"]: r["disposition"] for r in analytics.duplicate_owners(df).collect()} == {"1": "conflict", "2": "ambiguous"}


def test_scope_limit_rules(tmp_path):
    assert parse_scope("") is None and parse_scope("all") is None and parse_scope("12, 34") == {12, 34}
    assert parse_scope("12", "5") == {5}
    with pytest.raises(ValueError):
        parse_scope("abc")
    assert parse_limit(" all ") is None and parse_limit("3") == 3
    with pytest.raises(ValueError):
        parse_limit("0")
    (tmp_path / "r.json").write_text('{"floor": 60}')
    assert load_rules(str(tmp_path / "r.json")).floor == 60
    with pytest.raises(ValueError):
        Rules(floor=120)


def test_bad_vectors_are_null(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([float("nan"), 1.0],), ([float("inf"), 1.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vectors.l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], None, None, None, None]


def test_upsert_insert_delete(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    n = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "id int, x string")
    assert sorted(writeback.insert_new(t, n, ["id"]).collect()) == [(1, "a"), (2, "b"), (3, "d")]
    assert sorted(writeback.upsert(t, n.where("x <> 'e'"), ["id"]).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    keys = spark.createDataFrame([(1,), (None,)], "id int")
    assert writeback.delete(t, keys, ["id"]).collect() == [(2, "b")]


def test_csv_contract_round_trip(spark, tmp_path):
    rows = [("l1", 'say "hi", then\nleave', "p1"), ("l2", "", "p2")]
    df = spark.createDataFrame(rows, "lead_id string, matching_comments string, pos_id string")
    files.write_csv(df, f"file://{tmp_path}/out", OUTPUT_36)
    back = files.read_csv(spark, f"file://{tmp_path}/out", OUTPUT_36)
    validate_contract(back, OUTPUT_36)
    assert back.where("lead_id = 'l1'").first()["matching_comments"] == rows[0][1]
    assert files.read_ids(spark, f"file://{tmp_path}/o*", OUTPUT_36, "pos_id").count() == 2
    with pytest.raises(ValueError):
        validate_contract(df, INTERNAL_25)
    assert conform(df, INTERNAL_25).columns == INTERNAL_25


def test_snapshots_and_runs(spark, tmp_path):
    df = spark.range(3)
    files.publish(df, f"file://{tmp_path}/s", "1")
    files.publish(df.limit(1), f"file://{tmp_path}/s", "2")
    assert files.latest(spark, f"file://{tmp_path}/s").count() == 1
    files.write_run(df, f"file://{tmp_path}", 7, "r1")
    assert files.run_catalogue(spark, f"file://{tmp_path}").select("territory", "run_id").collect() == [(7, "r1")]
    with pytest.raises(ValueError):
        files.run_path("x", "..", "r")


def test_incremental_ingest(spark, tmp_path):
    from leadlink.streaming.ingest import ingest

    src, dst, ck = (f"file://{tmp_path}/{n}" for n in ("in", "out", "ck"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "pos_id int, x string")
    df.coalesce(1).write.parquet(src)
    ingest(spark, src, dst, ck, df.schema).awaitTermination()
    spark.createDataFrame([(2, "z"), (3, "c")], df.schema).coalesce(1).write.mode("append").parquet(src)
    ingest(spark, src, dst, ck, df.schema).awaitTermination()
    assert sorted(spark.read.parquet(dst).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_embedding_against_loop(spark):
    import zlib

    df = spark.createDataFrame([("Acme", "Acme"), (" ", "Bolt"), (None, "Bolt")], "a string, b string")
    got = {r["text"]: r["v"] for r in embed.embed_distinct(df, ["a", "b"]).collect()}
    assert sorted(got) == ["Acme", "Bolt"]
    v = [0.0] * embed.DIM
    s = " acme "
    for n in (2, 3):
        for i in range(len(s) - n + 1):
            h = zlib.crc32(s[i : i + n].encode())
            v[h % embed.DIM] += 1 if h >> 31 else -1
    norm = sum(x * x for x in v) ** 0.5
    assert got["Acme"] == pytest.approx([x / norm for x in v], abs=1e-7)
    assert embed.cached(df, spark.createDataFrame([("Acme", [1.0])], "text string, v array<double>"), ["b"]).count() == 2


def test_questions():
    assert analytics.plan_question("Which rows need manual review?")[0] == "review"
    assert analytics.plan_question("hello")[0] == "general"


def test_every_pair_gets_a_decision(spark):
    df = spark.createDataFrame([(80.0, "NORMAL"), (60.0, "NORMAL"), (80.0, "CE"), (80.0, "OAF"), (None, "NORMAL")], "final_score double, fiscal_class string")
    assert [r["decision"] for r in matching.debug_candidates(df).collect()] == ["Potential", "No Match", "CE", "OAF", "NO_EMBEDDING"]


def test_knn_plan_limits_groups_early(spark):
    e = spark.createDataFrame([(1, i, [1.0, float(i)]) for i in range(5)], "territory int, id int, v array<double>")
    found = matching.knn_blocked(e.withColumnRenamed("id", "lead_id"), e.withColumnRenamed("id", "pos_id"), "territory", 2, 0.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_golden_scenarios(spark, tmp_path):
    from leadlink import engine, synth
    from leadlink.__main__ import main

    leads, pos, expected = synth.scenarios()
    leads = spark.createDataFrame(leads, f"lead_id string, {synth.COLUMNS}")
    pos = spark.createDataFrame(pos, f"pos_id string, {synth.COLUMNS}")
    run = engine.match(leads, pos, "r", Rules(recall_gate=50.0))
    rows = run.decisions.collect()
    assert len({r["pos_id"] for r in rows}) == len(rows)
    kind = {r["lead_id"]: r["match_type"] for r in rows if r["lead_id"][1:] == r["pos_id"][1:]}
    for lead, relation in expected.items():
        if relation == "exact_single":
            assert kind[lead] == "Exact"
        elif relation == "fuzzy_candidate":
            assert kind[lead] in ("Fuzzy", "Manual Review")
        else:
            assert lead not in kind
    assert all(r["final_score"] == 100 if r["match_type"] == "Exact" else 70 <= r["final_score"] <= 99.999 for r in rows)
    primary = [r["lead_id"] for r in rows if r["primary_transaction"]]
    assert len(primary) == len(set(primary))
    stubs = {r["lead_id"] for r in run.ce_stubs.collect() if r["lead_id"][1:] == r["pos_id"][1:]}
    assert stubs == {k for k, v in expected.items() if v == "closed_existing"}
    leads.write.parquet(f"file://{tmp_path}/leads")
    pos.write.parquet(f"file://{tmp_path}/transactions")
    (tmp_path / "rules.json").write_text('{"recall_gate": 50}')
    for task in ("preflight", "match", "report", "smoke", "summary"):
        assert main([task, f"file://{tmp_path}", "--rules", f"{tmp_path}/rules.json"]) == 0


@pytest.mark.parametrize("shown, other, won", [("name", "name_2", 2), ("name", "name_3", 6), ("street", "street_2", 3)])
def test_match_by_a_later_variant_only(spark, shown, other, won):
    from leadlink import engine, synth

    base = {"territory": 1, "year": 2024, "period": 5, "week": 1, "name": "Harbor Light Bakery", "street": "12 Quay Street", "town": "Salem", "region": "OR", "postcode": "97301", "email": "a@b.co", "phone": ""}
    later = ["name_2", "name_3", *(f"{n}_{i}" for i in (2, 3) for n in ("street", "town", "region", "postcode", "email"))]
    fields = synth.COLUMNS + "".join(f", {n} string" for n in later)
    row = base | {"pos_id": "p", "email": "x@y.co", shown: "Zyqx Vwmk 7788"} | dict.fromkeys(later)
    if shown == "street":
        row |= {"town": "Juneau", "region": "AK", "postcode": "99801", "town_2": "Salem", "region_2": "OR", "postcode_2": "97301", "email_2": "a@b.co"}
    if other == "name_3":  # the third name goes with the third address
        row |= {"street_3": base["street"], "town_3": "Salem", "region_3": "OR", "postcode_3": "97301", "email_3": "a@b.co"}
    row[other] = base[shown]
    leads = spark.createDataFrame([base | {"lead_id": "l"}], f"lead_id string, {synth.COLUMNS}")
    pos = spark.createDataFrame([row], f"pos_id string, {fields}")
    run = engine.match(leads, pos, "r", Rules())
    (got,) = run.decisions.collect()
    assert (got["lead_id"], got["match_type"], got["winning_set"]) == ("l", "Fuzzy", won) and got["final_score"] >= 99
    boosts = [(r["email_boost"], r["phone_boost"]) for r in run.candidates.collect()]
    assert boosts == [(0.0 if other == "name_2" else 5.0, 0.0)]


def test_steps(spark):
    from leadlink.operators import steps

    df = spark.createDataFrame([("a", " ", "x"), ("a", "y", None), ("b", None, "")], "id string, p string, q string")
    assert [r["f"] for r in steps.fallback(df, "f", ["p", "q"]).collect()] == ["x", "y", None]
    assert sorted(r["id"] for r in steps.without_collisions(df, "id", ["q"]).collect()) == ["a", "a-2", "b"]
    assert [r["p"] for r in steps.blank_out(df, ["p"], F.col("id") == "a").collect()] == [None, None, None]
    assert [r["id"] for r in steps.keyset_page(df, "id", "a", 5).collect()] == ["b"]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id int, v array<double>")
    with pytest.raises(ValueError):
        steps.knn_global(v.withColumnRenamed("id", "lead_id"), v.withColumnRenamed("id", "pos_id"))
    assert steps.knn_global(v.withColumnRenamed("id", "lead_id"), v.withColumnRenamed("id", "pos_id"), gate=50, allowed=True).count() == 2
    leads = spark.createDataFrame([(1, 7, 10), (2, 8, 20)], "lead_id int, territory int, account_id int")
    tables = {"lead": leads, "account": spark.createDataFrame([(10,), (20,), (None,)], "account_id int"), "contact": spark.createDataFrame([(1, "c"), (2, "d")], "lead_id int, c string")}
    left = steps.purge(tables, 7)
    assert [left[n].collect()[0][0] for n in ("lead", "account", "contact")] == [2, 20, 2] and left["account"].count() == 1


# ---- sources by their headers, snapshots, rules of the six sets ----
def test_csv_is_read_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('pos_id, lead_id ,extra\np1,"l ""1""\nx",z\np2\n')
    (tmp_path / "b.csv").write_text("﻿lead_id,pos_id\nl3,p3\n")
    got = files.read_csv(spark, f"file://{tmp_path}/*.csv", ["lead_id", "pos_id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, [Row(lead_id='l "1"\nx', pos_id="p1"), Row(lead_id=None, pos_id="p2"), Row(lead_id="l3", pos_id="p3")]))
    with pytest.raises(ValueError, match="score"):
        files.read_csv(spark, f"file://{tmp_path}/a.csv", ["lead_id", "score"])
    assert files.read_csv(spark, f"file://{tmp_path}/none*.csv", ["lead_id"]).count() == 0


def test_a_snapshot_counts_once_it_is_whole(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    with pytest.raises(FileNotFoundError):
        files.latest(spark, root)
    files.publish(spark.range(3), root, "2024-01-01")
    (tmp_path / "s" / "snapshot=2024-02-01").mkdir()  # one that is being written
    assert files.latest(spark, root).count() == 3


def test_json_and_annotations(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"a": 1},\n {"a": 2, "b": "x"}]')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert sorted(map(tuple, files.read_json(spark, f"file://{tmp_path}/r.json", schema).collect())) == [(1, None), (2, "x")]
    for note in ("first", "second"):
        files.annotate(spark, f"file://{tmp_path}/notes", "run", "L1", note)
    assert sorted(r["note"] for r in spark.read.parquet(f"file://{tmp_path}/notes").collect()) == ["first", "second"]


def test_first_score_and_timestamps(spark):
    df = spark.createDataFrame([("x", "7.5", 2024, 2, 3), (None, "", 2024, 1, 1)], "a string, b string, y int, p int, w int")
    r = df.select(scores.first_score(F.col("a"), F.col("b")).alias("s"), fiscal.to_timestamp(F.col("y"), F.col("p"), F.col("w")).cast("string").alias("t")).collect()
    assert [tuple(x) for x in r] == [(7.5, "2024-02-12 00:00:00"), (None, "2024-01-01 00:00:00")]


def test_sets_of_missing_names(spark):
    rows = [(1, 80.0, None, None, 70.0, None, None), (2, None, 90.0, None, 70.0, None, None), (3, float("nan"), None, None, 70.0, None, None), (4, 50.0, None, 60.0, None, None, 80.0), (5, None, None, None, 70.0, None, None)]
    df = spark.createDataFrame(rows, "id int, n1 double, n2 double, n3 double, a1 double, a2 double, a3 double")
    got = {r["id"]: (round(r["best_score"], 4), r["winning_set"]) for r in matching.score_sets(df, ["n1", "n2", "n3"], ["a1", "a2", "a3"]).collect()}
    assert got == {1: (round(520 / 7, 4), 1), 2: (round(550 / 7, 4), 2), 3: (40.0, 1), 4: (round(500 / 7, 4), 6)}
