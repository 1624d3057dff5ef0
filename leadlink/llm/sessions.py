"""Sessions of clicks by gap, final click and length, from summaries of time cells.

A cell is as wide as the gap, so no gap lies within one, and a gap between clicks of two cells shows in
the maximum of one and the minimum of the next. The clicks of a client and cell are aggregated to pieces,
which end at final clicks, and pieces to cells. Islands (runs without a gap or a final click) are found on
the cells alone and joined back to the pieces. Runs over `length` are then cut: every click of theirs
points to the first one of its run that is over `length` later, and the pointers are doubled until all
starts of sessions that can be reached from the start of a run are marked.

The last start before a cell is found in two steps, within a block of cells and over the blocks of a client
(one row for each), so no task takes the rows of a whole client, and nothing is broadcast or collected.
Clicks themselves are shuffled twice: by click_id, as they repeat, and by client and cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

MINUTE = 60_000_000
BLOCK = 96
FINAL = ("purchase", "signup")


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone is read as UTC, whatever the session's zone is."""
    t = F.col(name)
    if dict(df.dtypes)[name] == "timestamp":
        return F.unix_micros(t)
    day = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    second = (F.expr(f"extract(SECOND FROM `{name}`)") * 1_000_000).cast("long")
    return ((day * 24 + F.hour(t)) * 60 + F.minute(t)) * MINUTE + second


def merged(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by shuffle: the sides grow with the input, so neither is broadcast."""
    return a.hint("merge").join(b.hint("merge"), on, how)


def before(cells: DataFrame, start: str) -> DataFrame:
    """client_id, cell and `earlier`: the largest not null `start` of the client's earlier cells."""
    cells = cells.withColumn("block", F.floor(F.col("cell") / BLOCK))
    upto = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = cells.groupBy("client_id", "block").agg(F.max(start).alias("m"))
    blocks = blocks.select("client_id", "block", F.max("m").over(upto("client_id").orderBy("block")).alias("o"))
    cells = cells.withColumn("p", F.max(start).over(upto("client_id", "block").orderBy("cell")))
    return merged(cells, blocks, ["client_id", "block"]).select("client_id", "cell", F.coalesce("p", "o").alias("earlier"))


def carried(scratch: Scratch, rows: DataFrame, start: str, out: str, name: str) -> DataFrame:
    """rows with `out`, the last not null `start` of the client at or before the row, in the order of
    (us, late, click_id). A start is a struct (us, click_id) of its own row, so the last is the largest."""
    upto = Window.partitionBy("client_id", "cell").orderBy("us", "late", "click_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.max(start).over(upto))
    cells = scratch.table(rows.groupBy("client_id", "cell").agg(F.max(start).alias("m")), name)
    return merged(rows, before(cells, "m"), ["client_id", "cell"]).withColumn(out, F.coalesce("within", "earlier")).drop("within", "earlier")


def pieces(scratch: Scratch, clicks: DataFrame) -> DataFrame:
    """A row for each client, cell and piece: begin (us and click_id of its first timely click; null for late
    clicks before any), path (us, click_id and cents of its timely clicks, in order), lates (us of its late
    clicks), final (its last click is), end (us of its last click), leads and ends (it is the first, or the
    last, of its cell) and soon (microseconds from its end to the cell's next piece, null for the last)."""
    rows = clicks.withColumn("was", F.expr("lag(CASE WHEN NOT late THEN final END) IGNORE NULLS OVER (PARTITION BY client_id, cell ORDER BY us, late, click_id)"))
    begins = ~F.col("late") & F.coalesce("was", F.lit(True))
    upto = Window.partitionBy("client_id", "cell").orderBy("us", "late", "click_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("begin", F.max(F.when(begins, F.struct("us", "click_id"))).over(upto))
    parts = rows.groupBy("client_id", "cell", "begin").agg(
        F.array_sort(F.collect_list(F.when(~F.col("late"), F.struct("us", "click_id", "cents")))).alias("path"),
        F.collect_list(F.when(F.col("late"), F.col("us"))).alias("lates"),
        F.bool_or(F.col("final") & ~F.col("late")).alias("final"),
        F.bool_or(~F.col("late") & F.col("was").isNull()).alias("leads"),
    )
    next_us = F.lead("begin.us").over(Window.partitionBy("client_id", "cell").orderBy("begin"))
    parts = parts.withColumns({"end": F.try_element_at("path", F.lit(-1))["us"], "next": next_us})
    return scratch.table(parts.withColumns({"ends": F.col("end").isNotNull() & F.col("next").isNull(), "soon": F.col("next") - F.col("end")}).drop("next"), "pieces")


def islands(scratch: Scratch, parts: DataFrame, gap: int, length: int) -> DataFrame:
    """client_id and cell, from pieces, with opens (its first click follows a gap or a final click), beyond
    (microseconds from its last click to the client's next one, gap where it is that far or farther, -1 where
    there is none), earlier (the run that goes on from the cells before), and long_in and long_out: whether
    the runs of its first and of its last piece are over `length`."""
    pick = lambda where, x, name: F.max(F.when(F.col(where), F.col(x))).alias(name)
    cells = parts.groupBy("client_id", "cell").agg(
        pick("leads", "begin.us", "low"), pick("leads", "begin.click_id", "low_id"), pick("leads", "end", "low_end"),
        pick("ends", "begin.us", "out"), pick("ends", "begin.click_id", "out_id"), pick("ends", "end", "high"), pick("ends", "final", "final"),
        (F.count("end") > 1).alias("several"),
    )
    cells = scratch.table(cells, "cells")
    timely = F.col("low").isNotNull()
    # what the cells on both sides end and begin with
    none = lambda kind: F.lit(None).cast(kind)
    sides = cells.where(timely).select("client_id", (F.col("cell") + 1).alias("cell"), F.col("high").alias("prev"), F.col("final").alias("was"), none("long").alias("next"))
    sides = sides.unionByName(cells.where(timely).select("client_id", (F.col("cell") - 1).alias("cell"), none("long").alias("prev"), none("boolean").alias("was"), F.col("low").alias("next")))
    sides = sides.groupBy("client_id", "cell").agg(F.max("prev").alias("prev"), F.max("was").alias("was"), F.max("next").alias("next"))
    # whether a later cell has timely clicks: in the block, or in a later block
    blocks = cells.groupBy("client_id", F.floor(F.col("cell") / BLOCK).alias("block")).agg(F.max(F.when(timely, F.col("cell"))).alias("last"))
    later = Window.partitionBy("client_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select("client_id", "block", "last", F.max("last").over(later).isNotNull().alias("more"))
    cells = merged(cells.withColumn("block", F.floor(F.col("cell") / BLOCK)), blocks, ["client_id", "block"])
    cells = merged(cells, sides, ["client_id", "cell"], "left")
    begin, out = F.struct(F.col("low").alias("us"), F.col("low_id").alias("click_id")), F.struct(F.col("out").alias("us"), F.col("out_id").alias("click_id"))
    opens = timely & F.coalesce(F.col("was") | (F.col("low") - F.col("prev") >= gap), F.lit(True))
    goes_on = (F.col("cell") < F.col("last")) | F.col("more")
    cells = cells.select(
        "client_id", "cell", "several", "low_end", "high", F.when(timely, begin).alias("begin"), F.when(timely, out).alias("out"), opens.alias("opens"),
        F.when(F.col("next").isNotNull(), F.least(F.col("next") - F.col("high"), F.lit(gap))).when(goes_on, F.lit(gap)).otherwise(-1).alias("beyond"),
    )
    cells = scratch.table(cells.withColumn("start", F.when(F.col("several"), F.col("out")).when(F.col("opens"), F.col("begin"))), "opened")
    cells = merged(cells, before(cells, "start"), ["client_id", "cell"])
    run_in = F.when(F.col("opens"), F.col("begin")).otherwise(F.col("earlier"))
    cells = cells.select("client_id", "cell", "opens", "beyond", "earlier", "low_end", "high", run_in.alias("run_in"), F.when(F.col("several"), F.col("out")).alias("run_out"))
    cells = scratch.table(cells, "islands")
    # the run of the first piece, that of the last, and the one that late clicks before the first piece are in
    span = lambda at, run, end: F.struct(F.lit(at).alias("at"), F.col(run).alias("run"), end.alias("end"))
    every = F.array(span("in", "run_in", F.col("low_end")), span("out", "run_out", F.col("high")), span("before", "earlier", F.lit(None).cast("long")))
    spans = cells.select("client_id", "cell", F.explode(every).alias("s")).select("client_id", "cell", "s.*").where("run IS NOT NULL")
    long = spans.where(F.col("end") - F.col("run.us") > length).select("client_id", "run").distinct()
    flags = ["in", "out", "before"]
    marks = merged(spans, long, ["client_id", "run"]).groupBy("client_id", "cell").agg(*[F.bool_or(F.col("at") == x).alias(f"long_{x}") for x in flags])
    cells = merged(cells.drop("low_end", "high", "run_in", "run_out"), marks, ["client_id", "cell"], "left")
    return cells.na.fill(False, [f"long_{x}" for x in flags])


def by_length(scratch: Scratch, rows: DataFrame, gap: int, length: int) -> DataFrame:
    """(client_id, at: us and click_id) of the clicks that start a session as the run's current session began
    over `length` before. rows: timely clicks with `run`, the (us, click_id) their run starts at."""
    # each click looks for the first click after us + length; it stands in that cell or is the next cell's first
    ask = rows.select("client_id", (F.col("us") + length).alias("k"), F.lit(True).alias("asks"), "us", "click_id", "run")
    have = rows.select("client_id", F.col("us").alias("k"), F.lit(False).alias("asks"), "us", "click_id", "run")
    both = ask.unionByName(have).withColumn("cell", F.floor(F.col("k") / gap))
    # backwards; where times are equal, who asks comes first: a click that is just `length` later continues
    back = Window.partitionBy("client_id", "cell").orderBy(F.desc("k"), F.desc("asks"), F.desc("click_id")).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.last(F.when(~F.col("asks"), F.struct("us", "click_id", "run")), True).over(back)
    firsts = rows.groupBy("client_id", "cell").agg(F.min(F.struct("us", "click_id", "run")).alias("first"))
    found = merged(both.withColumn("hit", hit).where("asks"), firsts.withColumn("cell", F.col("cell") - 1), ["client_id", "cell"], "left")
    found = found.withColumn("to", F.coalesce("hit", "first")).where("to.run = run")
    at = F.struct("us", "click_id").alias("at")
    jump = scratch.table(found.select("client_id", at, F.struct("to.us", "to.click_id").alias("to")), "jump0")
    reached = merged(jump, rows.where(F.col("run") == F.struct("us", "click_id")).select("client_id", at), ["client_id", "at"]).select("client_id", "at")
    reached, step, marked = scratch.table(reached, "reached0"), 0, []
    while True:  # after step k, `reached` holds what is under 2^k sessions from the start of a run
        onward = merged(reached, jump, ["client_id", "at"]).select("client_id", F.col("to").alias("at"))
        marked.append(scratch.table(onward, f"marked{step}"))
        if marked[-1].isEmpty():
            break
        step += 1
        reached = scratch.table(reached.unionByName(marked[-1]), f"reached{step}")
        twice = merged(jump, jump.select("client_id", F.col("at").alias("to"), F.col("to").alias("far")), ["client_id", "to"])
        jump = scratch.table(twice.select("client_id", "at", F.col("far").alias("to")), f"jump{step}")
    starts = marked[0]
    for m in marked[1:]:
        starts = starts.unionByName(m)
    return starts


def long_runs(scratch: Scratch, parts: DataFrame, gap: int, length: int) -> DataFrame:
    """Sessions of the pieces of runs over `length`, click by click."""
    last = F.element_at("path", -1)
    timely = parts.where("end IS NOT NULL").select("client_id", "cell", F.col("session").alias("run"), "final", "ahead", last.alias("last"), F.explode("path").alias("x"))
    at_end = F.col("x") == F.col("last")
    timely = timely.select("client_id", "cell", "run", "x.*", F.lit(False).alias("late"), (at_end & F.col("final")).alias("final"), F.when(at_end, F.col("ahead")).otherwise(0).alias("ahead"))
    late = parts.select("client_id", "cell", F.col("session").alias("run"), F.explode("lates").alias("us"))
    none = lambda kind: F.lit(None).cast(kind)
    late = late.select("client_id", "cell", "run", "us", none("long").alias("click_id"), none("long").alias("cents"), F.lit(True).alias("late"), F.lit(False).alias("final"), none("long").alias("ahead"))
    rows = scratch.table(timely.unionByName(late), "long")
    cut = by_length(scratch, rows.where("NOT late"), gap, length).withColumn("cuts", F.lit(True))
    rows = merged(rows.withColumn("at", F.struct("us", "click_id")), cut, ["client_id", "at"], "left")
    begins = ~F.col("late") & (F.col("cuts").isNotNull() | (F.col("run") == F.col("at")))
    rows = scratch.table(rows.withColumn("start", F.when(begins, F.col("at"))).drop("cuts", "at"), "cut")
    rows = carried(scratch, rows, "start", "session", "starts")
    timely = ~F.col("late")
    found = rows.groupBy("client_id", "session").agg(
        F.max(F.when(timely, F.struct("us", "click_id", "final", "ahead"))).alias("last"),
        F.count(F.when(timely, F.lit(1))).alias("n_clicks"),
        F.count(F.when(~timely, F.lit(1))).alias("n_late"),
        F.sum(F.col("cents").cast("decimal(38,0)")).try_cast("long").alias("value_cents"),
        F.array_sort(F.collect_list(F.when(timely, F.struct("us", "click_id")))).alias("path"),
    )
    return found.select("client_id", "session", F.col("last.us").alias("end_us"), "last.final", "last.ahead", "n_clicks", "n_late", "value_cents", F.col("path.click_id").alias("clicks"))


def sessions(spark: SparkSession, clicks: DataFrame, gap: int = 15 * MINUTE, length: int = 60 * MINUTE, late: int = 15 * MINUTE, final: tuple = FINAL, least: float = 60.0) -> DataFrame:
    """One row for each session: client_id, session_id (its first click), start_us, end_us, n_clicks,
    n_late, value_cents, closed_by, and clicks: its click_ids in the order of ts and click_id.

    Rows with a null client_id or ts belong to nothing. Rows of one click_id count once; if they
    differ in what is used, the one with the smallest hash of it does; a null click_id counts as one id,
    before all others. Clicks that arrive over `late` after their time join no session; they
    count at the last session of their client that starts at or before them. A null arrived_at is
    not late. Of equal times the smaller click_id comes first. A click is final if its kind is in
    `final` and its value is `least` or more; a null kind or value is not. A value that is null, NaN or infinite
    has 0 cents, and cents that exceed a long are null. closed_by is end, gap, length or none. An empty
    table gives an empty result; columns besides click_id, ts, arrived_at, client_id, kind and
    value are ignored, whatever they are named."""
    scratch = Scratch(spark, "sessions")
    own = clicks.where("client_id IS NOT NULL AND ts IS NOT NULL")
    own = own.select("click_id", "client_id", micros(own, "ts").alias("us"), micros(own, "arrived_at").alias("arrived"), "kind", "value")
    value = F.col("value")
    cents = F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0).cast("long")).otherwise(F.floor(value * 100 + 0.5))
    rows = own.select(
        "click_id", "client_id", "us",
        F.coalesce(F.col("arrived") - F.col("us") > late, F.lit(False)).alias("late"),
        F.coalesce(F.col("kind").isin(*final) & (value >= least) & ~F.isnan(value), F.lit(False)).alias("final"),
        cents.alias("cents"),
    )
    # one row of each id, without a sort: all columns of the one with the smallest hash
    columns = ["client_id", "us", "late", "final", "cents"]
    rows = rows.withColumn("h", F.xxhash64(*columns)).groupBy("click_id").agg(*[F.min_by(c, "h").alias(c) for c in columns])
    rows = rows.withColumn("cell", F.floor(F.col("us") / gap))
    parts = pieces(scratch, rows)
    joined = merged(parts, islands(scratch, parts, gap, length), ["client_id", "cell"])
    opens_here = F.col("begin").isNotNull() & (~F.col("leads") | F.col("opens"))
    joined = joined.select(
        "client_id", "cell", "path", "lates", "final", "end",
        F.when(opens_here, F.col("begin")).otherwise(F.col("earlier")).alias("session"),
        F.when(F.col("ends"), F.col("beyond")).otherwise(F.col("soon")).alias("ahead"),
        F.when(F.col("begin").isNull(), F.col("long_before")).when(F.col("leads"), F.col("long_in")).when(F.col("ends"), F.col("long_out"))
        .otherwise(F.col("end") - F.col("begin.us") > length).alias("long"),
    )
    joined = scratch.table(joined.where("session IS NOT NULL"), "runs")
    found = joined.where("NOT long").groupBy("client_id", "session").agg(
        F.max("end").alias("end_us"), F.bool_or("final").alias("final"), F.max_by("ahead", F.col("end")).alias("ahead"),
        F.sum(F.size("path")).alias("n_clicks"), F.sum(F.size("lates")).alias("n_late"),
        F.try_sum(F.aggregate("path", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x["cents"]).cast("decimal(38,0)"))).try_cast("long").alias("value_cents"),
        F.transform(F.flatten(F.array_sort(F.collect_list("path"))), lambda x: x["click_id"]).alias("clicks"),
    )
    found = found.unionByName(long_runs(scratch, joined.where("long"), gap, length))
    closed = F.when(F.col("final"), "end").when(F.col("ahead") < 0, "none").when(F.col("ahead") >= gap, "gap").otherwise("length")
    return found.select(
        "client_id", F.col("session.click_id").alias("session_id"), F.col("session.us").alias("start_us"), "end_us",
        "n_clicks", "n_late", "value_cents", closed.alias("closed_by"), "clicks",
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions(spark, spark.read.parquet(f"{sf_dir}/clicks.parquet"))
    return found.withColumn("path_sha256", F.sha2(F.array_join(F.col("clicks").cast("array<string>"), ","), 256)).drop("clicks")


QUERIES = {"op13_gap_sessions": op13}
SQL = {
    "op13_gap_sessions": """
WITH RECURSIVE one AS (
  SELECT click_id, epoch_us(ts) AS us, client_id, epoch_us(arrived_at) AS arrived, kind, value,
         row_number() OVER (PARTITION BY click_id ORDER BY ts, client_id, arrived_at, kind NULLS FIRST, value NULLS FIRST) AS n
  FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL
), c AS (
  SELECT click_id, us, client_id, coalesce(arrived - us > 900000000, false) AS late,
         coalesce(kind IN ('purchase', 'signup') AND value >= 60, false) AS final,
         CASE WHEN value IS NULL OR NOT isfinite(value) THEN 0 ELSE CAST(floor(100 * value + 0.5) AS BIGINT) END AS cents
  FROM one WHERE n = 1
), t AS MATERIALIZED (
  SELECT *, lag(final) OVER o AS was, lag(us) OVER o AS before, lead(us) OVER o AS after, row_number() OVER o AS r
  FROM c WHERE NOT late WINDOW o AS (PARTITION BY client_id ORDER BY us, click_id)
), run AS MATERIALIZED (
  SELECT client_id, us AS s, us, r, r AS first FROM t WHERE was IS NULL OR was OR us - before >= 900000000
  UNION ALL
  SELECT t.client_id, CASE WHEN t.us - run.s > 3600000000 THEN t.us ELSE run.s END, t.us, t.r, CASE WHEN t.us - run.s > 3600000000 THEN t.r ELSE run.first END
  FROM run JOIN t ON t.client_id = run.client_id AND t.r = run.r + 1 WHERE NOT (t.was OR t.us - t.before >= 900000000)
), s AS (
  SELECT run.client_id, run.first, min(t.us) AS start_us, max(t.us) AS end_us, count(*) AS n_clicks, TRY_CAST(sum(t.cents) AS BIGINT) AS value_cents,
         arg_min({'id': t.click_id}, t.r).id AS session_id, arg_max({'f': t.final}, t.r).f AS final, arg_max({'a': t.after}, t.r).a AS after,
         sha256(string_agg(CAST(t.click_id AS VARCHAR), ',' ORDER BY t.r)) AS path_sha256
  FROM run JOIN t USING (client_id, r) GROUP BY run.client_id, run.first
), n AS (
  SELECT *, lead(start_us) OVER (PARTITION BY client_id ORDER BY first) AS next_us FROM s
), l AS (
  SELECT n.client_id, n.first, count(*) AS n_late FROM n JOIN c ON c.client_id = n.client_id AND c.late AND n.start_us <= c.us AND (n.next_us IS NULL OR c.us < n.next_us) GROUP BY ALL
)
SELECT n.client_id, session_id, start_us, end_us, n_clicks, coalesce(n_late, 0) AS n_late, value_cents,
       CASE WHEN final THEN 'end' WHEN after IS NULL THEN 'none' WHEN after - end_us >= 900000000 THEN 'gap' ELSE 'length' END AS closed_by, path_sha256
FROM n LEFT JOIN l ON l.client_id = n.client_id AND l.first = n.first
"""
}
