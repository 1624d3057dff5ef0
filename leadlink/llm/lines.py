"""Line deduplication by overlapping windows of three lines, in DataFrame operations only.

Each window of three consecutive lines is hashed to 128 bits. For every hash that occurs more than
once, the first occurrence (by doc_id, then text, then position) stays; every later one covers its
three lines. Covered positions of a document are merged and its other lines are put together again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, spread, text_key

LINES = 3


def windows(lines: str, size: int) -> str:
    """SQL for the array of (position, 128-bit hash) of all windows of an array column."""
    parts = ", ".join(f"{lines}[p + {i}]" for i in range(size))
    return f"CASE WHEN size({lines}) >= {size} THEN transform(sequence(0, size({lines}) - {size}), p -> named_struct('p', p, 'a', xxhash64({parts}), 'b', xxhash64('w', {parts}))) END"


def deduplicate(spark: SparkSession, docs: DataFrame, size: int = LINES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, n_spans (runs of removed lines) and text (what stays, with the
    line ends between) of every row of docs.

    Texts of fewer than `size` lines, empty texts and null texts (0 lines, null text) stay as they
    are. Null doc_ids come after all others. Rows that repeat both doc_id and text are one document
    and all get its result; rows that repeat a doc_id with another text come in the order of a hash
    of the text. An empty table gives an empty result. Columns besides doc_id and text are
    ignored, whatever they are named."""
    scratch = Scratch(spark, "lines")
    h1, h2 = text_key(F.col("t"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).withColumns({"k1": h1, "k2": h2})
    cut = own.where("t is not null").select("doc_id", "k1", "k2", F.split("t", "\n", -1).alias("l"))
    found = cut.select("doc_id", "k1", "k2", F.explode(F.expr(windows("l", size))).alias("w"))
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("k1").alias("i"), F.col("k2").alias("j"), F.col("w.p").alias("p"))
    rows = scratch.table(found.select(F.col("w.a").alias("a"), F.col("w.b").alias("b"), order.alias("o")), "windows")
    repeated = rows.groupBy("a", "b").agg(F.min("o").alias("first"), F.max("o").alias("last"), F.count(F.lit(1)).alias("n")).where("first <> last")
    repeated = scratch.table(repeated.drop("last"), "repeated")
    later = spread(rows, repeated, ["a", "b"], "n", rows.count()).where("o <> first").select("o.*")
    marks = later.groupBy("z", "d", "i", "j").agg(F.collect_set("p").alias("marks"))
    joined = own.join(marks, own["doc_id"].eqNullSafe(marks["d"]) & (own["k1"] == marks["i"]) & (own["k2"] == marks["j"]), "left")
    # positions of removed lines: the union of the windows, in order
    gone = f"array_sort(array_distinct(flatten(transform(marks, p -> sequence(p, p + {size - 1})))))"
    out = joined.select("doc_id", "t", F.split("t", "\n", -1).alias("l"), F.expr(f"CASE WHEN marks IS NOT NULL THEN {gone} END").alias("g"))
    spans = "size(filter(g, (x, i) -> i = 0 OR g[i - 1] <> x - 1))"
    stays = "array_join(transform(array_except(sequence(0, size(l) - 1), g), i -> l[i]), '\n')"
    return out.select(
        "doc_id",
        F.expr("CASE WHEN t IS NULL THEN 0L ELSE CAST(size(l) AS LONG) END").alias("n_lines"),
        F.expr("CASE WHEN g IS NULL THEN 0L ELSE CAST(size(g) AS LONG) END").alias("n_removed"),
        F.expr(f"CASE WHEN g IS NULL THEN 0L ELSE CAST({spans} AS LONG) END").alias("n_spans"),
        F.expr(f"CASE WHEN g IS NULL THEN t ELSE {stays} END").alias("text"),
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_line_dedup": op2}
SQL = {
    "op2_line_dedup": """
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM documents
), w AS (
  SELECT doc_id, p, line, lead(line, 1) OVER o AS l1, lead(line, 2) OVER o AS l2 FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY line, l1, l2 ORDER BY doc_id, p) AS n FROM w WHERE l2 IS NOT NULL) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, p + k AS p FROM later, (VALUES (0), (1), (2)) v(k)
), marked AS (
  SELECT l.*, g.p IS NOT NULL AS g FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.p
), run AS (
  SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY p), false) AS s FROM marked
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g) AS n_removed, count(*) FILTER (s) AS n_spans,
       coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT g), '') AS text
FROM run GROUP BY doc_id
"""
}
