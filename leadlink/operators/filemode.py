"""File mode: every pair, and everything that met nothing, with a decision and the reason for it; the
texts of comments in that mode and in the older one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Rules
from ..schemas import DEBUG_13
from ..functions import fiscal

R = Rules()


def two(x: Column) -> Column:
    return F.round(x, 2)


def candidate_frame(pairs: DataFrame, leads: DataFrame, pos: DataFrame, rules: Rules = R) -> DataFrame:
    """The 13 columns of the debug contract, for every pair, every lead without one and every
    transaction without one; the id that a row lacks is null.

    pairs have lead_id, pos_id, warehouse_number, expected_relation, combined_similarity, best_score, name_score,
    address_score, email_boost, phone_boost, final_score, winning_set and fiscal_class. leads and pos have
    their id, warehouse_number and has_vector; pos has expected_relation. Pairs before their lead are not scored;
    of unmet rows those without a vector are told from those that nothing is near to."""
    c, s, best = F.col("fiscal_class"), F.col("final_score"), F.col("best_score")
    normal, none = c == "NORMAL", F.lit(None)
    decision = F.when(~normal, c).when(best.isNull(), "NO_EMBEDDING").when(s >= rules.floor, "Potential").otherwise("No Match")
    reason = (
        F.when(c == "OAF", f"Pre-lead > {rules.window} periods")
        .when(c == "CE", f"Pre-lead within {rules.window} periods")
        .when(best.isNull(), "No valid set scored")
        .otherwise(F.format_string("Set %d: base=%.2f + boosts -> %s", F.col("winning_set"), F.bround(best, 2), two(s).cast("string")))
    )
    shown = normal & best.isNotNull()
    number = lambda n: F.when(shown, two(F.col(n)))
    met = pairs.select(
        "lead_id", "pos_id", "warehouse_number", "expected_relation", two(F.col("combined_similarity")).alias("combined_similarity"),
        number("name_score").alias("name_score"), number("address_score").alias("address_score"),
        F.when(shown, F.col("email_boost")).otherwise(0.0).alias("email_boost"), F.when(shown, F.col("phone_boost")).otherwise(0.0).alias("phone_boost"),
        number("final_score").alias("final_score"), F.when(shown, F.col("winning_set")).alias("winning_set"),
        decision.alias("decision"), reason.alias("reason"),
    )

    def unmet(df: DataFrame, key: str, what: str) -> DataFrame:
        own = df.join(pairs.select(key).distinct(), key, "left_anti")
        has = F.coalesce("has_vector", F.lit(False))
        cols = {
            key: F.col(key), "warehouse_number": F.col("warehouse_number"),
            "expected_relation": F.col("expected_relation") if "expected_relation" in df.columns else none.cast("string"),
            "email_boost": F.lit(0.0), "phone_boost": F.lit(0.0), "decision": F.when(has, "No Match").otherwise("NO_EMBEDDING"),
            "reason": F.when(has, f"{what} has no candidate above the recall gate").otherwise(f"{what} has no vector"),
        }
        kinds = dict(met.dtypes)
        return own.select(*[cols[n].alias(n) if n in cols else none.cast(kinds[n]).alias(n) for n in DEBUG_13])

    return met.unionByName(unmet(leads, "lead_id", "lead")).unionByName(unmet(pos, "pos_id", "transaction"))


def pairs_of(near: DataFrame, scored: DataFrame, rules: Rules = R) -> DataFrame:
    """near with fiscal_class and, for pairs of class NORMAL, what they scored; other pairs have no score.
    near has the six fiscal columns; scored has lead_id, pos_id and the scores."""
    six = [F.col(f"{side}_{part}") for side in ("lead", "pos") for part in ("year", "period", "week")]
    classed = near.withColumn("fiscal_class", fiscal.fiscal_class(*six, rules))
    return classed.join(scored, ["lead_id", "pos_id"], "left")


def tally(frame: DataFrame) -> DataFrame:
    """decision and n, in the order of decisions."""
    return frame.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lead_id").alias("leads"), F.count_distinct("pos_id").alias("transactions"))


def comment(columns: list[str]) -> Column:
    """The comment of a match in file mode: set and score, what it is made of, boosts, primary."""
    has = lambda n: F.col(n) if n in columns else F.lit(None).cast("double")
    shown = lambda form, x, digits: F.format_string(form, F.bround(x, digits))
    return F.concat_ws(
        " ",
        F.format_string("Fuzzy match (set %d, score %.2f).", F.col("winning_set"), F.bround(F.col("final_score"), 2)),
        F.when(has("name_score").isNotNull(), shown("name=%.1f", has("name_score"), 1)),
        F.when(has("address_score").isNotNull(), shown("addr=%.1f", has("address_score"), 1)),
        F.when(has("email_boost") != 0, shown("email_boost=+%.0f", has("email_boost"), 0)),
        F.when(has("phone_boost") != 0, shown("phone_boost=+%.0f", has("phone_boost"), 0)),
        F.when(F.col("primary_transaction") if "primary_transaction" in columns else F.lit(False), "Primary transaction."),
    )
