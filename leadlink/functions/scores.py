"""Scores, bands and labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rules

R = Rules()


def set_score(addr: Column, name: Column, rules: Rules = R) -> Column:
    """Weighted mean of an address and a name score; null if either is."""
    return (addr * rules.address_weight + name * rules.name_weight) / (rules.address_weight + rules.name_weight)


def best_set(scores: list[Column]) -> Column:
    """struct(score, set): the highest score, the lowest set on ties; missing ones count as -1."""
    best = F.array_max(F.array(*[F.struct(F.coalesce(s, F.lit(-1.0)).alias("score"), F.lit(-i).alias("neg")) for i, s in enumerate(scores, 1)]))
    return F.struct(best["score"].alias("score"), (-best["neg"]).alias("set"))


def boost(same_email: Column, same_phone: Column, rules: Rules = R) -> Column:
    return F.when(same_email, rules.email_boost).otherwise(0.0) + F.when(same_phone, rules.phone_boost).otherwise(0.0)


def same_contact(a: Column, b: Column) -> Column:
    """Whether two normalised contacts are equal and not blank."""
    return F.coalesce((a != "") & (a == b), F.lit(False))


def final_score(raw: Column, rules: Rules = R) -> Column:
    return F.least(F.lit(rules.cap), F.round(raw, 2))


def band(score: Column, rules: Rules = R) -> Column:
    s = F.round(score, 2)
    return F.when(s >= rules.exact_score, "Exact").when(s >= rules.high, "High").when(s >= rules.medium, "Medium").when(s >= rules.floor, "Low").otherwise("Below")


def subtier(score: Column, rules: Rules = R) -> Column:
    return F.when(score >= rules.exact_score, None).when(score >= rules.high, "High").when(score >= rules.medium, "Medium").when(score >= rules.floor, "Low")


def is_exact(match_type: Column, score: Column, rules: Rules = R) -> Column:
    return F.lower(match_type).isin(*rules.exact_types) & (score.isNull() | (score >= rules.exact_score))


def priority(match_type: Column, rules: Rules = R) -> Column:
    t = F.lower(match_type)
    return F.when(t.isin(*rules.exact_types), 3).when(t == "fuzzy", 2).when(t == "manual review", 1).otherwise(0)


def lifecycle(match_type: Column, score: Column, rules: Rules = R) -> Column:
    return (
        F.when(is_exact(match_type, score, rules), "Closed - Exact")
        .when(F.lower(match_type).isin("fuzzy", "manual review") & (score >= rules.floor), "Potential")
        .otherwise("No Match")
    )


def match_result(match_type: Column, score: Column, rules: Rules = R) -> Column:
    return F.when(F.lower(match_type).isin("fuzzy", "manual review"), "Potential").when(score >= rules.exact_score, "Match").otherwise("")


def handoff_class(result: Column, score: Column, pos_id: Column, closed: Column, rules: Rules = R) -> Column:
    """Class of a row of the exact engine's file, in this precedence."""
    has = F.coalesce(F.trim(pos_id), F.lit("")) != ""
    r = F.lower(F.trim(F.coalesce(result, F.lit(""))))
    return (
        F.when(has & (r == "match") & (score >= rules.exact_score), "final_exact")
        .when(has & (r == "potential") & (score >= rules.floor) & (score < rules.exact_score), "deterministic_potential")
        .when(closed, "closed_existing")
        .otherwise("invalid")
    )


def override(exact: Column, semantic: Column, rules: Rules = R) -> Column:
    """An exact score of 100 or more wins; else the semantic one; else the exact one."""
    return F.when(exact >= rules.exact_score, exact).otherwise(F.coalesce(semantic, exact))


def first_score(*texts: Column) -> Column:
    return F.coalesce(*[t.try_cast("double") for t in texts])


# fixed values of the report's comments: a matched field and what it is matched with
MATCHED = [
    ("pos_business_name", "business_name -> oms_company"),
    ("address_line_one", "address_line_one -> oms_address_line_1"),
    ("email", "email -> oms_email_1"),
    ("phone", "phone -> oms_phone_1"),
    ("zip_code", "zip_code -> oms_zip"),
    ("city", "city -> oms_city"),
    ("state", "state -> oms_state"),
]
PRIMARY = "Designated as primary transaction (earliest fiscal period for this lead)."


def comment(columns: list[str]) -> Column:
    """The report's comment on a match, from the columns that there are: the fields of an exact
    match; set, scores and boosts of another; and whether it is the lead's primary transaction."""
    col = lambda n, kind="string": F.col(n) if n in columns else F.lit(None).cast(kind)
    score = F.coalesce(F.col("final_score"), F.lit(0.0))
    shown = lambda form, x, digits: F.format_string(form, F.bround(x, digits))
    fields = F.concat_ws(", ", *[F.when(F.coalesce(col(n), F.lit("")) != "", text) for n, text in MATCHED])
    exact = F.concat_ws(
        " ",
        F.concat(F.lit("Complete Match (score "), score.cast("string"), F.lit("/"), score.cast("string"), F.lit(").")),
        F.when(fields != "", F.concat(F.lit("Fields matched: "), fields, F.lit("."))),
    )
    number = lambda n: col(n, "double")
    other = F.concat_ws(
        " ",
        F.concat(F.lit("Fuzzy match (set "), F.coalesce(col("winning_set").cast("string"), F.lit("")), F.lit(", score "), F.format_string("%.2f", score), F.lit(").")),
        F.when(number("business_name_score").isNotNull(), F.concat(F.lit("name_score="), shown("%.1f", number("business_name_score"), 1))),
        F.when(number("full_address_score").isNotNull(), F.concat(F.lit("addr_score="), shown("%.1f", number("full_address_score"), 1))),
        F.when(number("email_boost") != 0, F.concat(F.lit("email_boost=+"), shown("%.0f", number("email_boost"), 0))),
        F.when(number("phone_boost") != 0, F.concat(F.lit("phone_boost=+"), shown("%.0f", number("phone_boost"), 0))),
    )
    is_exact = F.lower(F.trim(F.coalesce(F.col("match_type"), F.lit("")))) == "exact"
    return F.concat_ws(" ", F.when(is_exact, exact).otherwise(other), F.when(col("primary_transaction", "boolean"), PRIMARY))


def reasoning(addr: Column, name: Column, boosts: Column, stored: Column, rules: Rules = R) -> tuple[Column, Column]:
    """A sentence on how a score came about, and whether the arithmetic gives it (within 0.01)."""
    again = final_score(set_score(addr, name, rules) + boosts, rules)
    driver = F.when(F.abs(addr - name) < 1, "balanced").when(addr > name, "address").otherwise("name")
    return F.format_string("address %.2f, name %.2f, boost %.0f: %.2f by %s", addr, name, boosts, again, driver), F.abs(again - stored) <= 0.01
