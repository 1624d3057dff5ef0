"""Normalisation of business identities as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: whole words and their short forms
STREETS = [("STREET", "ST"), ("AVENUE", "AVE"), ("ROAD", "RD"), ("DRIVE", "DR"), ("LANE", "LN"), ("BOULEVARD", "BLVD")]
TRUE = ("true", "1", "yes", "t")
BLANK = ("", "nan", "none", "<na>")


def text(x: Column, upper: bool = False) -> Column:
    out = F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "))
    return F.upper(out) if upper else out


def address(x: Column) -> Column:
    out = text(x, upper=True)
    for word, short in STREETS:
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    return out


def state(x: Column) -> Column:
    return F.left(F.upper(F.trim(F.coalesce(x, F.lit("")))), F.lit(2))


def digits(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"\D", "")


def zip_code(x: Column) -> Column:
    return F.left(digits(x), F.lit(5))


def phone(x: Column) -> Column:
    d = digits(x)
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    return F.when(F.length(d) == 10, d).otherwise("")


def email(x: Column) -> Column:
    return F.lower(F.trim(F.coalesce(x, F.lit(""))))


def filled(x: Column) -> Column:
    """Null for blanks."""
    return F.nullif(F.trim(x), F.lit(""))


def joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])


def safe_text(x: Column) -> Column:
    t = F.trim(x)
    return F.when(F.lower(t).isin(*BLANK), F.lit("")).otherwise(F.coalesce(t, F.lit("")))


def safe_double(x: Column, default: float = 0.0) -> Column:
    t = F.trim(x)
    return F.coalesce(F.when(F.lower(t).isin(*BLANK), None).otherwise(t.try_cast("double")), F.lit(default))


def safe_bool(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin(*TRUE), F.lit(False))


def with_identity(df: DataFrame, name: str, parts: list[str], prefix: str = "") -> DataFrame:
    """business_name, full_address and combined_field of a record, empty as null."""
    full = joined(*[text(F.col(p), upper=True) for p in parts])
    own = text(F.col(name), upper=True)
    return df.withColumns({
        f"{prefix}business_name": F.nullif(own, F.lit("")),
        f"{prefix}full_address": F.nullif(full, F.lit("")),
        f"{prefix}combined_field": F.nullif(joined(own, full), F.lit("")),
    })


def with_variants(df: DataFrame, names: list[str], addresses: list[str]) -> DataFrame:
    """The texts that a transaction is embedded by: one combined, each name, each address."""
    cols = {"variant_combined": F.nullif(joined(text(F.col(names[0]), True), address(F.col(addresses[0]))), F.lit(""))}
    cols |= {f"variant_name_{i}": F.nullif(text(F.col(n), True), F.lit("")) for i, n in enumerate(names)}
    cols |= {f"variant_address_{i}": F.nullif(address(F.col(n)), F.lit("")) for i, n in enumerate(addresses)}
    return df.withColumns(cols)


def append_comment(old: Column, new: Column) -> Column:
    return F.concat_ws("; ", F.nullif(old, F.lit("")), new)
