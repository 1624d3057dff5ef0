"""Fiscal calendar: (year, period 1-13, week)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rules


def gap(lead_year: Column, lead_period: Column, pos_year: Column, pos_period: Column, rules: Rules = Rules()) -> Column:
    """Periods from the transaction to the lead."""
    return (lead_year - pos_year) * rules.periods + (lead_period - pos_period)


def fiscal_class(ly: Column, lp: Column, lw: Column, py: Column, pp: Column, pw: Column, rules: Rules = Rules()) -> Column:
    """NORMAL, or for a transaction before the lead CE within the window and OAF beyond it."""
    before = (py < ly) | (py == ly) & (pp < lp)
    if rules.grain == "week":
        before = before | (py == ly) & (pp == lp) & (F.coalesce(pw, F.lit(0)) < F.coalesce(lw, F.lit(0)))
    g = gap(ly, lp, py, pp, rules)
    return F.when(~before, "NORMAL").when(g <= rules.window, "CE").otherwise("OAF")


def predates(ly: Column, lp: Column, lw: Column, py: Column, pp: Column, pw: Column) -> Column:
    return F.struct(py.alias("y"), pp.alias("p"), pw.alias("w")) < F.struct(ly.alias("y"), lp.alias("p"), lw.alias("w"))


def shift_back(year: Column, period: Column, by: int, rules: Rules = Rules()) -> tuple[Column, Column]:
    n = year * rules.periods + period - 1 - by
    return F.floor(n / rules.periods).cast("int"), (F.pmod(n, F.lit(rules.periods)) + 1).cast("int")


def to_timestamp(year: Column, period: Column, week: Column) -> Column:
    day = (period - 1) * 28 + (week - 1) * 7
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day.cast("int")).cast("timestamp")
