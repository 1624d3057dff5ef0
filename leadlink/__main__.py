"""python -m leadlink TASK ROOT: preflight, match, report, smoke or summary on Parquet tables.

ROOT holds leads and transactions (see engine.match); a run is written beside them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import engine
from .config import load_rules, parse_scope
from .operators import analytics, matching, writeback
from .schemas import OUTPUT_36
from .sources import files


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="leadlink", description=__doc__)
    p.add_argument("task", choices=["preflight", "match", "report", "smoke", "summary"])
    p.add_argument("root")
    p.add_argument("--run", default="run")
    p.add_argument("--rules")
    p.add_argument("--scope", default="ALL")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    rules, scope = load_rules(a.rules), parse_scope(a.scope)
    spark = SparkSession.builder.getOrCreate()
    out = files.run_path(a.root, "all", a.run, a.dry_run)
    if a.task in ("preflight", "match"):
        leads, pos = (files.read_table(spark, f"{a.root}/{n}").where(matching.in_scope("territory", scope)) for n in ("leads", "transactions"))
        if a.task == "preflight":
            print(leads.count(), "leads,", pos.count(), "transactions")
            return 0
        files.write_run(engine.match(leads, pos, a.run, rules).decisions, a.root, "all", a.run, a.dry_run)
        return 0
    decisions = files.read_table(spark, out)
    if a.task == "report":
        table = decisions.withColumns({"similarity_score": F.col("final_score"), "fiscal_year_transaction": F.col("pos_year"), "fiscal_period_transaction": F.col("pos_period"), "week": F.col("pos_week"), "warehouse_number": F.col("territory"), "u_matched_lead_number": F.col("lead_id")})
        files.write_csv(table, f"{out}_csv", OUTPUT_36)
        files.write_summary(analytics.counts_map(decisions, "match_type"), f"{out}_summary")
        return 0
    found = analytics.band_audit(decisions, rules) if a.task == "smoke" else writeback.audit_row(decisions, a.run)
    row = found.first().asDict()
    print(row)
    return int(row.get("verdict") == "FAIL")


if __name__ == "__main__":
    raise SystemExit(main())
