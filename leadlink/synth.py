"""Scenario tables for tests: leads and transactions with the result that each pair should have."""

from __future__ import annotations

import random

COLUMNS = "territory int, year int, period int, week int, name string, street string, town string, region string, postcode string, email string, phone string"


def counts(total: int, shares: dict[str, float]) -> dict[str, int]:
    """Whole numbers by share; the largest scenario takes what rounding leaves."""
    out = {k: int(total * v) for k, v in shares.items()}
    out[max(shares, key=shares.get)] += total - sum(out.values())
    return out


def scenarios(total: int = 50, seed: int = 42, shares: dict[str, float] | None = None):
    """(leads, transactions, expected relation by lead)."""
    rng, leads, pos, expected = random.Random(seed), [], [], {}
    shares = shares or {"exact_single": 0.3, "fuzzy_candidate": 0.3, "closed_existing": 0.1, "oaf_drop": 0.1, "unmatched": 0.2}
    names = iter([f"{a}{b} {c}" for a in ("Nor", "Sud", "Est", "Zan", "Kel") for b in ("vale", "mark", "quist", "horn") for c in ("Works", "Bakery", "Optics", "Freight", "Garden", "Paper")])
    kinds = [k for k, n in counts(total, shares).items() for _ in range(n)]
    for i, kind in enumerate(kinds):
        name, street = next(names), f"{100 + 37 * i} {rng.choice(['Oak', 'Birch', 'Cedar'])} Street"
        base = [rng.randrange(3), 2024, 10, 2, name, street, "Town", "WA", f"{98000 + i}", f"m{i}@x.org", f"206555{1000 + i}"]
        leads.append((f"L{i}", *base))
        expected[f"L{i}"] = kind
        p = list(base)
        if kind == "unmatched":
            continue
        p[2] = {"closed_existing": 7, "oaf_drop": 2}.get(kind, 11)
        if kind != "exact_single":
            p[4], p[6] = f"{name} Inc", "Townn"
        pos.append((f"P{i}", *p))
    return leads, pos, expected
