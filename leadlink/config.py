"""Rules of the matching engine: weights, thresholds and bands, validated when they are made."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Rules:
    # fixed values of the matching contract
    address_weight: float = 4.0
    name_weight: float = 3.0
    recall_gate: float = 65.0
    floor: float = 70.0
    cap: float = 99.999
    exact_score: float = 100.0
    email_boost: float = 5.0
    phone_boost: float = 5.0
    ambiguity: float = 3.0
    window: int = 6
    periods: int = 13
    top_k: int = 20
    high: float = 90.0
    medium: float = 85.0
    spike: float = 0.15
    grain: str = "period"
    exact_types: tuple[str, ...] = ("exact", "exact match", "exact_match", "match", "deterministic")
    #: Six sets of (name variant, address variant) of a transaction, by index of its variants.
    sets: tuple[tuple[int, int], ...] = field(default=((0, 0), (1, 0), (0, 1), (1, 1), (0, 2), (2, 2)))

    def __post_init__(self):
        if not 0 <= self.recall_gate <= 100 or not 0 <= self.floor <= self.cap < self.exact_score:
            raise ValueError("gate, floor, cap and exact score are out of order")
        if self.floor > self.medium or self.medium > self.high or self.high > self.cap:
            raise ValueError("bands are out of order")
        if min(self.address_weight, self.name_weight) < 0 or self.address_weight + self.name_weight == 0:
            raise ValueError("weights must not be negative, nor all zero")
        if self.top_k < 1 or self.window < 0 or self.periods < 1:
            raise ValueError("top_k, window and periods must be positive")
        if self.grain not in ("period", "week"):
            raise ValueError("the fiscal grain is period or week")


def load_rules(path: str | None = None) -> Rules:
    """Rules from a JSON document; fields that it leaves out keep their defaults."""
    if path is None:
        return Rules()
    with open(path) as f:
        given = json.load(f)
    if unknown := set(given) - {x.name for x in fields(Rules)}:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    given = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in given.items()}
    return Rules(**given)


def parse_scope(text: str | None, override: str | None = None) -> frozenset[int] | None:
    """Territories from `ALL`, blank or a list of digits with commas; None stands for all. A
    non-blank override goes first."""
    value = (override or "").strip() or (text or "").strip()
    if not value or value.upper() == "ALL":
        return None
    parts = [x.strip() for x in value.split(",") if x.strip()]
    if not parts or not all(x.isascii() and x.isdigit() for x in parts):
        raise ValueError(f"not a list of territories: {value!r}")
    return frozenset(map(int, parts))


def parse_limit(text: str | None) -> int | None:
    """A positive limit; blank or `all` is none."""
    value = (text or "").strip().lower()
    if value in ("", "all"):
        return None
    n = int(value)
    if n < 1:
        raise ValueError("a limit must be at least 1")
    return n
