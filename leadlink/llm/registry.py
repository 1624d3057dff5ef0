"""The queries of this package and their SQL."""

from importlib import import_module

MODULES = ["simhash", "lines", "quality", "decontaminate", "tokens", "suffixes", "embeddings", "mixing", "language", "sharding", "prefixes", "licenses", "sessions"]

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"{__package__}.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
