"""Independent SQL for the registered queries (run by DuckDB on the same tables)."""

from importlib import import_module

MODULES = ("reports", "explore", "quality", "streams", "features", "basics", "metrics")


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for module in MODULES:
        found.update(import_module(f"oracle.{module}").SQL)
    return found
