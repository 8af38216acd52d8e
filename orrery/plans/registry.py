"""All registered queries and their DuckDB oracle SQL, merged from the plan modules."""

from __future__ import annotations

import importlib

# plan modules, in survey order
MODULES = ["series", "relational", "text", "joins", "splits", "metrics", "classify", "recommend", "timetable", "regress", "forecast", "models", "streaming"]


def _load():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"orrery.plans.{m}")
        for k, v in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
            queries[k] = v
        oracle.update(getattr(mod, "ORACLE", {}))
    unknown = set(oracle) - set(queries)
    if unknown:
        raise ValueError(f"oracle without query: {sorted(unknown)}")
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
