"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` and name -> DuckDB SQL."""

from __future__ import annotations

import importlib

_MODULES = (
    "kindling.plans.q_basic",
    "kindling.plans.q_text",
    "kindling.plans.q_similarity",
    "kindling.plans.q_graph",
    "kindling.plans.q_sets",
    "kindling.plans.q_ml",
    "kindling.plans.q_classify",
    "kindling.plans.q_stream",
    "kindling.plans.q_state",
    "kindling.plans.q_io",
)


def _load():
    queries, oracle = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        for k in mod.QUERIES:
            if k in queries:
                raise ValueError(f"duplicate query {k}")
        queries.update(mod.QUERIES)
        oracle.update(mod.ORACLE)
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
