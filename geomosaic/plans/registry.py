"""The table of registered queries. Each has a Spark plan and, where SQL can say it, a twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geomosaic.plans import views_sql

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under a name, with the SQL that must give the same rows."""

    def add(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = oracle_text(sql)
        return plan

    return add


def oracle_text(body: str) -> str:
    """Put the views that a statement names in front of it, in order of dependence."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for view in views_sql.VIEWS:
            if view not in wanted and re.search(rf"\b{view}\b", text):
                wanted.add(view)
                visit(views_sql.VIEWS[view])

    visit(body)
    heads = [f"{v} AS ({views_sql.VIEWS[v].strip()})" for v in views_sql.VIEWS if v in wanted]
    text = body.strip()
    if not heads:
        return text
    # a statement with views of its own goes on with the list
    own = re.match(r"with\s+", text, re.IGNORECASE)
    return "WITH " + ",\n".join(heads) + (",\n" + text[own.end() :] if own else "\n" + text)
