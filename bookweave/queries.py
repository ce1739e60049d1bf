"""All registered queries and their SQL."""

from __future__ import annotations

from bookweave.plans import audits, checks, core, days, special

PLANS = [core, checks, days, audits, special]


def queries():
    return {name: f for plan in PLANS for name, f in plan.queries().items()}


def oracle_sql():
    return {name: sql for plan in PLANS for name, sql in plan.oracle_sql().items()}
