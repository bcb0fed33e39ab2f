"""Every registered query with the SQL that it must agree with."""

from __future__ import annotations

from barloom.plans import bars_plans, books_plans, more_plans, rules_plans, studies_plans  # noqa: F401
from barloom.plans.base import ORACLE, QUERIES


def flagship(spark, sf_dir: str):
    return QUERIES["entry"](spark, sf_dir)
