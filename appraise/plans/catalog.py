"""Every named query, gathered from the plan modules."""

from __future__ import annotations

import importlib

from appraise.plans.registry import QUERIES, Query

PLAN_MODULES = (
    "appraise.plans.appraisal",
    "appraise.plans.lookups",
    "appraise.plans.pages",
    "appraise.plans.files",
    "appraise.plans.model",
    "appraise.plans.streams",
    "appraise.plans.branches",
    "appraise.plans.landed",
)


def all_queries() -> dict[str, Query]:
    for m in PLAN_MODULES:
        importlib.import_module(m)
    return dict(QUERIES)
