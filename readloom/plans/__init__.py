"""Queries over the test tables."""

from __future__ import annotations

import importlib

_MODULES = ["qc", "project", "sheets", "expression", "reads", "runs", "sources", "stored"]


def _load():
    from readloom.plans import catalog

    for name in _MODULES:
        importlib.import_module(f"readloom.plans.{name}")
    return catalog


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict:
    return dict(_load().ORACLE)
