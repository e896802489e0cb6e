"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from sward.llm import catalog

PLANS = catalog.PLANS
SQL = catalog.SQL
