"""Registered queries: each one a plan over the benchmark tables, paired with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a plan under ``name``; without ``sql`` only its rows can be checked."""

    def add(build: Build) -> Build:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from sward.catalog import (  # noqa: F401
        columns,
        joins,
        learning,
        pixels,
        preparation,
        quality,
        reports,
        storage,
        streams,
    )
