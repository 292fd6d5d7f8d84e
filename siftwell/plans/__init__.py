"""Registered queries over the driver's tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import matching, scoring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**scoring.QUERIES, **matching.QUERIES}
SQL: dict[str, str] = {**scoring.SQL, **matching.SQL}
