"""The named queries over the given tables, each with SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when they are asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        prepare(spark)
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of Tables under its name, with the SQL that it must agree with, if there is any."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[key] = sql.strip()
        return fn

    return register


for part in ("segments", "text", "curation", "vectors", "spatial", "signal", "streams", "files"):
    importlib.import_module(f"voxlake.plans.{part}") if importlib.util.find_spec(f"voxlake.plans.{part}") else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL


def entry(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["speaker_timeline"](spark, folder)
