"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatmill.deploy import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of `Tables` under its own name, with the equivalent SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(ship(spark), sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
