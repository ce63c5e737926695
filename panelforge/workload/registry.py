"""Registry of queries: a DataFrame function and its SQL twin under one name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.workload.tables import Tables
from panelforge.workload.tables_sql import build_sql


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None
    rounded: str
    digits: int

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(Tables(spark, sf_dir))
        return out.withColumns({c: F.round(F.col(f"`{c}`"), self.digits) + F.lit(0.0) for c in self.rounded.split()})

    def oracle(self) -> str | None:
        return build_sql(self.sql, self.rounded, self.digits) if self.sql else None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, rounded: str = "", digits: int = 6):
    """Register a query; ``rounded`` lists the double columns rounded on both sides."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(build, sql, rounded, digits)
        return build

    return wrap
