"""Every operator as a query over the given tables, with equal DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fixtures
from adlens.sources.materialise import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None


class Catalogue:
    """Collects cases under a decorator."""

    def __init__(self) -> None:
        self.cases: dict[str, Case] = {}

    def case(self, name: str, sql: str | None = None, tables: str = ""):
        def register(query: Query) -> Query:
            if name in self.cases:
                raise ValueError(f"duplicate case {name}")
            self.cases[name] = Case(query, fixtures.with_tables(tables, sql) if sql else None)
            return query

        return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that the order of additions does not show."""
    return df.select(
        *[
            (F.round(c, digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes
        ]
    )


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def all_cases() -> dict[str, Case]:
    from catalogue import abtests, modelling, monitoring, profiles, rows, streams, tables

    out: dict[str, Case] = {}
    for module in (tables, rows, profiles, modelling, abtests, monitoring, streams):
        clash = out.keys() & module.catalogue.cases.keys()
        if clash:
            raise ValueError(f"duplicate cases {clash}")
        out |= module.catalogue.cases
    return out
