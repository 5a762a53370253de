"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus the
equivalent DuckDB SQL used as the correctness oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is its DuckDB SQL (None = rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return dates_as_text(fn(spark, sf_dir))

        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def dates_as_text(df: DataFrame) -> DataFrame:
    """Report DATE columns as ISO text so both engines' results hash alike."""
    cols = [F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name)
            if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
