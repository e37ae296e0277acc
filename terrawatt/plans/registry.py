"""The query catalogue: each entry pairs a Spark plan with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrawatt.plans import datasets


class Inputs:
    """Named access to base tables and derived datasets: `inputs.events`, `inputs.sale`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return datasets.frame(self.spark, self.sf_dir, name)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    oracle: str | None
    digits: dict[str, int] | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.build(Inputs(spark, sf_dir)), self.digits or {})


CATALOGUE: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, rounds: str = ""):
    """Register `fn(inputs) -> DataFrame` under `name`.

    `oracle` is DuckDB SQL over the same dataset names; `rounds` lists double columns that
    come from sums or transcendental functions: both sides round them to 6 digits (or
    `column:digits`), as their last bits depend on the order of addition or the math library.
    """
    digits = {c: int(d or 6) for c, _, d in (r.partition(":") for r in rounds.split())}

    def wrap(fn: Callable[[Inputs], DataFrame]):
        if name in CATALOGUE:
            raise ValueError(f"duplicate query {name}")
        CATALOGUE[name] = Query(name, fn, oracle, digits)
        return fn

    return wrap


def comparable(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Normalise types for a cross-engine comparison: no decimals, zone-less instants, rounding as declared."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        if field.name in digits:
            c = F.round(c, digits[field.name])
        if isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def oracle_sql(q: Query) -> str | None:
    """The full DuckDB statement: dataset CTEs, the query, and the same rounding."""
    if q.oracle is None:
        return None
    ctes = datasets.with_clause(q.oracle)
    head = f"WITH {ctes}, " if ctes else "WITH "
    rounded = ", ".join(f"round({c}, {d}) AS {c}" for c, d in (q.digits or {}).items())
    columns = f"* REPLACE ({rounded})" if rounded else "*"
    return f"{head}oracle_result AS ({q.oracle.strip()}) SELECT {columns} FROM oracle_result"
