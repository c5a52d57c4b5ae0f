"""The registry of queries: a Spark job over the fixture views and, where SQL can say it, the DuckDB text of the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.plans.fixtures import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Views:
    """Fixture views and tables by name, read on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("v_"):
            return view(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places, as on the SQL side; -0.0 becomes 0.0.

    Sums of doubles differ in their last bits with the order of rows; what so lies on either side of a tie is moved off it.
    """
    return df.select(*[(F.round(F.col(f"`{c}`") + F.lit(1e-9), places) + F.lit(0.0)).alias(c) if kind in ("double", "float") else F.col(f"`{c}`") for c, kind in df.dtypes])


def query(name: str, sql: str | None = None, also: str = "") -> Callable:
    """Registers f(views) under a name, and under a second one that it had before."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        for each in filter(None, (name, also)):
            QUERIES[each] = lambda spark, sf_dir: rounded(f(Views(spark, sf_dir)))
            if sql:
                SQL[each] = sql
        return f

    return add


def duck(views: str, select: str, r: str = "") -> str:
    """DuckDB text: the views (in order of need), the select, and the columns r rounded to six places."""
    if not r:
        return f"{with_views(*views.split())} {select}" if views else select
    parts = ", ".join(f"round(CAST({c} AS DOUBLE) + 1e-9, 6) + 0.0 AS {c}" for c in r.split())
    head = with_views(*views.split()) + "," if views else "WITH"
    return f"{head} q_ AS ({select}) SELECT * REPLACE ({parts}) FROM q_"
