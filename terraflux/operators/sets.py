"""Sorts, first-k reports, duplicates and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.functions.scalars import convert


def order_observations(df: DataFrame, site: str, time: str) -> DataFrame:
    """By site, then time."""
    return df.orderBy(site, time)


def first_k(df: DataFrame, keys: list[str], order: list[str], k: int, name: str) -> DataFrame:
    """Per key the number of rows and the first k values of the last order column, joined by commas."""
    # the filter on the place lets each task keep k rows of a key before any are moved; the count is pre-aggregated
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.withColumn("__place", place).filter(F.col("__place") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__place", F.col(order[-1]).cast("string").alias("v")))).alias(name))
    first = first.withColumnsRenamed({c: f"__{c}" for c in keys})
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    same = reduce(Column.__and__, [counts[c].eqNullSafe(first[f"__{c}"]) for c in keys])
    return counts.join(first, same).select(*keys, "n", F.array_join(F.col(name).getField("v"), ",").alias(name))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def at_step(df: DataFrame, time: str, n: int) -> DataFrame:
    """T4: the rows of the n-th distinct time, from 0; only that many times are looked at."""
    times = df.select(time).distinct().orderBy(time).limit(n + 1)
    chosen = times.orderBy(F.desc(time)).limit(1) if n == 0 else times.agg(F.max(time).alias(time), F.count("*").alias("__n")).filter(F.col("__n") == n + 1).select(time)
    return df.join(F.broadcast(chosen), time, "left_semi")  # one row


def concat_time(parts: list[tuple[DataFrame, str]], value: str, step: Column | float = 1.0) -> DataFrame:
    """Parts one after another, each converted from its units to the first part's."""
    target = parts[0][1]
    return reduce(DataFrame.unionByName, [df.withColumn(value, convert(F.col(value), units, target, step)) for df, units in parts])


def union_sites(tables: list[DataFrame]) -> DataFrame:
    """Rows of all tables, columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def intersect_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys in both."""
    return a.intersect(b)


def pending(catalog: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """U4: inputs that are not done."""
    return catalog.join(done.select(*keys), keys, "left_anti")


def split_by_year(df: DataFrame, time: str, path: str, tasks: int | None = None) -> None:
    """A folder year=... per year under path, Parquet; the rows of a year are dealt to tasks by its month, so that few files result."""
    by = [F.col("year"), F.month(time)]
    dealt = df.withColumn("year", F.year(time))
    (dealt.repartition(tasks, *by) if tasks else dealt.repartition(*by)).write.partitionBy("year").parquet(path)
