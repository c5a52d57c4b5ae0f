"""Generated tables: time axes, months, grids, added years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.functions.scalars import clamp


def axis_of(df: DataFrame, time: str, step: str) -> DataFrame:
    """The regular axis from the first to the last time of df."""
    span = df.agg(F.min(time).alias("a"), F.max(time).alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr(f"interval {step}"))).alias(time))


def time_grid(spans: DataFrame, keys: list[str], start: str, end: str, step: str, time: str = "t") -> DataFrame:
    """G1: (keys, time): the regular times from each row's start to its end, both included; a row without either has none."""
    return spans.select(*keys, F.explode(F.sequence(start, end, F.expr(f"interval {step}"))).alias(time))


def month_grid(df: DataFrame, day: str) -> DataFrame:
    """The first of each month between the first and the last day of df."""
    span = df.agg(F.trunc(F.min(day), "month").alias("a"), F.trunc(F.max(day), "month").alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))


def lonlat_grid(spark: SparkSession, x0: float, dx: float, nx: int, y0: float, dy: float, ny: int) -> DataFrame:
    """(cell, lon, lat), rows of the grid one after another."""
    n = spark.range(nx * ny)
    return n.select(F.col("id").alias("cell"), (F.lit(x0) + F.lit(dx) * (F.col("id") % nx)).alias("lon"), (F.lit(y0) + F.lit(dy) * F.floor(F.col("id") / nx)).alias("lat"))


def repeat_first_year(df: DataFrame, key: str, day: str, n: int) -> DataFrame:
    """Df with n copies of each key's first year before it; the 29th of February becomes the 28th in other years, which is there twice then."""
    first = df.groupBy(key).agg(F.min(F.year(day)).alias("__first"))
    copies = df.join(first, key).filter(F.year(day) == F.col("__first")).withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(n))))
    moved = copies.withColumn(day, F.add_months(day, -12 * F.col("__k"))).select(*df.columns)
    return moved.unionByName(df)


def normal_draw(*parts: Column | str) -> Column:
    """A standard normal number that depends on the parts alone: two uniform numbers of 52 bits of their md5 digest, by Box and Muller."""
    text = F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    uniform = lambda at: (F.conv(F.substr(F.md5(text), F.lit(at), F.lit(13)), 16, 10).cast("double") + 0.5) / 2**52
    return F.sqrt(-2 * F.log(uniform(1))) * F.cos(2 * F.pi() * uniform(17))


def synthetic_years(df: DataFrame, key: str, day: str, value: str, n: int, seed: int, low: float, high: float) -> DataFrame:
    """N drawn years before each key's first: mean and deviation of the same day of the year, normal, within bounds.

    Draws are those of a keyed digest of (seed, key, year, day), so that a row is the same wherever it is computed again.
    """
    step = F.dayofyear(day)
    climate = df.groupBy(key, step.alias("__doy")).agg(F.avg(value).alias("__mean"), F.coalesce(F.stddev_pop(value), F.lit(0.0)).alias("__sd"))
    first = df.groupBy(key).agg(F.min(F.year(day)).alias("__first"))
    years = climate.filter("__doy <= 365").join(first, key).withColumn("__year", F.explode(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.col("__first") - k)))
    drawn = clamp(F.col("__mean") + F.col("__sd") * normal_draw(F.lit(seed), key, "__year", "__doy"), low, high)
    made = years.select(key, F.date_add(F.make_date("__year", F.lit(1), F.lit(1)), F.col("__doy") - 1).alias(day), drawn.alias(value))
    return made.unionByName(df.select(key, day, value))
