"""Aggregations: periods, climatologies, inventories, profiles, coverage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.functions.scalars import basal_area, grass_leaf_area, leaf_area, midpoint
from terraflux.model import FAILING_FLAGS
from terraflux.operators import scan
from terraflux.operators.joins import small
from terraflux.sources.scratch import once

#: Aggregators by name; each takes a column and skips missing values.
AGGREGATORS = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "first": F.first,
    "count": F.count,
    "quadratic_mean": lambda c: F.sqrt(F.avg(c * c)),
}


def register_aggregator(name: str, factory: Callable[[Column], Column]) -> None:
    """Another aggregator by name: a function from a column to an aggregate expression."""
    AGGREGATORS[name] = factory


def missing_as_null(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name))


def aggregate_period(df: DataFrame, keys: list[str], time: str, period: str, aggs: dict[str, str]) -> DataFrame:
    """A1: a row per key and day or year, each variable by its own aggregator; NaN counts as missing."""
    at = F.to_date(time).alias("date") if period == "day" else F.year(time).alias("year")
    return df.groupBy(*keys, at).agg(*[AGGREGATORS[how](missing_as_null(c)).alias(c) for c, how in aggs.items()])


def aggregate_ratio(df: DataFrame, key: str, order: str, value: str, ratio: int, how: str = "mean", block: str | None = None) -> DataFrame:
    """A2: groups of ratio steps by position; the label is the first time, an incomplete last group is dropped, a NaN makes its group NaN.

    Positions are counted block by block (see operators.scan), so that no task holds a series.
    """
    placed = scan.counted(df, [key], order, "__i", block=block)
    grouped = placed.withColumn("__g", F.floor((F.col("__i") - 1) / ratio)).groupBy(key, "__g").agg(F.min(order).alias(order), F.count("*").alias("__n"), AGGREGATORS[how](F.col(value)).alias(value))
    return grouped.filter(F.col("__n") == ratio).drop("__g", "__n")


def aggregate_multi(df: DataFrame, keys: list[str], time: str, unit: str, outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """A3: several aggregates of the same inputs under new names: outputs maps a name to (input, aggregator)."""
    return df.groupBy(*keys, F.date_trunc(unit, time).cast("timestamp_ntz").alias(time)).agg(*[AGGREGATORS[how](F.col(c)).alias(n) for n, (c, how) in outputs.items()])


def resample_daily(df: DataFrame, key: str, time: str, value: str, how: str = "mean") -> DataFrame:
    """A4: a row for every day from a key's first to its last, with nulls for days without data."""
    days = df.groupBy(key).agg(F.explode(F.sequence(F.to_date(F.min(time)), F.to_date(F.max(time)))).alias("day"))
    daily = df.groupBy(key, F.to_date(time).alias("day")).agg(AGGREGATORS[how](F.col(value)).alias(value))
    return days.join(daily, [key, "day"], "left")


def temporal_mean(df: DataFrame, cell: str, value: str) -> DataFrame:
    """A5: the mean of all times per cell."""
    return df.groupBy(cell).agg(F.avg(value).alias(value))


def mean_of_annual(df: DataFrame, cell: str, time: str, value: str, how: str = "mean") -> DataFrame:
    """The mean over years of the annual mean (or sum), so that leap years weigh no more."""
    annual = df.groupBy(cell, F.year(time)).agg(AGGREGATORS[how](F.col(value)).alias(value))
    return annual.groupBy(cell).agg(F.avg(value).alias(value))


def monthly_climatology(df: DataFrame, time: str, value: str) -> DataFrame:
    """The mean of each calendar month over all cells and years."""
    return df.groupBy(F.month(time).alias("month")).agg(F.avg(value).alias(value))


def warmest_month_max(df: DataFrame, cell: str, time: str, value: str) -> DataFrame:
    """The highest of the twelve monthly means of daily maxima; a month without data counts as 0."""
    daily = df.groupBy(cell, F.to_date(time).alias("d")).agg(F.max(value).alias("x"))
    monthly = daily.groupBy(cell, F.month("d").alias("m")).agg(F.avg("x").alias("x"))
    top = F.max("x")
    return monthly.groupBy(cell).agg(F.when(F.count("*") < 12, F.greatest(top, F.lit(0.0))).otherwise(top).alias(value))


def annual_mean(df: DataFrame, time: str, value: str) -> DataFrame:
    """A10: the mean of each year."""
    return df.groupBy(F.year(time).alias("year")).agg(F.avg(value).alias(value))


#: Values of a group that a task may hold to find a percentile, and parts that a larger group's range is cut into.
MAX_GROUP, BINS = 1_000_000, 1024


def percentiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], max_group: int = MAX_GROUP) -> DataFrame:
    """(keys, a column for each of wanted): exact percentiles, interpolated between the two values around them; wanted
    maps a name to (column, share). Nulls and NaN do not count.

    Groups of up to max_group rows are aggregated as they are. Of larger ones, the range that holds the two values is
    found by counting in 1024 parts of it, again and again, for all groups at once; a task never holds a group.
    """
    key = F.struct(*[F.col(k) for k in keys])
    rows = df.select(key.alias("__key"), *dict.fromkeys(c for c, _ in wanted.values()))
    sizes = rows.groupBy("__key").agg(F.count("*").alias("__n"))
    large = once(sizes.filter(F.col("__n") > max_group).select("__key"), "large-groups")
    exact = lambda c, q: F.percentile(F.when(~F.isnan(c), F.col(c)), F.lit(q))
    if large.isEmpty():
        found = rows.groupBy("__key").agg(*[exact(c, q).alias(name) for name, (c, q) in wanted.items()])
        return found.select("__key.*", *wanted)
    on = lambda a, b: a["__key"].eqNullSafe(b["__key"])
    near = small(large)
    few = rows.join(near, on(rows, near), "left_anti").groupBy("__key").agg(*[exact(c, q).alias(name) for name, (c, q) in wanted.items()])
    many = large
    for name, (column, q) in wanted.items():
        values = rows.join(near, on(rows, near), "left_semi").select("__key", F.col(column).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
        one = _selected(values, q, max_group).withColumnRenamed("x", name).withColumnRenamed("__key", "__of")
        many = many.join(one, many["__key"].eqNullSafe(one["__of"]), "left").drop("__of")
    return few.unionByName(many).select("__key.*", *wanted)


def _selected(values: DataFrame, q: float, max_group: int) -> DataFrame:
    """(__key, x): the percentile of each group of values(__key, v), between the values at the places around it."""
    ends = values.groupBy("__key").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = (F.col("n").cast("double") - 1) * q
    ends = once(ends.select("*", place.alias("place")), "selection")
    # for each of the two values its place, from 0, among those from lo to hi: at first all of the group's
    sides = F.array(*[F.struct(F.lit(i).alias("side"), end("place").cast("long").alias("at")) for i, end in enumerate((F.floor, F.ceil))])
    state = ends.select("__key", "lo", "hi", "n", F.explode(sides).alias("s")).select("__key", "s.side", "lo", "hi", "n", "s.at")
    done = []
    while not state.isEmpty():  # a part never holds both ends of its range, so that ranges shrink
        found = (F.col("n") <= max_group) | (F.col("lo") == F.col("hi"))
        open_ = state.filter(~found)
        inside = values.join(small(state.withColumnRenamed("__key", "__of")), values["__key"].eqNullSafe(F.col("__of"))).filter("v >= lo AND v <= hi")
        last = inside.filter(found & (F.col("lo") < F.col("hi"))).groupBy("__key", "side", "at").agg(F.sort_array(F.collect_list("v")).alias("vs"))  # max_group of them at most
        done.append(once(last.select("__key", "side", F.element_at("vs", (F.col("at") + 1).cast("int")).alias("x")).union(state.filter("lo = hi").select("__key", "side", "lo")), "selected"))
        if open_.isEmpty():
            break
        part = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        counts = inside.filter(~found).groupBy("__key", "side", "at", part.alias("part")).agg(F.count("*").alias("here"), F.min("v").alias("low"), F.max("v").alias("high"))
        so_far = F.sum("here").over(Window.partitionBy("__key", "side").orderBy("part"))  # BINS rows at most
        kept = counts.withColumn("end", so_far).filter("end > at AND end - here <= at")
        state = once(kept.select("__key", "side", F.col("low").alias("lo"), F.col("high").alias("hi"), F.col("here").alias("n"), (F.col("at") - F.col("end") + F.col("here")).alias("at")), "selection")
    both = reduce(DataFrame.union, done).groupBy(F.col("__key").alias("__of")).agg(F.min(F.when(F.col("side") == 0, F.col("x"))).alias("x0"), F.min(F.when(F.col("side") == 1, F.col("x"))).alias("x1"))
    joined = ends.join(both, ends["__key"].eqNullSafe(both["__of"]))
    return joined.select("__key", (F.col("x0") + (F.col("x1") - F.col("x0")) * (F.col("place") - F.floor("place"))).alias("x"))


def plot_statistics(stems: DataFrame, area: str = "area_m2", max_group: int = MAX_GROUP) -> DataFrame:
    """A row per plot and visit: live and dead biomass (kg/m2, a sum of 0 is missing), mean and 90th-percentile height (m),
    quadratic mean and 90th-percentile diameter (m), basal area (m2/ha) and the visit's middle date.

    Of plot, start_visit and end_visit, a column with any null is no part of the key; the plot and the first dates of a
    group are given all the same. Without an end the date is the start, without a start the end; a table in which all
    three have nulls gives no rows. Percentiles are exact and interpolated, see percentiles(), which holds no large group.
    """
    keys = ("plot", "start_visit", "end_visit")
    holes = stems.agg(*[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"__no_{c}") for c in keys])  # one row
    stems = stems.join(F.broadcast(holes)).filter("NOT (__no_plot AND __no_start_visit AND __no_end_visit)")
    own = [F.when(~F.col(f"__no_{c}"), F.col(c)) for c in keys]
    ninetieth = [F.percentile(F.when(~F.isnan(c), F.col(c)), F.lit(0.9)).alias(name) for name, c in (("height_90", "height_m"), ("diameter_90", "diameter_cm"))]
    stems = stems.withColumns({f"__{c}": col for c, col in zip(keys, own)})
    by = [*[f"__{c}" for c in keys], *[f"__no_{c}" for c in keys[1:]]]
    split = not stems.groupBy(*by).count().filter(F.col("count") > max_group).isEmpty()  # a group that no task should hold
    groups = stems.groupBy(*by).agg(
        *[F.min(c).alias(c) for c in keys], F.min(area).alias("__area"), F.sum("live_kg").alias("live"), F.sum("dead_kg").alias("dead"), F.avg("height_m").alias("height"),
        AGGREGATORS["quadratic_mean"](F.col("diameter_cm")).alias("diameter"), F.sum(basal_area(F.col("diameter_cm"))).alias("basal"), *([] if split else ninetieth),
    )
    if split:
        tops = percentiles(stems, by, {"height_90": ("height_m", 0.9), "diameter_90": ("diameter_cm", 0.9)}, max_group).withColumnsRenamed({c: f"{c}_" for c in by})
        groups = groups.join(tops, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in by]), "left")
    per_area = lambda c: F.nullif(F.col(c) / F.col("__area"), F.lit(0.0)).alias(c)
    date = F.when(F.col("__no_end_visit"), F.col("start_visit")).when(F.col("__no_start_visit"), F.col("end_visit")).otherwise(midpoint(F.col("start_visit"), F.col("end_visit")))
    return groups.select(
        "plot", date.alias("date"), per_area("live"), per_area("dead"), "height", (F.col("diameter") / 100).alias("diameter"),
        "height_90", (F.col("diameter_90") / 100).alias("diameter_90"), (F.col("basal") * 10_000 / F.col("__area")).alias("basal"),
    )


def transect_biomass(stems: DataFrame, date: str, transect: str, area: str, values: list[str]) -> DataFrame:
    """Per date the sum of value / area over the number of transects; missing values count as 0."""
    return stems.groupBy(date).agg(*[(F.coalesce(F.sum(F.col(v) / F.col(area)), F.lit(0.0)) / F.count_distinct(transect)).alias(v) for v in values])


def mean_by_date(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The mean over replicates."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def depth_weighted(layers: DataFrame, cell: str, top: str, bottom: str, value: str) -> DataFrame:
    """The profile mean weighted by the thickness of layers; a layer without value has no weight."""
    thick = F.when(F.col(value).isNotNull(), F.col(bottom) - F.col(top))
    return layers.groupBy(cell).agg((F.sum(F.col(value) * thick) / F.sum(thick)).alias(value))


def coverage_counts(df: DataFrame, key: str, time: str, fails: Column) -> DataFrame:
    """Per key the rows, distinct days, rows with failing flag and rows per day."""
    counts = df.groupBy(key).agg(F.count("*").alias("rows"), F.count_distinct(F.to_date(time)).alias("days"), F.count_if(fails).alias("dropped"))
    return counts.withColumn("per_day", F.col("rows") / F.col("days"))


def failing_counts(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Per key and failing flag its rows and their share of all rows of the key, in percent."""
    counts = df.groupBy(key, F.col(flag).try_cast("int").alias(flag)).agg(F.count("*").alias("n"))
    totals = counts.groupBy(F.col(key).alias("__key")).agg(F.sum("n").alias("__all"))
    failing = counts.filter(F.col(flag).isin(*FAILING_FLAGS)).join(totals, F.col(key).eqNullSafe(F.col("__key")))
    return failing.select(key, flag, "n", (100.0 * F.col("n") / F.col("__all")).alias("percent"))


def gridpoints(df: DataFrame, keys: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Per key the size of its grid: distinct longitudes times distinct latitudes."""
    return df.groupBy(*keys).agg((F.count_distinct(lon) * F.count_distinct(lat)).alias("gridpoints"))


def coverage(df: DataFrame, key: str, time: str) -> DataFrame:
    """The first and last period of each key."""
    return df.groupBy(key).agg(F.min(time).alias("first"), F.max(time).alias("last"))


def modal_step(df: DataFrame, key: str, day: str, block: str | None = None) -> DataFrame:
    """The most frequent step in days, the smallest of equally frequent ones; null for a single time. Days are gone through block by block."""
    days = scan.shifted(df.select(key, day, *([block] if block else [])).distinct(), [key], day, {"__before": (day, -1)}, block)
    return days.withColumn("step", F.datediff(day, "__before")).groupBy(key).agg(F.mode("step", deterministic=True).alias("step"))


def step_climatology(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Mean and population deviation of each day of the year."""
    return df.groupBy(key, F.dayofyear(day).alias("step")).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))


def fill_from_other_years(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Missing values become the mean of the same day of other years."""
    climate = df.groupBy(key, F.dayofyear(day).alias("__doy")).agg(F.avg(value).alias("__mean"))
    out = df.withColumn("__doy", F.dayofyear(day)).join(climate, [key, "__doy"], "left")
    return out.withColumn(value, F.coalesce(value, "__mean")).drop("__doy", "__mean")


def lai_from_cover(df: DataFrame, key: list[str], wood: str, grass: str, forest: str) -> DataFrame:
    """Leaf area of woody and grass cover, each by its own formula, and their total by the share of forest."""
    out = df.select(*key, leaf_area(F.col(wood)).alias("lai_wood"), grass_leaf_area(F.col(grass)).alias("lai_grass"), F.least(F.col(forest), F.lit(1.0)).alias("__f"))
    return out.withColumn("lai", F.col("lai_wood") * F.col("__f") + F.col("lai_grass") * (1 - F.col("__f"))).drop("__f")


def axes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(axis, value, size): the distinct values of each coordinate and their number."""
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("value")) for c in columns])).alias("x")).select("x.axis", "x.value").distinct()
    return values.join(F.broadcast(values.groupBy("axis").agg(F.count("*").alias("size"))), "axis")  # a row per axis
