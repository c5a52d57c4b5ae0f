"""Window operators: gaps, steps, boundaries, bounds, validation. Series are gone through block by block, see operators.scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.functions.scalars import align_time
from terraflux.operators import scan


def _position(order: Column | str) -> Column:
    return F.col(order) if isinstance(order, str) else order


def interpolate_gaps(df: DataFrame, key: str, order: str, value: str, block: str | None = None, empty: str = "error") -> DataFrame:
    """Nulls become linear interpolations of the finite values around them, at the ends the nearest finite value.

    order is numeric. A NaN is no support and stays NaN. A series with nulls and without any finite value stops the job,
    or stays as it is if empty is "keep". With block, a column that splits each series into consecutive runs, no task
    holds more than a run: each run's first and last finite values are found first and handed to its neighbours.
    """
    known = F.when(F.col(value).isNotNull() & ~F.isnan(value), F.struct(F.col(order).cast("double").alias("x"), F.col(value).alias("y")))
    df = df.withColumn("__k", known)
    keys = [key] + ([block] if block else [])
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.last("__k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("__k", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    if block:
        ends = df.groupBy(*keys).agg(F.min_by("__k", order).alias("__any"), F.min(F.when(F.col("__k").isNotNull(), F.struct(order, "__k"))).alias("__a"), F.max(F.when(F.col("__k").isNotNull(), F.struct(order, "__k"))).alias("__b"))
        over = Window.partitionBy(key).orderBy(block)  # a row per block
        ends = ends.select(*keys, F.last("__b.__k", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__prev"), F.first("__a.__k", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("__next"))
        df = df.join(ends, keys)
        before, after = F.coalesce(before, "__prev"), F.coalesce(after, "__next")
    df = df.withColumn("__p", before).withColumn("__n", after)
    slope = (F.col("__n.y") - F.col("__p.y")) / F.nullif(F.col("__n.x") - F.col("__p.x"), F.lit(0.0))
    line = F.col("__p.y") + slope * (F.col(order) - F.col("__p.x"))
    none = [] if empty == "keep" else [F.raise_error(F.concat(F.lit("no valid value to interpolate from in series "), F.col(key).cast("string"))).cast("double")]
    return df.withColumn(value, F.coalesce(value, line, "__p.y", "__n.y", *none)).drop("__k", "__p", "__n", "__prev", "__next")


def fill_time_gaps(df: DataFrame, key: str, time: str, value: str, seconds: int) -> DataFrame:
    """The full regular range of each series, missing steps interpolated day by day; repeated equal rows count once.

    A time with different values, or with a value and a null, stops the job; conflicts() lists such times.
    """
    agree = (F.count(value) == 0) | ((F.count(value) == F.count("*")) & (F.min(value) == F.max(value)))
    refused = F.raise_error(F.concat(F.lit("different values at one time of series "), F.col(key).cast("string"))).cast("double")
    once = df.groupBy(key, time).agg(F.min(value).alias(value), agree.alias("__same")).select(key, time, F.when(F.col("__same"), F.col(value)).otherwise(refused).alias(value))
    span = df.groupBy(key).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    grid = span.select(key, F.explode(F.sequence("a", "b", F.expr(f"interval {seconds} seconds"))).alias(time))
    full = grid.join(once, [key, time], "left").withColumn("__i", F.unix_timestamp(F.col(time).cast("timestamp"))).withColumn("__day", F.to_date(time))
    return interpolate_gaps(full, key, "__i", value, "__day").drop("__i", "__day")


def conflicts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n")).filter("n > 1")


def monthly_to_daily(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Daily values on the line between months' first days; after the last one its value to the end of that month."""
    span = df.groupBy(key).agg(F.min(month).alias("a"), F.last_day(F.max(month)).alias("b"))
    days = span.select(key, F.explode(F.sequence("a", "b")).alias("day"))
    full = days.join(df.select(key, F.col(month).alias("day"), value), [key, "day"], "left").withColumn("__i", F.datediff("day", F.lit("1970-01-01").cast("date")))
    return interpolate_gaps(full.withColumn("__year", F.year("day")), key, "__i", value, "__year").drop("__i", "__year")


def neighbour_mean(df: DataFrame, key: str, index: str, value: str, n: int, reach: int | None = None, block: str | None = None) -> DataFrame:
    """Missing values become the mean of the n nearest valid ones of the series; of two equally near the later comes first.

    With fewer than n valid values they stay missing; with reach, also where n of them are not within reach positions.
    Only the n valid values before and the n after can be the nearest. Valid values are numbered block by block; each
    place between two of them gets its 2 n neighbours, and missing rows join the place that they stand in.
    """
    ranked = scan.counted(df, [key], index, "__r", F.col(value), block)
    valid, missing = ranked.filter(F.col(value).isNotNull()), ranked.filter(F.col(value).isNull())
    places = valid.select(F.col(key).alias("__key"), F.struct(F.col(index).alias("i"), F.col(value).alias("v")).alias("s"), F.explode(F.sequence(F.greatest(F.col("__r") - n, F.lit(0)), F.col("__r") + (n - 1))).alias("__at"))
    near = places.groupBy("__key", "__at").agg(F.collect_list("s").alias("__near"))  # 2 n of them at most
    found = missing.join(near, missing[key].eqNullSafe(near["__key"]) & (F.col("__r") == F.col("__at")), "left")
    within = F.col("__near") if reach is None else F.filter("__near", lambda s: F.abs(s["i"] - F.col(index)) <= reach)
    best = F.array_sort(F.transform(within, lambda s: F.struct(F.abs(s["i"] - F.col(index)).alias("d"), (-s["i"]).alias("o"), s["v"].alias("v"))))
    mean = F.when(F.size(best) >= n, F.aggregate(F.slice(best, 1, n), F.lit(0.0), lambda a, s: a + s["v"]) / n)
    return valid.select(*df.columns).union(found.withColumn(value, mean.cast(df.schema[value].dataType)).select(*df.columns))


def step_seconds(df: DataFrame, key: str, day: str, block: str | None = None) -> DataFrame:
    """Seconds to the next row; the last row takes the one before, a lone row 0. Rows are gone through block by block."""
    out = scan.shifted(df, [key], day, {"__next": (day, 1), "__last": (day, -1)}, block)
    seconds = lambda a, b: (F.datediff(b, a) * 86400).cast("double")
    return out.withColumn("step", F.coalesce(seconds(day, "__next"), seconds("__last", day), F.lit(0.0))).drop("__next", "__last")


def inspect_time(df: DataFrame, key: str, time: str, block: str | None = None) -> DataFrame:
    """Per series its step, whether it is uniform, positive and divides a day, and the steps missing at both year ends.

    Times are gone through block by block.
    """
    seconds = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    steps = scan.shifted(df.select(key, time, *([block] if block else [])), [key], time, {"__before": (time, -1)}, block).withColumn("d", seconds(time) - seconds("__before"))
    return _inspection(steps.groupBy(key).agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n"), F.min("d").alias("step"), F.max("d").alias("__max")), key)


def inspect_grid(df: DataFrame, key: str, time: str, seconds: int) -> DataFrame:
    """W6 of series with gaps and a known step, by aggregates alone: n counts the steps from first to last, and a series is
    uniform if all its times are whole steps from the first."""
    at = F.unix_timestamp(F.col(time).cast("timestamp"))
    on_grid = F.count_distinct(F.pmod(at, F.lit(seconds))) == 1
    out = df.groupBy(key).agg(
        F.min(time).alias("first"), F.max(time).alias("last"), (F.floor((F.max(at) - F.min(at)) / seconds) + 1).alias("n"),
        F.lit(seconds).cast("bigint").alias("step"), F.when(on_grid, F.lit(seconds)).otherwise(-1).cast("bigint").alias("__max"),
    )
    return _inspection(out, key)


def _inspection(out: DataFrame, key: str) -> DataFrame:
    """(key, first, last, n, step, __max) with what inspect_time() says of them."""
    ends = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    year = lambda c, plus: F.unix_timestamp(F.make_timestamp(F.year(c) + plus, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    ok = F.col("step") > 0
    return out.select(
        key, "first", "last", "n", "step", (F.col("step") == F.col("__max")).alias("uniform"), ok.alias("positive"), (ok & (F.pmod(F.lit(86400), F.col("step")) == 0)).alias("divides_day"),
        F.when(ok, F.floor((ends("first") - year("first", 0)) / F.col("step"))).alias("missing_start"),
        F.when(ok, F.ceil((year("last", 1) - ends("last")) / F.col("step")) - 1).alias("missing_end"),
    )


def _refusal(key: str, start: str, end: str, max_pad: int) -> Column:
    """Of an inspect_time() row: why its series cannot be given whole years, null if it can."""
    name = F.concat(F.lit(" in series "), F.col(key).cast("string"))
    return (
        F.when(F.col("n") < 2, F.concat(F.lit("a single step"), name)).when(~F.col("positive"), F.concat(F.lit("a repeated time"), name))
        .when(~F.col("divides_day"), F.concat(F.lit("a step that does not divide a day"), name)).when(~F.col("uniform"), F.concat(F.lit("uneven steps"), name))
        .when(F.lit(start == "error") & (F.col("missing_start") > 0), F.concat(F.lit("missing steps at the start"), name))
        .when(F.lit(start == "pad") & (F.col("missing_start") > max_pad), F.concat(F.lit("more missing steps at the start than may be added"), name))
        .when(F.lit(end == "error") & (F.col("missing_end") > 0), F.concat(F.lit("missing steps at the end"), name))
    )


def time_plan(df: DataFrame, key: str, time: str, minutes: int, start: str = "pad", end: str = "ignore", max_pad: int = 1, block: str | None = None) -> DataFrame:
    """Per series how to come to whole years and to output steps of some minutes: first, last, step, n0 and n1 steps to
    add, y0 and y1 years to drop, ratio of input steps in an output step, and begin, the first time of the output.

    start and end are "ignore", "trim", "pad" (at the start up to max_pad steps) or "error". A series with a single step,
    repeated times, uneven steps, a step that does not divide a day or the output step, or a boundary that its mode
    refuses, stops the job; an empty table is an error at once.
    """
    if df.isEmpty():
        raise ValueError("no time steps")
    return plan_of(inspect_time(df, key, time, block), key, minutes, start, end, max_pad)


def plan_of(plan: DataFrame, key: str, minutes: int, start: str = "pad", end: str = "ignore", max_pad: int = 1) -> DataFrame:
    """time_plan() of what inspect_time() or inspect_grid() tells."""
    ratio = F.lit(minutes * 60) / F.col("step")
    refused = F.coalesce(_refusal(key, start, end, max_pad), F.when(ratio != F.floor(ratio), F.concat(F.lit("an output step that is no multiple of the input step in series "), F.col(key).cast("string"))))
    plan = plan.withColumn("ratio", F.when(refused.isNull(), F.floor(ratio)).otherwise(F.raise_error(refused).cast("bigint")))
    cut0, cut1 = F.lit(start == "trim") & (F.col("missing_start") > 0), F.lit(end == "trim") & (F.col("missing_end") > 0)
    n0, n1 = F.when(F.lit(start == "pad"), F.col("missing_start")).otherwise(0), F.when(F.lit(end == "pad"), F.col("missing_end")).otherwise(0)
    shift = lambda steps: F.col("first") + F.make_dt_interval(secs=(steps * F.col("step")).cast("decimal(18,6)"))
    next_year = F.make_timestamp_ntz(F.year("first") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    whole = F.ceil(F.timestamp_diff("SECOND", F.col("first").cast("timestamp_ntz"), next_year) / F.col("step"))
    return plan.select(
        key, "first", "last", "step", "ratio", n0.cast("int").alias("n0"), n1.cast("int").alias("n1"), F.when(cut0, F.year("first")).alias("y0"), F.when(cut1, F.year("last")).alias("y1"),
        F.when(cut0, shift(whole)).otherwise(shift(-n0)).alias("begin"),
    )


def apply_plan(df: DataFrame, plan: DataFrame, key: str, time: str, pads: dict[str, tuple[str, float]]) -> DataFrame:
    """The rows that a time_plan() keeps and those that it adds; pads maps a column to how its added values are drawn
    ("nearest", or "constant" and the constant). Other columns are left out."""
    on = plan.select(F.col(key).alias("__key"), "y0", "y1", "n0", "n1", "step", F.col("first").alias("__first"), F.col("last").alias("__last"))
    rows = df.join(on, F.col(key) == F.col("__key"))
    kept = rows.filter((F.col("y0").isNull() | (F.year(time) > F.col("y0"))) & (F.col("y1").isNull() | (F.year(time) < F.col("y1"))))

    def steps(edge: str, n: str, sign: int) -> Column:
        here = (F.col(time) == F.col(edge)) & (F.col(n) > 0)
        return F.when(here, F.transform(F.sequence(F.lit(1), F.greatest(F.col(n), F.lit(1))), lambda k: k * sign)).otherwise(F.array().cast("array<int>"))

    at = F.explode(F.concat(steps("__first", "n0", -1), steps("__last", "n1", 1)))
    added = rows.withColumn("__k", at)
    drawn = [(F.lit(float(pads[c][1])) if pads[c][0] == "constant" else F.col(c)).alias(c) for c in pads]
    added = added.select(key, (F.col(time) + F.make_dt_interval(secs=(F.col("__k") * F.col("step")).cast("decimal(18,6)"))).alias(time), *drawn)
    return kept.select(key, time, *pads).union(added)


def align_series(df: DataFrame, key: str, time: str, mode: str, minutes: int) -> DataFrame:
    """F8: times of a series of steps of some minutes moved to the nearest half hour ("half_hour") or hour ("strict_hour"), or left ("none").

    Any other mode, and strict_hour with steps below an hour, is an error. A series whose moved times repeat or are
    not evenly spaced any more stops the job.
    """
    quantum = {"none": None, "half_hour": 30, "strict_hour": 60}
    if mode not in quantum:
        raise ValueError(f"no such alignment: {mode!r}")
    if mode == "strict_hour" and minutes < 60:
        raise ValueError("alignment to the hour needs steps of an hour or more")
    if mode != "none":
        df = df.withColumn(time, align_time(F.col(time), quantum[mode]).cast(df.schema[time].dataType))
    seconds = F.unix_timestamp(F.col(time).cast("timestamp"))
    check = df.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("n"), F.count_distinct(time).alias("m"), (F.max(seconds) - F.min(seconds)).alias("span"), F.count_distinct(F.pmod(seconds, F.lit(minutes * 60))).alias("phases"))
    name = F.concat(F.lit(" in series "), F.col("__key").cast("string"))
    # as many distinct times, on one phase, as the span has steps: evenly spaced
    refused = F.when(F.col("n") != F.col("m"), F.concat(F.lit("alignment repeats times"), name)).when((F.col("phases") > 1) | (F.col("span") != (F.col("n") - 1) * minutes * 60), F.concat(F.lit("alignment makes uneven steps"), name))
    check = check.select("__key", F.when(refused.isNull(), True).otherwise(F.raise_error(refused).cast("boolean")).alias("__ok"))
    return df.join(check, F.col(key) == F.col("__key")).filter("__ok").drop("__key", "__ok")


def apply_boundary(df: DataFrame, key: str, time: str, value: str, start: str = "ignore", end: str = "ignore", max_pad: int = 1, pad: str = "nearest", constant: float = 0.0, block: str | None = None) -> DataFrame:
    """Whole years at either end: "ignore", "trim" (drop the incomplete year), "pad" (add up to max_pad steps) or "error".

    pad and constant are those of pad_series(). A series that needs more padding than max_pad, any incomplete one with
    "error", and one with a single, repeated or uneven step or one that does not divide a day, stops the job.
    """
    plan = inspect_time(df, key, time, block)
    refused = F.coalesce(_refusal(key, start, end, max_pad), F.when(F.lit(end == "pad") & (F.col("missing_end") > max_pad), F.concat(F.lit("more missing steps at the end than may be added in series "), F.col(key).cast("string"))))
    plan = plan.withColumn("__ok", F.when(refused.isNull(), "").otherwise(F.raise_error(refused).cast("string")))
    n0 = F.when(F.lit(start == "pad"), F.col("missing_start")).otherwise(0)
    n1 = F.when(F.lit(end == "pad"), F.col("missing_end")).otherwise(0)
    cut0 = F.lit(start == "trim") & (F.col("missing_start") > 0)
    cut1 = F.lit(end == "trim") & (F.col("missing_end") > 0)
    plan = plan.select(key, "__ok", n0.cast("int").alias("__n0"), n1.cast("int").alias("__n1"), "step", F.when(cut0, F.year("first")).alias("__y0"), F.when(cut1, F.year("last")).alias("__y1"))
    kept = df.join(plan, key).filter("__ok = ''").filter((F.col("__y0").isNull() | (F.year(time) > F.col("__y0"))) & (F.col("__y1").isNull() | (F.year(time) < F.col("__y1"))))
    if "pad" not in (start, end):
        return kept.select(*df.columns)
    return _padded(kept.select(key, time, value, "__n0", "__n1", "step"), key, time, value, pad, constant).select(key, time, value)


def _padded(df: DataFrame, key: str, time: str, value: str, how: str, constant: float) -> DataFrame:
    """df with __n0 steps before and __n1 after each series; every row carries both counts and the step."""
    pairs = lambda pick: pick(F.struct(time, value))
    ends = df.groupBy(key, "__n0", "__n1", "step").agg(pairs(F.min).alias("a"), pairs(F.max).alias("b"))
    if how == "extrapolate":  # the second and the last but one are the outer ones of what lies between
        inner = df.join(ends.select(F.col(key).alias("__key"), F.col(f"a.{time}").alias("__a"), F.col(f"b.{time}").alias("__b")), F.col(key).eqNullSafe(F.col("__key")))
        later, earlier = F.when(F.col(time) > F.col("__a"), F.struct(time, value)), F.when(F.col(time) < F.col("__b"), F.struct(time, value))
        second = inner.groupBy("__key").agg(F.min(later)[value].alias("a2"), F.max(earlier)[value].alias("b2"))
        ends = ends.join(second, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    else:
        ends = ends.withColumns({"a2": F.lit(None).cast("double"), "b2": F.lit(None).cast("double")})

    def side(n: str, edge: str, other: str, sign: int) -> DataFrame:
        rows = ends.filter(F.col(n) > 0).withColumn("k", F.explode(F.sequence(F.lit(1), F.col(n))))
        at = F.col(f"{edge}.{time}") + F.make_dt_interval(secs=(F.col("k") * F.col("step") * sign).cast("decimal(18,6)"))
        y = F.col(f"{edge}.{value}")
        drawn = {"nearest": y, "constant": F.lit(float(constant)), "extrapolate": y + (y - F.coalesce(other, y)) * F.col("k")}[how]
        return rows.select(key, at.alias(time), drawn.alias(value))

    return df.select(key, time, value).union(side("__n0", "a", "a2", -1)).union(side("__n1", "b", "b2", 1))


def pad_series(df: DataFrame, key: str, time: str, value: str, how: str, n0: int, n1: int, step: int, constant: float = 0.0) -> DataFrame:
    """n0 steps before and n1 after each series: "nearest" value, a "constant", or the line through the last two ("extrapolate")."""
    return _padded(df.select(key, time, value, F.lit(n0).alias("__n0"), F.lit(n1).alias("__n1"), F.lit(step).alias("step")), key, time, value, how, constant)


def slice_series(df: DataFrame, key: str, index: str, value: str, i0: int, i1: int, mode: str) -> DataFrame:
    """Positions i0 to i1: "truncate" to those that exist, "pad" with missing values, or "mirror" at the ends (-1 is 1, n is n - 2)."""
    if mode == "truncate":
        return df.filter(F.col(index).between(i0, i1)).select(key, index, value)
    grid = df.groupBy(key).agg(F.max(index).alias("__last")).withColumn("__at", F.explode(F.sequence(F.lit(i0), F.lit(i1))))
    source = F.col("__at")
    if mode == "mirror":
        source = F.when(source < 0, -source).when(source > F.col("__last"), 2 * F.col("__last") - source).otherwise(source)
    return grid.withColumn(index, source.cast("int")).join(df.select(key, F.col(index).cast("int").alias(index), value), [key, index], "left").select(key, F.col("__at").alias(index), value)


def axis_bounds(axis: DataFrame, value: str, order: str | None = None, midpoint: bool = False) -> DataFrame:
    """(value, low, high) of an axis in the order of a column, by default of its values; steps over the date line wrap.

    Bounds lie half the step to the next value either side, and the last step is repeated. With midpoint they lie halfway
    to both neighbours, so that a cell begins where the one before it ends (a bound may be beyond 180); the outer ones
    lie as far out. An axis that crosses the date line needs an order of its own. A single value has no bounds.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(order or value)  # the distinct values of one coordinate
    step = F.lead(value).over(w) - F.col(value)
    step = F.when(step > 180, step - 360).when(step < -180, step + 360).otherwise(step)
    out = axis.withColumn("__d", step).withColumn("__e", F.lag("__d").over(w)).withColumn("__before", F.lag(value).over(w))
    up, down = F.coalesce("__d", "__e") / 2, F.coalesce("__e", "__d") / 2
    low = F.coalesce(F.col("__before") + down, F.col(value) - up) if midpoint else F.col(value) - up
    return out.select(value, low.alias("low"), (F.col(value) + up).alias("high"))


def cell_corners(grid: DataFrame, row: str, column: str, lon: str, lat: str) -> DataFrame:
    """The four corners of each cell, counter-clockwise from the lower left; steps to the next column and row, the last repeated."""
    across, up = Window.partitionBy(row).orderBy(column), Window.partitionBy(column).orderBy(row)
    dx = F.lead(lon).over(across) - F.col(lon)
    dx = F.when(dx > 180, dx - 360).when(dx < -180, dx + 360).otherwise(dx)
    out = grid.withColumn("dx", dx).withColumn("dy", F.lead(lat).over(up) - F.col(lat))
    out = out.withColumn("dx", F.coalesce("dx", F.lag("dx").over(across)) / 2).withColumn("dy", F.coalesce("dy", F.lag("dy").over(up)) / 2)
    corner = lambda c, d, signs: F.array(*[F.col(c) + s * F.col(d) for s in signs])
    return out.select(row, column, corner(lon, "dx", (-1, 1, 1, -1)).alias("lons"), corner(lat, "dy", (-1, -1, 1, 1)).alias("lats"))


def layer_thickness(layers: DataFrame, site: str, order: str, top: str, depth: float = 1.5) -> DataFrame:
    """The next layer's top minus the own one; the last layer reaches down to depth. Layers in inverted order stop the job."""
    w = Window.partitionBy(site).orderBy(order)
    thick = F.coalesce(F.lead(top).over(w), F.lit(depth)) - F.col(top)
    out = layers.withColumn("thickness", thick)
    return out.withColumn("thickness", F.when(F.col("thickness") >= 0, F.col("thickness")).otherwise(F.raise_error(F.concat(F.lit("inverted layers at "), F.col(site).cast("string"))).cast("double")))


def validate_sequence(catalog: DataFrame, key: str, start: str, end: str, block: str | None = None) -> DataFrame:
    """Files in order with whether each begins after the one before ends. Files are gone through block by block."""
    out = scan.shifted(catalog, [key], start, {"__end": (end, -1)}, block)
    return out.withColumn("ok", F.coalesce(F.col(start) > F.col("__end"), F.lit(True)) & (F.col(start) <= F.col(end))).drop("__end")


def full_years_only(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of the years whose first and last day a series has between its ends."""
    span = df.groupBy(key).agg(F.min(day).alias("__a"), F.max(day).alias("__b"))
    first, last = F.make_date(F.year(day), F.lit(1), F.lit(1)), F.make_date(F.year(day), F.lit(12), F.lit(31))
    return df.join(span, key).filter((F.col("__a") <= first) & (F.col("__b") >= last)).drop("__a", "__b")


def complete_days(df: DataFrame, key: str, time: str, value: str, seconds: int) -> DataFrame:
    """The last step is repeated, each a step later, until its day is complete."""
    last = df.groupBy(key).agg(F.max(F.struct(time, value)).alias("b"))
    clock = F.unix_timestamp(F.col(f"b.{time}").cast("timestamp"))
    n = F.floor((86400 - F.pmod(clock, F.lit(86400))) / seconds).cast("int") - 1
    more = last.withColumn("__n", n).filter("__n > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    more = more.select(key, (F.col(f"b.{time}") + F.make_dt_interval(secs=(F.col("k") * seconds).cast("decimal(18,6)"))).alias(time), F.col(f"b.{value}").alias(value))
    return df.select(key, time, value).union(more)


def dedupe_sources(df: DataFrame, site: str, source: str, allowed: tuple[str, ...]) -> DataFrame:
    """The rows of each site's first source; sites in allowed keep all."""
    first = df.groupBy(site).agg(F.min(source).alias("__first"))
    return df.join(first, site).filter((F.col(source) == F.col("__first")) | F.col(site).isin(*allowed)).drop("__first")


def spline_weights(month_starts: list[float], at: list[float]) -> list[tuple[int, int, float]]:
    """(knot, step, weight) of a not-a-knot cubic spline: its values are sums of weight times the knots' values."""
    import numpy as np

    x = np.asarray(month_starts, float)
    n = len(x)
    h = np.diff(x)
    left, right = np.zeros((n, n)), np.zeros((n, n))
    for i in range(1, n - 1):
        left[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        right[i, i - 1 : i + 2] = 6 / h[i - 1], -6 / h[i - 1] - 6 / h[i], 6 / h[i]
    left[0, :3] = h[1], -(h[0] + h[1]), h[0]
    left[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    second = np.linalg.solve(left, right)  # second derivatives at the knots, a row of weights each
    out = []
    for s, t in enumerate(at):
        i = min(max(int(np.searchsorted(x, t, "right")) - 1, 0), n - 2)
        a, b = (x[i + 1] - t) / h[i], (t - x[i]) / h[i]
        row = ((a**3 - a) * second[i] + (b**3 - b) * second[i + 1]) * h[i] ** 2 / 6
        row[i] += a
        row[i + 1] += b
        out += [(k, s, float(w)) for k, w in enumerate(row) if abs(w) > 1e-15]
    return out


def monthly_weights(leap: bool = False, step_days: float = 1) -> list[tuple[int, int, float]]:
    """(knot, step, weight) of a year of steps from mid-January; knots are the middles of the months from October to the March after next."""
    days = [31, 30, 31, 31, 29 if leap else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31, 31, 29 if leap else 28, 31]
    middles = [sum(days[: i + 1]) - 15.5 for i in range(18)]
    return spline_weights(middles, [middles[3] + step_days * i for i in range(round((middles[15] - middles[3]) / step_days))])


def is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def on_spline(time: Column) -> tuple[Column, Column]:
    """Year and step, in days, of spline_monthly() for a date: until 15 January those of the year before."""
    own = F.make_date(F.year(time), F.lit(1), F.lit(16))
    year = F.year(time) - F.when(time < own, 1).otherwise(0)
    return year, F.datediff(time, F.make_date(year, F.lit(1), F.lit(16)))


def spline_monthly(df: DataFrame, key: str, year: str, month: str, value: str, leap: bool | None = None, step_days: float = 1, low: float = 0.01, high: float = 12.0) -> DataFrame:
    """Daily values of monthly ones by a cubic spline through the months' middles, per year with its own last and first three months
    around it, within low and high. (key, year, step, value): steps of step_days (1 / 48: half-hours) from noon of 16 January to that
    of the next year, 366 days where the year is a leap year (or all, or none, as leap says)."""
    rows = [(flag, *row) for flag in (False, True) for row in monthly_weights(flag, step_days)]  # at most 18 rows a step
    weights = df.sparkSession.createDataFrame(rows, "__leap boolean, knot int, step int, w double")
    of_year = F.lit(leap) if leap is not None else is_leap(F.col(year))
    knots = df.withColumn("__leap", of_year).withColumn("knot", F.explode(F.filter(F.array(F.col(month) + 2, F.col(month) - 10, F.col(month) + 14), lambda k: k.between(0, 17))))
    return knots.join(F.broadcast(weights), ["__leap", "knot"]).groupBy(key, year, "step").agg(F.least(F.greatest(F.sum(F.col("w") * F.col(value)), F.lit(low)), F.lit(high)).alias(value))
