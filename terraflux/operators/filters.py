"""Projections, filters and predicates: table in, table out, no shuffle unless said."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import scalars
from terraflux.operators.sets import first_k


def select_variables(df: DataFrame, mapping: dict[str, str], keep_only: bool = True) -> DataFrame:
    """Columns renamed by mapping; others are dropped if keep_only. A name that df lacks is left out."""
    known = {a: b for a, b in mapping.items() if a in df.columns}
    return df.select(*[F.col(a).alias(b) for a, b in known.items()]) if keep_only else df.withColumnsRenamed(known)


def with_constants(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Constant columns; one that exists is an error."""
    if clash := sorted(set(constants) & set(df.columns)):
        raise ValueError(f"columns exist already: {clash}")
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def bbox(df: DataFrame, lon0: float, lon1: float, lat0: float, lat1: float) -> DataFrame:
    """Rows within a box, borders included."""
    return df.filter(F.col("lon").between(lon0, lon1) & F.col("lat").between(lat0, lat1))


def select_years(df: DataFrame, time: str, start: int, end: int, validate: bool = False) -> DataFrame:
    """Rows of the years start to end. validate looks up the table's coverage first and refuses years outside it."""
    if validate:
        low, high = df.agg(F.year(F.min(time)), F.year(F.max(time))).first()
        if low is None or start < low or end > high:
            raise ValueError(f"years {start}-{end} exceed the coverage {low}-{high}")
    return df.filter(F.year(time).between(start, end))


def scale_in_years(df: DataFrame, time: str, value: str, factor: float, start: int, end: int) -> DataFrame:
    """P5: value times factor in the years start to end, unchanged elsewhere."""
    return df.withColumn(value, F.when(F.year(time).between(start, end), F.col(value) * factor).otherwise(F.col(value)))


def clip_to_coverage(df: DataFrame, reference: DataFrame, time: str) -> DataFrame:
    """Rows within the first and last time of reference."""
    span = reference.agg(F.min(time).alias("__first"), F.max(time).alias("__last"))  # one row
    return df.join(F.broadcast(span), F.col(time).between(F.col("__first"), F.col("__last")), "left_semi")


def is_valid(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))


def valid_only(df: DataFrame, columns: list[str], how: str = "all") -> DataFrame:
    """Rows where all (or any) of the columns are neither null nor NaN."""
    return df.filter(reduce(Column.__and__ if how == "all" else Column.__or__, map(is_valid, columns)))


def flag_fails(flag: Column) -> Column:
    """Whether a quality flag is a known failing one; unknown, non-numeric and null flags pass."""
    return F.coalesce(flag.try_cast("int").isin(*model.FAILING_FLAGS), F.lit(False))


def qc_mask(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Value becomes null where its flag fails; the row stays."""
    return df.withColumn(value, F.when(~flag_fails(F.col(flag)), F.col(value)))


def qc_drop(df: DataFrame, flag: str) -> DataFrame:
    """Rows without failing flag."""
    return df.filter(~flag_fails(F.col(flag)))


def bitflag_filter(df: DataFrame, flag: str, bits: tuple[int, ...] = (2, 3, 6, 7)) -> DataFrame:
    """P10: rows whose packed flag has none of the bits set; a null flag is dropped."""
    return df.filter(F.col(flag).bitwiseAND(sum(1 << b for b in bits)) == 0)


def range_guard(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows within bounds, borders included."""
    return df.filter(F.col(value).between(low, high))


def bounds_report(df: DataFrame, key: str, order: list[str], value: str, low: float, high: float, k: int = 20) -> DataFrame:
    """Per key and direction, how many values are out of bounds, and the first k of them as "order=value" pairs in order."""
    side = F.when(F.isnan(value), None).when(F.col(value) < low, "below").when(F.col(value) > high, "above")
    out = df.withColumn("direction", side).filter("direction IS NOT NULL")
    shown = F.format_string("%s=%.2f", F.col(order[-1]).cast("string"), F.col(value))
    return first_k(out.withColumn("__shown", shown), [key, "direction"], [*order, "__shown"], k, "first").withColumn("first", F.replace("first", F.lit(","), F.lit(";")))


def convert_units(df: DataFrame, value: str, source: str, target: str, step: Column | float = 1.0) -> DataFrame:
    """Value in other units."""
    return df.withColumn(value, scalars.convert(F.col(value), source, target, step))


def unpack(df: DataFrame, value: str, scale: float, offset: float = 0.0, fills: tuple = ()) -> DataFrame:
    """Fill values become null, then scale and offset."""
    return df.withColumn(value, F.when(~F.coalesce(F.col(value).isin(*fills), F.lit(False)), F.col(value) * scale + offset))


def override_values(df: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns replaced where updates has a value for the key. updates must have each key once."""
    new = updates.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(new, keys, "left")
    return out.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*[f"__{c}" for c in columns])


def clamp(df: DataFrame, value: str, low: float | None, high: float | None) -> DataFrame:
    """Value within bounds; NaN and null stay."""
    return df.withColumn(value, scalars.clamp(F.col(value), low, high))


def with_expressions(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Columns computed by SQL expressions, in order; a later one may use an earlier one."""
    for name, text in expressions.items():
        df = df.withColumn(name, F.expr(text))
    return df
