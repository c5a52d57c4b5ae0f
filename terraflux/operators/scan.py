"""What a window over a whole series tells, without a task that holds a series: a scan on two levels.

A block column splits each series into consecutive runs. Each run's count and its first and last rows are found by an
aggregate; a window over these few rows carries them on from run to run; joined back, they complete what a window within
the run leaves open. Rows are shuffled once, by series and run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of a numeric order that make a block, where none is given.
BLOCK = 8192


def block_of(df: DataFrame, order: str) -> Column:
    """The default block of a row: the month of a time, BLOCK values of a number; one for a whole series of anything else."""
    kind = df.schema[order].dataType.simpleString()
    if kind.startswith(("date", "timestamp")):
        return F.year(order) * 12 + F.month(order)
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.floor(F.col(order) / BLOCK)
    return F.lit(0)


def _blocked(df: DataFrame, order: str, block: str | None) -> DataFrame:
    return df.withColumn("__block", F.col(block) if block else block_of(df, order))


def _joined(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """rows with what carried(keys, __block, ..) has for their run; null is a key like any other."""
    on = [*keys, "__block"]
    carried = carried.withColumnsRenamed({k: f"__on{i}" for i, k in enumerate(on)})
    same = reduce(Column.__and__, [F.col(f"`{k}`").eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(on)])
    return rows.join(carried, same).drop(*[f"__on{i}" for i in range(len(on))])


def shifted(df: DataFrame, keys: list[str], order: str, wanted: dict[str, tuple[str, int]], block: str | None = None) -> DataFrame:
    """df with a column for each of wanted, which maps its name to (column, -1 or 1): that column of the row before or
    after in its series, null at the end. Rows of equal order stand by the wanted columns."""
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    rows = _blocked(df, order, block)
    row = F.struct(F.col(order).alias("__o"), *[F.col(c).alias(f"__{c}") for c in columns])
    over = Window.partitionBy(*keys).orderBy("__block")  # a row per block
    ends = rows.groupBy(*keys, "__block").agg(F.min(row).alias("a"), F.max(row).alias("b"))
    carried = ends.select(*keys, "__block", F.lag("b").over(over).alias("__scan_before"), F.lead("a").over(over).alias("__scan_after"))
    within = Window.partitionBy(*keys, "__block").orderBy(order, *columns)
    out = _joined(rows, carried, keys)
    for name, (column, by) in wanted.items():
        side = F.lag if by < 0 else F.lead
        out = out.withColumn(name, F.when(side(F.lit(1)).over(within).isNull(), F.col("__scan_before" if by < 0 else "__scan_after")[f"__{column}"]).otherwise(side(column).over(within)))
    return out.drop("__block", "__scan_before", "__scan_after")


def counted(df: DataFrame, keys: list[str], order: str, out: str, what: Column | None = None, block: str | None = None) -> DataFrame:
    """df with out, the number of the series' rows so far, this one counted too; with what, of those where it is not null."""
    what = F.lit(1) if what is None else what
    rows = _blocked(df, order, block).withColumn("__what", what)
    over = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*keys, "__block").agg(F.count("__what").alias("n")).select(*keys, "__block", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("__n"))
    within = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return _joined(rows, carried, keys).withColumn(out, F.col("__n") + F.count("__what").over(within)).drop("__block", "__what", "__n")
