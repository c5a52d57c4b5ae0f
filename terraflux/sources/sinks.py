"""Sinks: long tables, metric tables, cell-major Parquet, text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraflux.operators.filters import is_valid


def long_frame(df: DataFrame, values: list[str], decimals: int) -> DataFrame:
    """What write_long() writes: rows with every value valid, coordinates rounded."""
    return df.filter(reduce(Column.__and__, map(is_valid, values))).withColumns({c: F.round(c, decimals) for c in ("lon", "lat") if c in df.columns})


def with_year_day(df: DataFrame, time: str) -> DataFrame:
    """df with columns year and day (of the year, from 1) where its time column was."""
    parts = [F.year(time).alias("year"), F.dayofyear(time).alias("day")]
    return df.select(*[c for name in df.columns for c in (parts if name == time else [F.col(f"`{name}`")])])


def write_long(df: DataFrame, path: str, values: list[str], sep: str = ",", compression: str = "gzip", decimals: int = 2, year_day: str | None = None) -> None:
    """Delimited text of the valid rows; the time column named by year_day is written as year and day of the year."""
    rows = long_frame(df, values, decimals)
    (with_year_day(rows, year_day) if year_day else rows).write.csv(path, sep=sep, header=True, compression=compression)


def metric_frame(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Keys and metrics of the rows that have any of the metrics."""
    return df.select(*keys, *metrics).dropna(how="all", subset=metrics)


def write_metric_tables(df: DataFrame, keys: list[str], tables: dict[str, list[str]], path: str) -> None:
    """A sorted table per entry of tables."""
    for name, metrics in tables.items():
        metric_frame(df, keys, metrics).orderBy(*keys).write.csv(f"{path}/{name}", header=True)


def write_cell_major(df: DataFrame, path: str, cell: str, time: str, partitions: int | None = None) -> None:
    """Each cell's rows together and in time order, so that a reader of one cell touches few row groups.

    Tasks are cut by cell and time, so that a cell with very many rows fills several files, one after another in time,
    and no task has more than its share; see cell_layout().
    """
    dealt = df.repartitionByRange(partitions, cell, time) if partitions else df.repartitionByRange(cell, time)
    dealt.sortWithinPartitions(cell, time).write.parquet(path, compression="zstd")


def cell_layout(spark: SparkSession, path: str, cell: str, time: str) -> DataFrame:
    """(cell, n, files, together, ordered): in how many files a cell's rows lie, whether they are one run in each, and
    whether the files follow one another in time. Read from the rows' places in their files."""
    rows = spark.read.parquet(path).select(cell, time, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    own = rows.groupBy(cell, "file").agg(F.count("*").alias("n"), (F.max("at") - F.min("at") + 1).alias("span"), F.min(time).alias("a"), F.max(time).alias("b"))
    before = F.lag("b").over(Window.partitionBy(cell).orderBy("a", "b"))  # a row per file
    own = own.withColumn("ordered", F.coalesce(F.col("a") >= before, F.lit(True)))
    return own.groupBy(cell).agg(F.sum("n").alias("n"), F.count("*").alias("files"), F.every(F.col("n") == F.col("span")).alias("together"), F.every("ordered").alias("ordered"))


def annual_text(df: DataFrame, year: str, value: str) -> DataFrame:
    """Lines "%d %.2f"."""
    return df.select(F.format_string("%d %.2f", F.col(year), F.col(value)).alias("value"))


def write_annual_text(df: DataFrame, year: str, value: str, path: str) -> None:
    annual_text(df, year, value).write.text(path)


def write_packed_texts(df: DataFrame, text: str, path: str, per_file: int = 100) -> None:
    """Files of up to per_file texts, each ended by 1E; a 1E of the text is 1F "1", its 1F is 1F "0", a null text is 1F "2"."""
    marked = F.replace(F.replace(text, F.lit("\x1f"), F.lit("\x1f0")), F.lit("\x1e"), F.lit("\x1f1"))
    df.select(F.coalesce(marked, F.lit("\x1f2")).alias("text")).write.option("maxRecordsPerFile", per_file).text(path, lineSep="\x1e")
