"""What the operators of this subpackage share: lineage cuts, ASCII text rules and table reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.sources.scratch import scratch

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here, a lost executor costs nothing above it.

    Parquet rather than checkpoint(): compressed, and the planner sees the true size of what follows. Results read from
    these files; clear_scratch() deletes them once the results are written.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z only. lower() does the same, faster, for text that is all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
