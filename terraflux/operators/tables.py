"""Table forms of parsing and naming: plot areas, soil textures, variable lookup, layers, parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.functions.scalars import parse_lengths, to_metres

#: What parse_lengths() reads as a single length.
PLAIN_LENGTH = r"^[ \t]*-?([0-9]*\.?[0-9]+)[ \t]*(mm|km|au|cm|m)[ \t]*$"


def plot_area(df: DataFrame, plot: str, length: str, width: str) -> DataFrame:
    """area_m2 of the row's own length and width; a missing one is taken from its plot if that has one distinct value.

    Several distinct values where one is needed stop the job. (Both sides fall back on their own column.)
    """
    known = df.groupBy(plot).agg(*[F.struct(F.min(c).alias("v"), F.count_distinct(c).alias("n")).alias(f"__{c}") for c in (length, width)])
    out = df.join(known, plot, "left")

    def metres(c: str) -> Column:
        patch = F.when(F.col(f"__{c}.n") == 1, F.col(f"__{c}.v")).otherwise(F.raise_error(F.concat(F.lit(f"no single {c} of plot "), F.col(plot).cast("string"))).cast("string"))
        text = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(patch)
        plain = F.regexp_extract(text, PLAIN_LENGTH, 1)  # one length with its unit, as nearly all are
        return F.when(plain != "", to_metres(plain.cast("double"), F.regexp_extract(text, PLAIN_LENGTH, 2))).otherwise(F.get(parse_lengths(text), F.lit(0)))

    return out.withColumn("area_m2", metres(length) * metres(width)).drop(f"__{length}", f"__{width}")


def close_texture(df: DataFrame, sand: str, silt: str, clay: str, proportional: bool = True) -> DataFrame:
    """fractions that add up to 1: the residual to 100 percent shared by proportion, or put on silt (then in percent)."""
    total = F.col(sand) + F.col(silt) + F.col(clay)
    if not proportional:
        return df.withColumn(silt, F.col(silt) - (total - 100))
    return df.withColumns({c: (F.col(c) - F.col(c) / total * (total - 100)) / 100 for c in (sand, silt, clay)})


def stand_metrics(df: DataFrame, live: str, dead: list[str], diameter: str, basal_live: str, basal_dead: str) -> DataFrame:
    """biomass in kg/m2 of kg/ha, diameter in m of cm, total basal area; dead is the first of the columns that df has, else missing."""
    dead_col = next((F.col(c) for c in dead if c in df.columns), F.lit(None).cast("double"))
    return df.withColumns({"live_m2": F.col(live) / 10_000, "dead_m2": dead_col / 10_000, "diameter_m": F.col(diameter) / 100, "basal_total": F.col(basal_live) + F.col(basal_dead)})


def find_variable(attributes: DataFrame, file: str, std_name: str, long_name: str, units: str) -> DataFrame:
    """the variable of each file found by long name, else by units, else by standard name; the first by position of several."""
    rank = F.when(F.col("long_name") == long_name, 1).when(F.col("units") == units, 2).when(F.col("standard_name") == std_name, 3)
    place = F.row_number().over(Window.partitionBy(file).orderBy("__rank", "position"))
    return attributes.withColumn("__rank", rank).filter("__rank IS NOT NULL").withColumn("__place", place).filter("__place = 1").drop("__place", "__rank")


def explode_layers(sites: DataFrame, site: str, layers: str) -> DataFrame:
    """a row per soil layer of an array of (name, depth in cm), with the output column's name swvol_<depth>."""
    depth = F.regexp_replace(F.col("layer.depth").cast("string"), r"\.0+$", "")
    return sites.select(site, F.explode(layers).alias("layer")).select(site, F.col("layer.name").alias("name"), F.col("layer.depth").alias("depth"), F.concat(F.lit("swvol_"), depth).alias("column"))
