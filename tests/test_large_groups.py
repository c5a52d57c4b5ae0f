"""A11's percentiles and S12's layout where one group or cell holds most rows."""

import pytest
from pyspark.sql import functions as F

from terraflux.operators import aggregates as agg
from terraflux.sources import sinks


@pytest.fixture(scope="module")
def rows(spark):
    """One group of 60,000, others of a few; a null key, nulls, NaN, ties, values of very different size."""
    x = F.xxhash64("id") % 100_000 / 7
    v = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 97 == 0, float("nan")).when(F.col("id") % 5 == 0, 3.0).when(F.col("id") % 1009 == 0, 1e12).otherwise(x)
    key = F.when(F.col("id") < 60_000, "hot").when(F.col("id") < 60_100, None).otherwise((F.col("id") % 50).cast("string"))
    return spark.range(62_000).select(key.alias("k"), (F.col("id") % 2).alias("j"), v.alias("v"), F.rint(x / 1000).alias("w")).repartition(6).cache()


@pytest.mark.parametrize("max_group, q", [(10**6, 0.9), (500, 0.9), (40, 0.5)])
def test_percentiles(rows, max_group, q):
    got = agg.percentiles(rows, ["k", "j"], {"a": ("v", q), "b": ("w", q)}, max_group)
    want = rows.groupBy("k", "j").agg(F.percentile(F.when(~F.isnan("v"), F.col("v")), F.lit(q)).alias("a"), F.percentile("w", F.lit(q)).alias("b"))
    have = {(r.k, r.j): (r.a, r.b) for r in got.collect()}
    assert have == {(r.k, r.j): (pytest.approx(r.a), pytest.approx(r.b)) for r in want.collect()}


def test_plot_statistics_of_a_large_group(spark):
    stems = spark.range(3000).select(
        F.when(F.col("id") < 2900, 1).otherwise(2).alias("plot"), F.lit("2001-01-01").cast("date").alias("start_visit"), F.lit("2001-01-05").cast("date").alias("end_visit"), F.lit(100.0).alias("area_m2"),
        (F.xxhash64("id") % 1000 / 10).alias("diameter_cm"), (F.col("id") % 37 / 2).alias("height_m"), F.lit(1.0).alias("live_kg"), F.lit(0.5).alias("dead_kg"),
    )
    names = agg.plot_statistics(stems).columns
    plain = lambda df: sorted(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in names) for r in df.collect())
    assert plain(agg.plot_statistics(stems, max_group=200)) == plain(agg.plot_statistics(stems))


def test_a_huge_cell_spans_files(spark, tmp_path):
    cells = spark.range(40_000).select(F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 200).alias("cell"), F.col("id").alias("t"), F.rand(1).alias("v")).repartition(7)
    sinks.write_cell_major(cells, str(tmp_path / "cells"), "cell", "t", partitions=12)
    layout = {r.cell: r for r in sinks.cell_layout(spark, str(tmp_path / "cells"), "cell", "t").collect()}
    assert sum(r.n for r in layout.values()) == 40_000 and all(r.together and r.ordered for r in layout.values())
    assert layout[0].n >= 32_000 and layout[0].files >= 8 and max(r.files for c, r in layout.items() if c) <= 2
