"""Resumable appends of arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraflux.functions import calendars, scalars


def append_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str) -> DataFrame:
    """Every Parquet file under source goes to target once; a later call takes what has arrived since.

    The checkpoint holds which files are done, so a run that dies is taken up where it stopped. Returns the target.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of the target, None before its first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def _by_case(cases: list, test: Callable, then: Callable[..., Column]) -> Column:
    """then(case) of the case that a row has."""
    out = F.lit(None)
    for case in cases:
        out = F.when(test(case), then(case)).otherwise(out)
    return out


class InOrder:
    """Appends files that follow one another in time; see append_in_order().

    The target has a folder per batch for its rows and one for its ledger, (key, file, first, last, units ..) of each
    file and series, which is written last: rows without a ledger are not there yet. A batch that runs again, because the
    stream died before it was committed, overwrites both.
    """

    def __init__(self, target: str, key: str, time: str, units: dict[str, str], time_units: str | None, calendar: str | None) -> None:
        self.target, self.key, self.time, self.units, self.time_units, self.calendar = target, key, time, units, time_units, calendar
        self.said = [c for c in (*units.values(), time_units, calendar) if c]

    def ledger(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        found = _read(spark, f"{self.target}/ledger")
        return found if found is None or before is None else found.filter(F.col("batch") < before)

    def first_units(self, rows: DataFrame, ledger: DataFrame | None) -> dict[str, str | None]:
        """What the first file says of its units and calendar: of the whole target, or of this batch if it is the first."""
        if not self.said:
            return {}
        first = ledger.orderBy("batch", "first", "file").select(*self.said).first() if ledger is not None else None
        if first is None:  # numbers of different units have no order: the file of the least name is the first
            first = rows.orderBy("__file").select(*self.said).first()
        return first.asDict() if first else {}

    def converted(self, rows: DataFrame, first: dict[str, str | None]) -> DataFrame:
        """Values and numeric times in the units of the first file."""
        out = rows
        for value, unit in self.units.items():
            seen = [r[0] for r in rows.select(unit).distinct().collect()]  # the few units of a batch
            out = out.withColumn(value, _by_case([u for u in seen if u is not None], lambda u, unit=unit: F.col(unit) == u, lambda u, value=value, unit=unit: scalars.convert(F.col(value), u, first[unit])))
        if self.time_units:
            names = [self.time_units, *([self.calendar] if self.calendar else [])]
            seen = rows.select(*names).distinct().dropna().collect()
            of = lambda r: r[self.calendar] if self.calendar else "standard"
            to = first[self.time_units], first[self.calendar] if self.calendar else "standard"
            same = lambda r: F.lit(True) if not self.calendar else F.col(self.calendar) == r[self.calendar]
            moved = _by_case(seen, lambda r: (F.col(self.time_units) == r[self.time_units]) & same(r), lambda r: calendars.rebase(F.col(self.time), r[self.time_units], of(r), *to, strict=True))
            out = out.withColumn(self.time, moved)
        return out

    def check(self, files: DataFrame, ledger: DataFrame | None) -> None:
        """Each file begins, in each of its series, after all before it end."""
        if ledger is not None:
            last = ledger.groupBy(F.col(self.key).alias("__key")).agg(F.max("last").alias("__last"))
            files = files.join(last, F.col(self.key).eqNullSafe(F.col("__key")), "left")
        else:
            files = files.withColumn("__last", F.lit(None))
        # of equal beginnings one is late; a row per file and series
        order = Window.partitionBy(self.key).orderBy("first", "last", "file")
        before = F.greatest(F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)), "__last")
        late = files.withColumn("__before", before).filter("first <= __before").orderBy("first", "file").first()
        if late:
            raise ValueError(f"files are not in order: {late['file']} begins at {late['first']} in series {late[self.key]}, which is not after {late['__before']}")

    def __call__(self, batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark, ledger = batch.sparkSession, self.ledger(batch.sparkSession, number)
        rows = self.converted(batch, self.first_units(batch, ledger))
        files = rows.groupBy(self.key, F.col("__file").alias("file"), *self.said).agg(F.min(self.time).alias("first"), F.max(self.time).alias("last"))
        self.check(files, ledger)
        rows.drop("__file", *self.said).write.mode("overwrite").parquet(f"{self.target}/rows/batch={number}")
        self.written(number)
        files.write.mode("overwrite").parquet(f"{self.target}/ledger/batch={number}")

    def written(self, number: int) -> None:
        """Called between a batch's rows and its ledger; tests let the job die here."""

    def rows(self, spark: SparkSession) -> DataFrame | None:
        ledger = self.ledger(spark)
        if ledger is None:
            return None
        return spark.read.parquet(f"{self.target}/rows").join(F.broadcast(ledger.select("batch").distinct()), "batch", "left_semi").drop("batch")


def append_in_order(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: str, time: str, *, units: dict[str, str] | None = None, time_units: str | None = None, calendar: str | None = None, job: type[InOrder] = InOrder
) -> DataFrame:
    """Every Parquet file under source goes to target once, in the order of time, in the units of the first file.

    units maps a value's column to the one that names its units; time_units and calendar name the columns that say what
    numeric times count ("days since 1850-01-01") and in which calendar. A file that begins, in one of its series, before
    those already there or earlier in its batch end stops the stream, and nothing of its batch is kept. A run that dies
    is taken up where it stopped, without a row twice. Returns the target's rows, without the columns of units; null
    units give null values. The first call on no file at all is an error.
    """
    append = job(target, key, time, units or {}, time_units, calendar)
    stream = spark.readStream.schema(schema).parquet(source).withColumn("__file", F.col("_metadata.file_path"))
    query = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = append.rows(spark)
    if rows is None:
        raise ValueError(f"no file has arrived in {source}")
    return rows
