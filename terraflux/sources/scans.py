"""Scans: columnar series, delimited and fixed-width text, site lists, facts from file names, attribute tables, nested arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.functions.scalars import make_time

if TYPE_CHECKING:
    import pyarrow as pa


def scan_series(spark: SparkSession, path: str | list[str], variables: list[str]) -> DataFrame:
    """The named columns of one or many files; others are not read."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(*variables)


def scan_csv(spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", na_tokens: tuple[str, ...] = ("na",), date_format: str | None = None, encoding: str = "UTF-8", header: bool = True, fallback: str | None = None) -> DataFrame:
    """Delimited text with given columns; missing tokens count in any case, surrounding blanks do not.

    Columns are read as text, then cast: what does not parse is null. Dates and timestamps follow date_format. With a
    fallback, files that are not valid UTF-8 in all their lines are read in that encoding, the others in UTF-8.
    """
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)
    read = lambda paths, encoding: spark.read.csv(paths, schema=", ".join(f"`{f.name}` string" for f in wanted), sep=sep, header=header, encoding=encoding)
    if fallback is None:
        raw = read(path, encoding)
    else:
        files = encodings(spark, path, fallback).collect()  # a row per file
        paths = {e: [r["path"] for r in files if r["encoding"] == e] for e in ("UTF-8", fallback)}
        raw = reduce(DataFrame.union, [read(own, e) for e, own in paths.items() if own]) if files else read(path, encoding)

    def cast(name: str, kind: str) -> Column:
        text = F.trim(name)
        text = F.when(~F.lower(text).isin("", *na_tokens), text)
        if kind == "date":
            return F.to_date(F.try_to_timestamp(text, F.lit(date_format or "yyyy-MM-dd")))
        if kind.startswith("timestamp"):
            return F.try_to_timestamp(text, F.lit(date_format or "yyyy-MM-dd HH:mm:ss")).cast(kind)
        return text if kind == "string" else text.try_cast(kind)

    return raw.select(*[cast(f"`{f.name}`", f.dataType.simpleString()).alias(f.name) for f in wanted])


def encodings(spark: SparkSession, path: str | list[str], fallback: str) -> DataFrame:
    """S3: (path, encoding) of each text file with a line: UTF-8 if the bytes of all its lines are valid, else the fallback.

    Lines are read as they are, in splits like any text, so that no file is held whole.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.is_valid_utf8("value").alias("ok"))
    return lines.groupBy("path").agg(F.when(F.every("ok"), "UTF-8").otherwise(fallback).alias("encoding"))


def scan_fixed_width(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns separated by runs of blanks; lines whose first column does not parse (headers) are left out."""
    from pyspark.sql.types import StructType

    parts = F.split(F.trim("value"), r"\s+")
    fields = StructType.fromDDL(schema)
    out = spark.read.text(path).select(*[F.try_element_at(parts, F.lit(i + 1)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
    return out.filter(F.col(fields[0].name).isNotNull())


def scan_after_header(spark: SparkSession, path: str, row_pattern: str, columns: dict[str, tuple[int, str]]) -> DataFrame:
    """The data lines of a file with a preamble: those that match row_pattern; columns maps a name to (position from 1, type).

    Lines carry no order in a distributed read, so a data line is told by its own look, not by where the header ends.
    """
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.col("value").rlike(row_pattern)).select(*[F.try_element_at(parts, F.lit(i)).try_cast(kind).alias(name) for name, (i, kind) in columns.items()])


def scan_sites(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(lon, lat, site) lines: carriage returns, quotes and blanks in names are removed, empty lines and the header skipped.

    A coordinate out of range stops the job.
    """
    parts = F.split(F.regexp_replace("value", r"[\r\"']", ""), sep if len(sep) > 1 else f"[{sep}]")
    get = lambda i: F.trim(F.get(parts, F.lit(i)))
    rows = spark.read.text(path).filter(F.trim("value") != "").select(get(0).try_cast("double").alias("lon"), get(1).try_cast("double").alias("lat"), F.regexp_replace(get(2), " ", "").alias("site"))
    valid = F.col("lon").between(-180, 360) & F.col("lat").between(-90, 90)
    return rows.filter("lon IS NOT NULL AND lat IS NOT NULL").filter(F.when(valid, True).otherwise(F.raise_error(F.concat(F.lit("coordinates out of range: "), F.col("site"))).cast("boolean")))


#: Named parts of file names, the first group of each pattern: names such as tas_..._199501-199501.nc and Site_L6_2004.csv.
FILE_FACTS = {
    "variable": r"^([A-Za-z0-9]+)_",
    "start": r"_(\d{6})-\d{6}\.",
    "end": r"_\d{6}-(\d{6})\.",
}
SITE_FACT = r"^([A-Za-z]+)(?:_L\d|_\d{4})"


def scanned_name(level: int = 0) -> Column:
    """The name of the file that a row was read from, or of its folder so many levels up (of a key=name folder the name)."""
    part = F.element_at(F.split(F.url_decode("_metadata.file_path"), "/"), -1 - level)
    return F.regexp_replace(part, r"^[A-Za-z_]+=", "")


def date_of_name(name: Column) -> Column:
    """The date of a name with year and day of the year (2000057), or year, month and day (20000226); null if it has neither."""
    year_day, day = F.regexp_extract(name, r"(?:^|\D)(\d{7})(?:\D|$)", 1), F.regexp_extract(name, r"(?:^|\D)(\d{8})(?:\D|$)", 1)
    of_day = make_time(year=F.nullif(F.substr(year_day, F.lit(1), F.lit(4)), F.lit("")).cast("int"), doy=F.nullif(F.substr(year_day, F.lit(5), F.lit(3)), F.lit("")).cast("int"))
    return F.coalesce(of_day.cast("date"), F.to_date(F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("yyyyMMdd"))))


def with_file_facts(df: DataFrame, name: str | Column = "name", patterns: dict[str, str] | None = None) -> DataFrame:
    """Columns cut from a file name (or from _metadata.file_name), a first capture group each; null where it does not match."""
    col = F.col(name) if isinstance(name, str) else name
    return df.withColumns({n: F.nullif(F.regexp_extract(col, p, 1), F.lit("")) for n, p in (patterns or FILE_FACTS).items()})


def add_time_column(df: DataFrame, name: str, pattern: str, date_format: str) -> DataFrame:
    """A time column from the file name, for layers of a single time."""
    return df.withColumn("time", F.to_date(F.try_to_timestamp(F.regexp_extract(name, pattern, 1), F.lit(date_format))))


def file_metadata(attributes: DataFrame, file: str, name: str, value: str, names: list[str]) -> DataFrame:
    """A row per file with a column per attribute."""
    return attributes.groupBy(file).pivot(name, names).agg(F.min(value))


#: Files above so many bytes are not read into a row but in pieces.
STREAMED_ABOVE = 64 << 20
PIECE = 4 << 20


def file_digests(spark: SparkSession, path: str, streamed_above: int = STREAMED_ABOVE) -> DataFrame:
    """(path, sha256) of every file under a tree, of any length; files without bytes, which scans pass over, have no row.

    The listing alone deals files to tasks by their lengths, and the bound on the length reaches the scan: short files
    are read as rows, longer ones are named to the task, which reads them piece by piece.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    short = files.filter(F.col("length") <= streamed_above).select("path", F.sha2("content", 256).alias("sha256"))
    long = files.filter(F.col("length") > streamed_above).select("path")
    return short.union(long.mapInArrow(_streamed_digests, "path string, sha256 string"))


def _streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow as pa

    for batch in batches:
        paths = batch.column(0)
        yield pa.RecordBatch.from_arrays([paths, pa.array([sha256_of(p.as_py()) for p in paths], pa.string())], ["path", "sha256"])


def sha256_of(path: str) -> str:
    """The digest of one file, of which no more than a piece is in memory. Paths of other file systems go through pyarrow."""
    import hashlib
    from urllib.parse import quote

    if path.startswith("file:"):
        stream = open("/" + path.removeprefix("file:").lstrip("/"), "rb", buffering=0)
    else:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@%"))
        stream = system.open_input_stream(inner)
    digest = hashlib.sha256()
    with stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def packed_digests(spark: SparkSession, path: str, streamed_above: int = STREAMED_ABOVE) -> DataFrame:
    """S15 on files of write_packed_texts(): a row per text with its digest, null for a null text. The file's own digest must be the same on both reads."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    lines = F.split(F.expr("substring(string(content), 1, length(string(content)) - 1)"), "\x1e")  # without the last mark
    plain = lambda s: F.replace(F.replace(s, F.lit("\x1f1"), F.lit("\x1e")), F.lit("\x1f0"), F.lit("\x1f"))
    texts = F.transform(lines, lambda s: F.sha2(F.when(s != "\x1f2", plain(s)), 256))
    own = files.filter("length > 0").select("path", F.sha2("content", 256).alias("own"), texts.alias("texts"))
    seen = own.join(file_digests(spark, path, streamed_above), "path", "left")
    same = F.assert_true(F.coalesce(F.col("own") == F.col("sha256"), F.lit(False)), F.concat(F.lit("file changed while it was read: "), F.col("path")))
    return seen.filter(same.isNull()).select(F.explode("texts").alias("sha256"))


def wide_to_long(df: DataFrame, keys: list[str], names: list[str], name: str, value: str) -> DataFrame:
    """A row per named column."""
    return df.unpivot(keys, names, name, value)


def arrays_to_long(df: DataFrame, keys: list[str], axis: str, values: str, index: str, value: str) -> DataFrame:
    """A row per element of parallel arrays of axis values and data."""
    return df.select(*keys, F.posexplode(F.arrays_zip(axis, values)).alias(index, "x")).select(*keys, index, F.col(f"x.{axis}").alias("at"), F.col(f"x.{values}").alias(value))


def long_to_arrays(df: DataFrame, keys: list[str], axis: str, value: str, full: DataFrame) -> DataFrame:
    """A dense array per key over all values of the axis table full, missing ones null, in the axis' order.

    The axis travels as one row, which is no longer than each row of the result.
    """
    axis_values = full.agg(F.collect_set(axis).alias("__axis"))
    grid = df.select(*keys).distinct().join(F.broadcast(axis_values)).withColumn(axis, F.explode("__axis")).drop("__axis")
    dense = grid.join(df, [*keys, axis], "left")
    return dense.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(axis, value))).alias("x")).select(*keys, F.col("x").getField(axis).alias(axis), F.col("x").getField(value).alias(value))


def concat_runs(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Outputs of several runs as one table, told apart by phase."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("phase", F.lit(name)) for name, df in parts])
