"""Scans: one variable's table, manifests of files, delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark.functions.convert import renamed
from gridspark.sources.incremental import exists


def read_variable(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None, names: dict[str, str] | None = None, bounds: tuple[str, str] | None = ("time_lo", "time_hi")) -> DataFrame:
    """One variable's table, columns renamed to the standard. A table that has
    time must have its bounds, and no row without them."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    df = renamed(df, names) if names else df
    if bounds and "time" in df.columns:
        missing = [b for b in bounds if b not in df.columns]
        if missing:
            raise ValueError(f"time has no bounds: {missing}")
        for b in bounds:
            df = df.withColumn(b, F.when(F.col(b).isNull(), F.raise_error(F.lit(f"{b} is null")).cast(df.schema[b].dataType)).otherwise(F.col(b)))
    return df


def with_lineage(df: DataFrame) -> DataFrame:
    """df and the file that each row is from."""
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def pair_files(spark: SparkSession, first: Sequence[str], second: Sequence[str], pattern: str = r"_(\d{4}-\d{4})\.") -> DataFrame:
    """Files of two variables by their year range; fails if one has no partner."""

    def manifest(paths: Sequence[str], name: str) -> DataFrame:
        df = spark.createDataFrame([(p,) for p in paths], f"{name} string")
        return df.withColumn("years", F.regexp_extract(name, pattern, 1))

    a, b = manifest(first, "a"), manifest(second, "b")
    alone = a.join(b, "years", "left_anti").select("years").union(b.join(a, "years", "left_anti").select("years"))
    left = [r.years for r in alone.orderBy("years").limit(20).collect()]
    if left:
        raise ValueError(f"years without a partner: {left}")
    return a.join(b, "years")


def collect_pairs(spark: SparkSession, scenarios: dict[str, tuple[Sequence[str], Sequence[str]]], pattern: str = r"_(\d{4}-\d{4})\.") -> DataFrame:
    """Of each scenario the year ranges for which both variables have a file;
    those with one alone are left out."""
    rows = [(name, which, p) for name, both in scenarios.items() for which, paths in zip("ab", both, strict=True) for p in paths]
    df = spark.createDataFrame(rows, "scenario string, which string, path string").withColumn("years", F.regexp_extract("path", pattern, 1))
    out = df.groupBy("scenario", "years").agg(*[F.min(F.when(F.col("which") == w, F.col("path"))).alias(w) for w in "ab"])
    return out.where("a is not null and b is not null")


def manifest(spark: SparkSession, files: Sequence[str], coord: str, path: str | None = None) -> DataFrame:
    """(file, low, high, n) of each file: the extent of a coordinate and the rows.
    Given a path it is written there, or read if it is there already, so that a
    later scan opens only the files that it needs."""
    if path is not None and exists(spark, path):
        return spark.read.parquet(path)
    rows = with_lineage(spark.read.parquet(*files).select(coord))
    out = rows.groupBy("file").agg(F.min(coord).alias("low"), F.max(coord).alias("high"), F.count("*").alias("n"))
    if path is None:
        return out
    out.write.parquet(path)
    return spark.read.parquet(path)


def check_extents(extents: DataFrame, step: float | None = None) -> None:
    """Fails, naming files, if two extents overlap, if one follows another by
    more than `step`, or if a file has none. One row per file is put in order."""
    none = [r.file for r in extents.where("low is null").orderBy("file").limit(20).collect()]
    if none:
        raise ValueError(f"files without the coordinate: {none}")
    order = Window.orderBy("low", "high", "file")  # a manifest's rows, as many as files
    top = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    pairs = extents.withColumns({"before": top, "after": F.lag("file").over(order)}).where("before is not null")
    for what, bad in (("overlap", F.col("low") <= F.col("before")), ("gap", F.lit(False) if step is None else F.col("low") - F.col("before") > step)):
        found = [(r.after, r.file) for r in pairs.where(bad).orderBy("low").limit(20).collect()]
        if found:
            raise ValueError(f"{what} between files: {found}")


def combine(spark: SparkSession, files: Sequence[str], coord: str, step: float | None = None, first: float | None = None, last: float | None = None, path: str | None = None) -> DataFrame:
    """Files that follow each other along a coordinate as one table, from `first`
    to `last`, both kept. Overlaps, and gaps wider than step, are errors. Files
    whose extent lies outside are not opened; of the rest the scan gets the
    coordinate's range as a filter."""
    extents = manifest(spark, files, coord, path)
    check_extents(extents, step)
    low, high = F.lit(True), F.lit(True)
    if first is not None:
        low = F.col("high") >= first
    if last is not None:
        high = F.col("low") <= last
    chosen = [r.file for r in extents.where(low & high).select("file").orderBy("low").collect()]  # names of files, as the caller gave them
    out = spark.read.parquet(*(chosen or list(files)[:1]))
    if not chosen:
        return out.limit(0)
    if first is not None:
        out = out.where(F.col(coord) >= first)
    return out if last is None else out.where(F.col(coord) <= last)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str | None = None) -> DataFrame:
    """Delimited text; the first line of each file is its header. Without sep,
    columns are parted by spaces."""
    if sep is not None:
        return spark.read.csv(path, schema=schema, sep=sep, header=True)
    # a file of one column, parted by what no line holds, so that only headers are cut off
    text = spark.read.csv(path, schema="value string", sep="\x01", quote="", escape="", header=True)
    lines = text.where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+").alias("c"))
    fields = StructType.fromDDL(schema).fields
    return lines.select(*[F.get("c", F.lit(k)).cast(f.dataType).alias(f.name) for k, f in enumerate(fields)])
