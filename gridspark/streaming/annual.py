"""Monthly files as a stream: rows appended once, years closed when whole."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.operators.timeagg import annual_mean
from gridspark.sources.incremental import append_new


def _months(spark: SparkSession, source: str, schema: str, on: Sequence[str], files: int | None) -> DataFrame:
    """New files' rows, each of the columns `on` once: what has come is kept in
    the state store, not looked up in a target."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(source).dropDuplicates(list(on))


def batch_folder(target: str) -> Callable[[DataFrame, int], None]:
    """A sink with a folder per batch id: a batch that runs again after a failure
    replaces what it wrote, and nothing is read."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return each


def append_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, on: Sequence[str], files: int | None = None) -> StreamingQuery:
    """Append each new file's rows unless a row with the same `on`, which tell one
    row from another, has come before. State: one key per row."""
    out = _months(spark, source, schema, on, files).writeStream.foreachBatch(batch_folder(target))
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def annual_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: Sequence[str], value: str, weight: str, year: str, month: str, files: int | None = None) -> StreamingQuery:
    """Annual means (keys, year, mean) of years whose 12 months have come, in
    whatever order and files; each is written once, in the batch that brings the
    last month. A month that comes again is passed over. Missing values count as
    0, as in annual_mean(). State: the sums of each (keys, year) and one key per
    month; nothing is read back from the target."""
    months = _months(spark, source, schema, [*keys, year, month], files)
    w = F.col(weight).cast("double")
    sums = months.groupBy(*keys, year).agg(F.sum(F.coalesce(F.col(value), F.lit(0.0)) * w).alias("v"), F.sum(w).alias("w"), F.count("*").alias("n"))
    write = batch_folder(target)

    def each(batch: DataFrame, number: int) -> None:
        write(batch.where("n = 12").select(*keys, year, (F.col("v") / F.col("w")).alias("mean")), number)

    out = sums.writeStream.outputMode("update").foreachBatch(each)  # groups that this batch changed
    return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def close_years(months: DataFrame, target: str, keys: Sequence[str], value: str, weight: str, year: str, month: str) -> None:
    """Append the annual means of years that have all 12 months and are not in
    the target yet."""
    whole = annual_mean(months, keys, value, weight, year, month).where("n_months = 12")
    append_new(whole, target, [*keys, year])
