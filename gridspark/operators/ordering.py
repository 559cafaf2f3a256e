"""Dense global row numbers without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.sources.staging import written


def global_cumsum(df: DataFrame, order: Sequence[str], value: str | Sequence[str], out: str | Sequence[str] = "upto") -> DataFrame:
    """The sum of a column up to and with each row, in the order given: as
    global_rank, with sums in place of counts. Several columns may be summed at
    once. The order should be total."""
    values, outs = ([x] if isinstance(x, str) else list(x) for x in (value, out))
    w = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    rows = written(rows.select("*", *[F.sum(v).over(w).alias(f"__upto{k}") for k, v in enumerate(values)]), "cumsum")
    part = rows.groupBy("__part").agg(*[F.sum(v).alias(f"__n{k}") for k, v in enumerate(values)])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"__n{k}").over(earlier), F.lit(0)).alias(f"__before{k}") for k in range(len(values))]
    part = part.select("__part", *before)  # one row per partition
    sums = [(F.col(f"__before{k}") + F.col(f"__upto{k}")).alias(o) for k, o in enumerate(outs)]
    return rows.join(F.broadcast(part), "__part").select(*[F.col(c) for c in df.columns], *sums)


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank") -> DataFrame:
    """Rows numbered from 1 in the order given: a range sort, numbers within its
    partitions, and one count per partition added up. The order should be total."""
    w = Window.partitionBy("__part").orderBy(*order)
    rows = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    rows = rows.withColumn("__at", F.row_number().over(w))
    rows = written(rows, "rank")  # so that a retry can't number them anew
    part = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    part = part.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(part), "__part").withColumn(out, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")
