"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.sources.staging import forget, new_path, written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Exact components of the links (a, b), both long: one row (node, component)
    per node of any link, component being the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al. 2014); each
    round is two aggregations by node with map-side combining and is written to
    the shared folder, so nothing but counts reaches the driver. Links with a
    null end or with a = b are dropped; repeated links are harmless.
    """
    spark = edges.sparkSession
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    path = new_path(spark, name)
    e = written(e, path=path)
    last = None
    while True:
        seen = e.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(u, v) as decimal(38, 0))"))).first()
        if seen == last or not seen[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        last = seen
        low = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        large = e.join(low, F.col("v") == F.col("node"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        to = new_path(spark, name)
        e = written(small, path=to)
        forget(spark, path)
        path = to
