"""Scans and sinks over files that are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.plans.registry import query
from gridspark.plans.views import table
from gridspark.sources import incremental, tables
from gridspark.sources.staging import new_path

DAYS = "CAST(date_diff('day', DATE '1850-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)"


@query("s1_read_variable", f"SELECT o_orderkey AS cell, {DAYS} AS time, {DAYS} AS time_lo, {DAYS} + 1 AS time_hi, o_totalprice AS value FROM orders")
def s1(spark, d):
    """A variable's table with names of its own, read under the standard ones."""
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1850-01-01").cast("date")).cast("double")
    own = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), days.alias("t"), days.alias("t_bnds_0"), (days + 1).alias("t_bnds_1"), F.col("o_totalprice").alias("value"))
    path = new_path(spark, "variable")
    own.write.parquet(path)
    return tables.read_variable(spark, path, names={"t": "time", "t_bnds_0": "time_lo", "t_bnds_1": "time_hi"})


def _by_year(spark: SparkSession, d: str, flag: str) -> tuple[list[str], DataFrame]:
    """One variable, a file a year: the files, and (file, n) of each."""
    path = new_path(spark, f"flag-{flag}")
    rows = table(spark, d, "lineitem").where(F.col("l_returnflag") == flag).withColumn("yr", F.year("l_shipdate"))
    rows.repartition("yr").write.partitionBy("yr").parquet(path)
    n = tables.with_lineage(spark.read.parquet(path)).groupBy("file").agg(F.count("*").alias("n"))
    return [r.file for r in n.select("file").collect()], n  # a file a year


YEARS = "SELECT l_returnflag AS flag, CAST(year(l_shipdate) AS VARCHAR) AS years, count(*) AS n FROM lineitem GROUP BY 1, 2"
PATTERN = r"yr=(\d{4})"


def _counted(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    return pairs.join(a.toDF("a", "n_a"), "a").join(b.toDF("b", "n_b"), "b")


@query("s3_paired_files", f"WITH y AS ({YEARS}) SELECT a.years, a.n AS n_a, b.n AS n_b FROM y a JOIN y b USING (years) WHERE a.flag = 'A' AND b.flag = 'R'")
def s3(spark, d):
    """Files of two variables by year; a year without a partner is an error."""
    (a, n_a), (b, n_b) = (_by_year(spark, d, f) for f in "AR")
    return _counted(tables.pair_files(spark, a, b, PATTERN), n_a, n_b).select("years", "n_a", "n_b")


@query("s4_collected_pairs", f"WITH y AS ({YEARS}), s AS (SELECT * FROM (VALUES ('past', 'A', 'R'), ('future', 'N', 'A')) t(scenario, f, g)) SELECT scenario, a.years, a.n AS n_a, b.n AS n_b FROM s JOIN y a ON a.flag = f JOIN y b ON b.flag = g AND b.years = a.years")
def s4(spark, d):
    """Of each scenario the years that both variables have."""
    (a, n_a), (r, n_r), (n, n_n) = (_by_year(spark, d, f) for f in "ARN")
    counts = n_a.union(n_r).union(n_n)
    pairs = tables.collect_pairs(spark, {"past": (a, r), "future": (n, a)}, PATTERN)
    return _counted(pairs, counts, counts).select("scenario", "years", "n_a", "n_b")


@query("s7_published_once", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s7(spark, d):
    """Published under a versioned path; what comes second changes nothing."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = incremental.published_path(new_path(spark, "published"), "price", "model", "past", "v1", 1992, 1998)
    if not incremental.publish(o, path) or incremental.publish(o.limit(0), path):
        raise ValueError("published twice")
    return spark.read.parquet(path)


@query("s8_selected_variables", "SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice FROM orders")
def s8(spark, d):
    path = new_path(spark, "selected")
    incremental.write_selected(table(spark, d, "orders"), path, ["o_totalprice"], ["o_orderkey"])
    return spark.read.parquet(path).select("o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@query("s9_delimited_text", "SELECT c_custkey AS id, CAST(c_nationkey AS INT) AS nation, c_acctbal AS balance FROM customer")
def s9(spark, d):
    """Columns parted by runs of spaces, a header on top of every file."""
    path = new_path(spark, "text")
    line = F.concat(F.lit(" "), F.concat_ws("   ", "c_custkey", "c_nationkey", "c_acctbal"))
    table(spark, d, "customer").select(line.alias("id   nation balance")).write.csv(path, sep="\x01", quote="", header=True)
    return tables.read_delimited(spark, path, "id long, nation int, balance double")


@query("s7_published_by_pointer", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s7_pointer(spark, d):
    """Published by a pointer that one writer alone can create."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = incremental.published_path(new_path(spark, "pointed"), "price", "model", "past", "v1", 1992, 1998)
    if not incremental.publish_version(o, path) or incremental.publish_version(o.limit(0), path):
        raise ValueError("published twice")
    return incremental.read_published(spark, path)
