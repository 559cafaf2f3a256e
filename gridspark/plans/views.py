"""Gridded views over the driver's tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly means by supplier and flag; months with a deep discount are missing."""
    d = table(spark, sf_dir, "lineitem")
    keys = [
        F.col("l_suppkey").alias("cell"), F.col("l_returnflag").alias("flag"), F.year("l_shipdate").alias("yr"),
        F.month("l_shipdate").alias("mon"), F.dayofmonth(F.last_day("l_shipdate")).alias("dim"),
    ]
    return d.groupBy(*keys).agg(F.when(F.max("l_discount") <= 0.09, F.avg("l_quantity")).alias("v"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth columns of up to seven levels, ten apart; deep discounts are missing."""
    d = table(spark, sf_dir, "lineitem")
    rows = d.groupBy(F.col("l_orderkey").alias("cell"), F.col("l_linenumber").alias("k"))
    rows = rows.agg(F.when(F.max("l_discount") <= 0.07, F.sum("l_quantity")).alias("v"))
    return rows.select("cell", "k", (F.col("k") * -10.0).alias("z"), "v")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid 40 wide with a zone, an ice mask and a field with holes."""
    d = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return d.select(
        (key % 40).cast("int").alias("i"), F.floor(key / 40).cast("int").alias("j"), (F.col("c_nationkey") % 16).alias("zone"),
        F.col("c_nationkey").alias("nation"), F.when(F.col("c_mktsegment") == "MACHINERY", 1.0).otherwise(0.0).alias("ice_frac"),
        F.col("c_acctbal").alias("v"), F.when(key % 7 != 0, F.col("c_acctbal")).alias("v_holes"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "nation")
    return d.groupBy((F.col("n_nationkey") % 16).alias("zone")).agg(F.min("n_name").alias("name"))


def label_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of ten by ten labels; -1 where the field is negative."""
    block = F.floor(F.col("i") / 10).cast("int") + 4 * F.floor(F.col("j") / 10).cast("int")
    return cells(spark, sf_dir).select("i", "j", F.when(F.col("v") < 0, -1).otherwise(block).alias("label"))


def ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "part")
    return d.select(F.col("p_size").alias("p1"), (1 + F.col("p_partkey") % 5).cast("int").alias("p2"), (F.col("p_partkey") % 16).cast("int").alias("zone"), F.col("p_retailprice").alias("melt_rate"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of a salinity and a temperature per cell, with a volume; the
    later state is missing where the field has holes."""
    c = cells(spark, sf_dir)
    s = F.col("v") % 35
    return c.select(
        "i", "j", "zone", F.round(s, 2).alias("s"), F.round(F.col("v") / 500, 2).alias("t"),
        (F.col("i") + 1).cast("double").alias("volume"), F.when(F.col("v_holes").isNotNull(), F.round(F.col("v") / 100, 2)).alias("delta"),
    )


SQL = {
    "series": """series AS (SELECT l_suppkey AS cell, l_returnflag AS flag, CAST(year(l_shipdate) AS INT) AS yr, CAST(month(l_shipdate) AS INT) AS mon,
  CAST(day(last_day(l_shipdate)) AS INT) AS dim, CASE WHEN max(l_discount) <= 0.09 THEN avg(l_quantity) END AS v FROM lineitem GROUP BY 1, 2, 3, 4, 5)""",
    "profiles": """profiles AS (SELECT l_orderkey AS cell, l_linenumber AS k, l_linenumber * CAST(-10 AS DOUBLE) AS z,
  CASE WHEN max(l_discount) <= 0.07 THEN sum(l_quantity) END AS v FROM lineitem GROUP BY 1, 2, 3)""",
    "cells": """cells AS (SELECT CAST(c_custkey % 40 AS INT) AS i, CAST(c_custkey // 40 AS INT) AS j, c_nationkey % 16 AS zone, c_nationkey AS nation,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS ice_frac, c_acctbal AS v, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS v_holes FROM customer)""",
    "zones": "zones AS (SELECT n_nationkey % 16 AS zone, min(n_name) AS name FROM nation GROUP BY 1)",
    "label_grid": """label_grid AS (SELECT CAST(c_custkey % 40 AS INT) AS i, CAST(c_custkey // 40 AS INT) AS j,
  CASE WHEN c_acctbal < 0 THEN -1 ELSE CAST((c_custkey % 40) // 10 + 4 * ((c_custkey // 40) // 10) AS INT) END AS label FROM customer)""",
    "ensemble": "ensemble AS (SELECT p_size AS p1, CAST(1 + p_partkey % 5 AS INT) AS p2, CAST(p_partkey % 16 AS INT) AS zone, p_retailprice AS melt_rate FROM part)",
    "states": """states AS (SELECT CAST(c_custkey % 40 AS INT) AS i, CAST(c_custkey // 40 AS INT) AS j, c_nationkey % 16 AS zone, round(c_acctbal % 35, 2) AS s,
  round(c_acctbal / 500, 2) AS t, CAST(c_custkey % 40 + 1 AS DOUBLE) AS volume, CASE WHEN c_custkey % 7 <> 0 THEN round(c_acctbal / 100, 2) END AS delta FROM customer)""",
}


def sql(views: str, body: str) -> str:
    """WITH the named views, then the body (which may go on with more of them)."""
    return "WITH RECURSIVE " + ",\n".join(SQL[v] for v in views.split()) + "\n" + body
