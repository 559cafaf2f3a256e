"""Tables written between the steps of a job, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only a session that runs in one process (``local[...]``) and names no such
    folder gets a temporary one; a cluster without it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local.setdefault("dir", tempfile.mkdtemp(prefix="gridspark-"))
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gridspark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, and a
    lost executor costs no recomputation."""
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str, name: str = "table") -> DataFrame:
    """Write df to the shared folder in buckets of a column, one file each, and
    read it again: joins on that column and aggregations by it and others then
    exchange nothing. As many buckets as the session has shuffle partitions, so
    that a table which lies so already is written without an exchange."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, name)
    table = "gridspark_" + path.rpartition("/")[2].replace("-", "_")
    df.repartition(n, by).write.bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table)
    return spark.table(table)


def clear(spark: SparkSession) -> None:
    """Delete all tables written so far under the session's shared folder: for
    between jobs, as results that are not yet computed may read them."""
    for t in spark.catalog.listTables():
        if t.name.startswith("gridspark_"):
            spark.sql(f"DROP TABLE {t.name}")
    forget(spark, f"{shared_dir(spark)}/gridspark")


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that no later plan reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
