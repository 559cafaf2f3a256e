"""Idempotent append by time, splitting into files, versioned publishing."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.sources.staging import forget


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_new(df: DataFrame, path: str, on: Sequence[str]) -> None:
    """Append the rows whose time (columns `on`) the table at path has not yet:
    a batch that comes again adds nothing."""
    spark = df.sparkSession
    if exists(spark, path):
        df = df.join(spark.read.parquet(path).select(*on).distinct(), list(on), "left_anti")
    df.write.mode("append").parquet(path)


def split_blocks(df: DataFrame, path: str, block: str) -> None:
    """One folder per block, so that a reader prunes by block."""
    df.repartition(block).write.partitionBy(block).parquet(path)


def published_path(root: str, variable: str, model: str, scenario: str, version: str, first: int, last: int) -> str:
    return f"{root}/{model}/{scenario}/{variable}/{version}/{variable}_{model}_{scenario}_{version}_{first}-{last}"


def publish(df: DataFrame, path: str) -> bool:
    """Write beside the target and rename at the end, so that no reader sees half
    a table; False, writing nothing, if it is there already."""
    spark = df.sparkSession
    if exists(spark, path):
        return False
    staging = f"{path}.staging-{uuid.uuid4().hex}"  # writers at the same time don't meet
    df.write.parquet(staging)
    jvm = spark._jvm
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (staging, path))
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(dst.getParent())
    if exists(spark, path):  # another writer was first
        forget(spark, staging)
        return False
    if not fs.rename(src, dst):
        raise OSError(f"{staging} can't be renamed")
    nested = f"{path}/{src.getName()}"
    if exists(spark, nested):  # it came between: a rename onto a folder goes inside it
        forget(spark, nested)
        return False
    return True


#: The file of a published table that names the folder of its data.
POINTER = "_published"


def publish_version(df: DataFrame, path: str) -> bool:
    """Publish where a rename may be a copy: df is written to a folder of its own
    under path, then a pointer to it is created, which only one of any number
    of writers can. False, leaving nothing, if the table is there already or
    another writer is first. Readers use read_published() and see no table or a
    whole one; data of a writer that died is never pointed to."""
    spark = df.sparkSession
    if exists(spark, f"{path}/{POINTER}"):
        return False
    own = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{own}")
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    try:
        out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)  # never replaces
    except Exception:
        forget(spark, f"{path}/{own}")
        if not exists(spark, f"{path}/{POINTER}"):
            raise
        return False
    out.write(bytearray(f"{own}\n".encode()))
    out.close()
    return True


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table published at path. A pointer without its line end is one whose
    writer is not done: as if nothing were published."""
    if exists(spark, f"{path}/{POINTER}"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        source = fs.open(p)
        line = bytes(source.readNBytes(256)).decode()
        source.close()
        if line.endswith("\n"):
            return spark.read.parquet(f"{path}/{line.strip()}")
    raise FileNotFoundError(f"nothing is published at {path}")


def write_selected(df: DataFrame, path: str, variables: Sequence[str], coords: Sequence[str], compression: str = "zstd") -> None:
    """The variables as float, with their coordinates."""
    df.select(*coords, *[F.col(v).cast("float").alias(v) for v in variables]).write.option("compression", compression).parquet(path)
