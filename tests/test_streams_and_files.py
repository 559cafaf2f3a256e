"""Years from a stream, tables published by a pointer, files combined by time."""

import glob
import threading

import pytest
from pyspark.sql import functions as F

from gridspark.sources import incremental, tables
from gridspark.streaming import annual

SCHEMA = "cell string, yr int, mon int, dim int, v double"


def months(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def year(cell, yr, mons, v=1.0):
    return [(cell, yr, m, 30 + m % 2, None if m == 5 else v * m) for m in mons]


def mean(v=1.0):
    w = {m: 30 + m % 2 for m in range(1, 13)}
    return round(sum(v * m * w[m] for m in w if m != 5) / sum(w.values()), 9)


def test_years_from_a_stream(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))

    def run(files=None):
        annual.annual_stream(spark, src, SCHEMA, dst, cp, ["cell"], "v", "dim", "yr", "mon", files).awaitTermination()
        got = spark.read.parquet(dst)
        return sorted((r.cell, r.yr, round(r.mean, 9)) for r in got.collect())

    months(spark, year("a", 2000, range(1, 13)) + year("a", 2001, range(1, 7)) + year("b", 2000, [1, 2]), src)
    assert run() == [("a", 2000, mean())]
    months(spark, year("a", 2001, [*range(8, 13), 3]) + year("a", 2000, [7], v=99.0), src)  # one comes again, one is late
    assert run() == [("a", 2000, mean())]
    months(spark, year("a", 2001, [7]), src)  # the late month; a restart from the checkpoint
    months(spark, year("b", 2000, range(3, 13)), src)
    want = [("a", 2000, mean()), ("a", 2001, mean()), ("b", 2000, mean())]
    assert run(files=1) == want
    assert run() == want  # nothing new


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    each = annual.batch_folder(str(tmp_path / "t"))
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    for _ in range(2):
        each(df, 4)
    each(df.where("k = 1"), 5)
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.count() == 3 and sorted(r.batch for r in got.select("batch").distinct().collect()) == [4, 5]


def test_appending_reads_no_target(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("src", "dst", "cp"))
    months(spark, year("a", 2000, range(1, 4)), src)
    for _ in range(2):
        q = annual.append_stream(spark, src, SCHEMA, dst, cp, ["cell", "yr", "mon"])
        q.awaitTermination()
        months(spark, year("a", 2000, range(2, 6)), src)
    assert sorted(r.mon for r in spark.read.parquet(dst).collect()) == [1, 2, 3, 4, 5]


def test_two_publishers_one_winner(spark, tmp_path):
    path = str(tmp_path / "p" / "v1")
    with pytest.raises(FileNotFoundError):
        incremental.read_published(spark, path)
    wins, tables_ = [], [spark.range(k * 1000, k * 1000 + 1000).repartition(8) for k in range(4)]

    def publish(k):
        if incremental.publish_version(tables_[k], path):
            wins.append(k)

    threads = [threading.Thread(target=publish, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1
    got = incremental.read_published(spark, path)
    assert (got.count(), got.agg(F.min("id")).first()[0]) == (1000, wins[0] * 1000)
    assert len(glob.glob(f"{path}/data-*")) == 1  # the others left nothing
    assert not incremental.publish_version(tables_[0], path)


def test_a_writer_that_died_is_not_seen(spark, tmp_path):
    path = tmp_path / "v1"
    spark.range(3).write.parquet(str(path / "data-dead"))
    with pytest.raises(FileNotFoundError):
        incremental.read_published(spark, str(path))
    assert incremental.publish_version(spark.range(5), str(path))
    assert incremental.read_published(spark, str(path)).count() == 5


def files_of(spark, tmp_path, extents):
    out = []
    for k, (a, b) in enumerate(extents):
        p = str(tmp_path / f"f{k}")
        spark.range(a, b + 1).select(F.col("id").cast("int").alias("time"), F.lit(k).alias("k")).coalesce(1).write.parquet(p)
        out += [f"file://{x}" for x in glob.glob(f"{p}/*.parquet")]
    return out


def test_combined_by_time(spark, tmp_path):
    files = files_of(spark, tmp_path, [(10, 19), (0, 9), (20, 29)])
    where = str(tmp_path / "manifest")
    got = tables.combine(spark, files, "time", 1, 12, 22, where)
    assert sorted(r.time for r in got.collect()) == list(range(12, 23))
    assert {f.rsplit("/", 1)[1] for f in got.inputFiles()} == {files[k].rsplit("/", 1)[1] for k in (0, 2)}  # the first ten are not opened
    assert spark.read.parquet(where).count() == 3
    assert tables.combine(spark, files, "time", 1, path=where).count() == 30
    assert tables.combine(spark, files, "time", 1, first=99).count() == 0


@pytest.mark.parametrize(("extents", "what"), [([(0, 9), (9, 12)], "overlap"), ([(0, 20), (3, 4), (21, 25)], "overlap"), ([(0, 9), (12, 15)], "gap")])
def test_files_that_do_not_follow(spark, tmp_path, extents, what):
    with pytest.raises(ValueError, match=what):
        tables.combine(spark, files_of(spark, tmp_path, extents), "time", 1)
    if what == "gap":
        assert tables.combine(spark, files_of(spark, tmp_path / "more", extents), "time").count() == 14
