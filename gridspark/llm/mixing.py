"""Mixing sources to target weights (operator 6), in DataFrame functions only.

Sizes are summed per source, each source gets a target, and a document is
emitted floor(rate) times plus once more if a number hashed from its id falls
below the fraction of the rate, rate = target / size of its source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import WORD, free, join_bounded, written
from gridspark.operators.ordering import global_cumsum, global_rank

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"


def n_words(text: Column) -> Column:
    """Words of the whole text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, size) rows to (source, source_size, target).

    Sources in code point order, null last, take the weights in turn, again and
    again, and share the sum of all sizes. No target exceeds `most` times its
    source's size; what is cut off is shared among the others by weight until
    none is above. With sources ordered by cap / weight this has a closed form:
    the level of the uncapped ones is the largest of (total - caps before) /
    (weights from here on). Sums are whole numbers, so reruns agree exactly.
    Ranks and running sums come from range sorts, however many sources there
    are; two totals and the level are all that the driver sees.
    """
    s = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    s = global_rank(s.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__k")
    turn = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.col("__k") - 1) % len(weights)).cast("int") + 1)
    s = s.withColumn("w", turn.cast("long")).withColumn("cap", F.col("source_size") * most)
    s = s.withColumn("__ratio", F.col("cap") / F.col("w")).select("source", "source_size", "w", "cap", "__ratio", "__k")
    s = global_cumsum(s, ["__ratio", "__k"], ["cap", "w"], ["__caps", "__ws"])
    total, weight = s.agg(F.sum("source_size"), F.sum("w")).first()
    level = (F.lit(total) - F.col("__caps") + F.col("cap")) / (F.lit(weight) - F.col("__ws") + F.col("w"))
    top = s.agg(F.max(level)).first()[0]
    target = F.least(F.col("cap").cast("double"), F.col("w") * F.lit(top).cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id alone: 52 bits of its MD5 under a seed."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def copies(doc_id: Column, source_size: Column, target: Column, seed: str = SEED) -> Column:
    """How often a document is taken: never where its source has no words."""
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    return (F.floor(rate) + F.when(uniform(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    return written(rows, "mix-sizes")


def _goal(sizes: DataFrame, **how) -> DataFrame:
    return written(targets(sizes, **how), "mix-targets").toDF("__source", "__size", "__target")


def _planned(rows: DataFrame, goal: DataFrame) -> DataFrame:
    out = join_bounded(rows, goal, rows["source"].eqNullSafe(goal["__source"]))
    times = copies(F.col("doc_id"), F.col("__size"), F.col("__target"))
    return out.select("doc_id", "source", "size", F.col("__size").alias("source_size"), F.col("__target").alias("target"), times.alias("copies"))


def _emitted(docs: DataFrame, goal: DataFrame, doc_id: str, source: str) -> DataFrame:
    of, size, target, copy = free(docs, "__source", "__size", "__target", "__copy")
    out = join_bounded(docs, goal.toDF(of, size, target), F.col(source).eqNullSafe(F.col(of)))
    times = copies(F.col(doc_id), F.col(size), F.col(target))
    return out.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), times)).alias(copy)).drop(copy)


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """(doc_id, size, source_size, target, copies) for every row of docs.

    The texts are read once; sizes are written and joined to the targets, one
    row per source. Rows that repeat a doc_id are decided alike; a null doc_id,
    source or text is allowed (source null is a source of its own, the last one;
    text null has no words). Texts of any length are counted whole; an empty
    table gives no rows; other columns are ignored whatever their names.
    """
    rows = _sized(docs, doc_id, text, source)
    return _planned(rows, _goal(rows, **how)).drop("source")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """docs with every row repeated as often as it is taken, columns kept whatever
    their names. Nulls, long texts, repeated rows and empty tables: as in plan()."""
    sizes = docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    return _emitted(docs, _goal(sizes, **how), doc_id, source)


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs, taken
    being the words that mix() emits of it, counted in the texts emitted.

    Rows alike in id, source and size are emitted alike and share their words
    evenly. Nulls, long texts, empty tables and other columns: as in plan().
    """
    sizes = _sized(docs, doc_id, text, source)
    goal = _goal(sizes, **how)
    none, one = (F.lit(k).cast("long") for k in (0, 1))
    out = _emitted(docs, goal, doc_id, source).select(F.col(doc_id).alias("__id"), F.col(source).alias("__of"), n_words(F.col(text)).alias("__n"))
    own = sizes.toDF("__id", "__of", "__n").select("*", none.alias("__words"), one.alias("__rows"))
    sums = own.unionByName(out.select("*", F.col("__n").alias("__words"), none.alias("__rows")))
    sums = sums.groupBy("__id", "__of", "__n").agg(F.sum("__words").alias("__words"), F.sum("__rows").alias("__rows"))
    sums = written(sums, "mix-taken")  # a join of two plain shuffles, so that Spark can split a hot id
    rows = _planned(sizes, goal)
    same = rows["doc_id"].eqNullSafe(sums["__id"]) & rows["source"].eqNullSafe(sums["__of"]) & (rows["size"] == sums["__n"])
    return rows.join(sums, same).select("doc_id", "size", "source_size", "target", F.expr("__words div __rows").alias("taken"))
