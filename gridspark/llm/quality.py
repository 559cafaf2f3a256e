"""Quality classifier by importance resampling (operator 2).

Two generative models of hashed n-grams, one of labelled good texts (target)
and one of all texts (raw), give each document the weight log p_target - log
p_raw, summed over its n-grams. Gumbel top-k over weight + Gumbel noise hashed
from the id samples k documents without replacement in proportion to their
weights; the others are rejected. n-grams are words, word pairs, and pairs of
word shapes with the distance to an equal word just before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm import textops
from gridspark.llm.common import free, in_small_batches, written

#: Buckets of words and pairs, and of shape pairs.
WORDS_LOG2, SHAPES_LOG2 = 15, 13
#: At most so many labelled rows fit the target model.
LABELLED = 20_000
SEED = 17


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every n-gram of a block of texts."""
    buf, starts, ends, doc = textops.words(texts)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = textops.KIND[buf]
    h = textops.hashes(textops.LOWER[buf], starts, ends)
    n = ends - starts
    upper = textops.counts(kind == 1, starts, ends)
    mark = np.minimum(textops.counts(kind >= 3, starts, ends), 3)
    digit = textops.counts(kind == 2, starts, ends) > 0
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(upper * 2 >= n, 3, 2)))
    shape = ((((kind[starts] * 5 + kind[ends - 1]) * 4 + case) * 4 + mark) * 2 + digit).astype(np.uint64)
    prev = np.zeros(len(h), np.uint64)
    prev[1:] = np.where(doc[1:] == doc[:-1], h[:-1], np.uint64(0))
    before = np.zeros(len(h), np.uint64)
    before[1:] = np.where(doc[1:] == doc[:-1], shape[:-1] + np.uint64(1), np.uint64(0))
    lag = np.zeros(len(h), np.uint64)
    for d in range(6, 0, -1):
        lag[d:][(h[d:] == h[:-d]) & (doc[d:] == doc[:-d])] = d
    one = h >> np.uint64(64 - WORDS_LOG2)
    two = textops.mixed(prev * np.uint64(3) + h) >> np.uint64(64 - WORDS_LOG2)
    three = textops.mixed((before * np.uint64(4096) + shape) * np.uint64(8) + lag + np.uint64(1)) >> np.uint64(64 - SHAPES_LOG2)
    size = 1 << WORDS_LOG2
    return np.concatenate([one, two + np.uint64(size), three + np.uint64(2 * size)]).astype(np.int64), np.tile(doc, 3)


N_BUCKETS = 2 * (1 << WORDS_LOG2) + (1 << SHAPES_LOG2)
#: The three kinds of n-grams, each with a distribution of its own.
PARTS = ((0, 1 << WORDS_LOG2), (1 << WORDS_LOG2, 2 << WORDS_LOG2), (2 << WORDS_LOG2, N_BUCKETS))


def _labelled(labels: DataFrame, most: int, part: str) -> DataFrame:
    """At most `most` labelled rows, by a hash of the id, one per doc_id (the
    lower label where they differ); of these four fifths fit the target model and
    the others, which it has not seen, set the cut-off."""
    some = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    some = some.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return some.orderBy(F.xxhash64(F.col("doc_id"), F.lit(SEED)), "doc_id").limit(most).where(part)


FIT, CUT = (f"pmod(xxhash64(doc_id, {SEED + 1}), 5) {x} 4" for x in ("<", "="))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", labelled: int = LABELLED) -> np.ndarray:
    """log p_target - log p_raw of each bucket. Counts cover all texts (raw) and
    those of at most `labelled` rows of labels (doc_id, quality); only sums per bucket, a fixed number, reach the driver. Labels
    that are null or of unknown documents are ignored."""
    some = _labelled(labels, labelled, FIT)
    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.join(F.broadcast(some), "doc_id", "left").select("text", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(N_BUCKETS, np.int64), np.zeros(N_BUCKETS, np.int64)
        for b in batches:
            good = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for at, texts in textops.blocks([x or b"" for x in b.column(0).to_pylist()]):
                bucket, doc = features(texts)
                raw += np.bincount(bucket, minlength=N_BUCKETS)
                target += np.bincount(bucket[good[at + doc]], minlength=N_BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(N_BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])

    parts = rows.mapInArrow(run, "bucket int, raw long, target long").where("raw > 0")
    sums = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    raw[sums.bucket], target[sums.bucket] = sums.raw, sums.target
    ratio = np.zeros(N_BUCKETS)
    for a, b in PARTS:
        if target[a:b].sum() > 0:
            # the raw distribution is also the prior of the target's, as heavy as one count a bucket
            p = (raw[a:b] + 1) / (raw[a:b].sum() + b - a)
            ratio[a:b] = np.log((target[a:b] + (b - a) * p) / (target[a:b].sum() + b - a)) - np.log(p)
    return ratio


def weights(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, log_weight) of every row; no words: 0."""
    ratio = ratio.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros(b.num_rows)
            for at, texts in textops.blocks([x or b"" for x in b.column(1).to_pylist()]):
                bucket, doc = features(texts)
                out[at : at + len(texts)] = np.bincount(doc, ratio[bucket].astype(np.float64), len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["doc_id", "log_weight"])

    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, log_weight double")


def with_keys(scored: DataFrame, seed: int = SEED) -> DataFrame:
    """scored and gumbel_key: log_weight + a Gumbel(0, 1) number hashed from the id."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u)))


def cut_off(scored: DataFrame, labels: DataFrame, labelled: int = LABELLED, slack: float = 0.002) -> float:
    """The least weight that parts labelled good from labelled bad rows with a
    balanced accuracy within `slack` of the best, so that doubtful rows stay;
    from at most `labelled` of them; no bad ones: -infinity."""
    some = _labelled(labels, labelled, CUT)
    got = scored.join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min("log_weight").alias("w")).toPandas().sort_values("w")
    good = (got.quality == 1).to_numpy()
    if good.all() or not good.any():
        return float("-inf")
    w = got.w.to_numpy()
    # cut below row k: bad rows before it are right, good rows from it on are right
    right = np.r_[0, np.cumsum(~good)] / (~good).sum() + np.r_[good.sum() - np.r_[0, np.cumsum(good)]] / good.sum()
    k = int(np.argmax(right >= right.max() - 2 * slack))
    return float((w[max(k - 1, 0)] + w[min(k, len(w) - 1)]) / 2)


def top_k(keyed: DataFrame, k: int) -> DataFrame:
    """keyed and kept: whether a row is among the k largest gumbel_keys (ties by
    doc_id). A range sort numbers rows within partitions; counts per partition
    make the numbers global."""
    rows = written(keyed.orderBy(F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "quality-order")
    part = rows.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    part = part.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row per partition of the sort
    rows = rows.join(F.broadcast(part), F.shiftright("at", 33) == F.col("part"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("kept", rank < k).drop("at", "part", "before")


def resample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int | None = None, labelled: int = LABELLED) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, kept) of every row.

    k: how many rows the sample has; by default as many as weigh more than the
    cut-off that the labels give. Null text: empty, weight 0. Rows that repeat a
    doc_id have keys of their own texts. No labels: all weights are 0 and all
    rows are kept. Whole texts are weighed, however long; an empty table gives no
    rows; other columns are ignored whatever their names.
    """
    scored = written(weights(docs, fit(docs, labels, doc_id, text, labelled), doc_id, text), "quality-weights")
    if k is None:
        k = scored.where(F.col("log_weight") >= cut_off(scored, labels, labelled)).count()
    return top_k(with_keys(scored), k)


def select(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs that the sample keeps, with all their columns, whatever
    these are called. Of rows that repeat a doc_id all stay if one does. Null
    texts, long texts and empty tables are as in resample()."""
    (name,) = free(docs, "__kept")
    kept = resample(docs, labels, doc_id, text, **how).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, docs[doc_id].cast("long").eqNullSafe(F.col(name)), "left_semi")
