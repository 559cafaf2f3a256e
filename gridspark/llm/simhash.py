"""SimHash near-dedup by segment-popcount embedding (operator 4).

A fingerprint's 64 bits are cut into 32 segments of two bits; the 32 bit counts
(0, 1 or 2) are a point of a grid, and the Manhattan distance of two points
never exceeds the Hamming distance of the fingerprints. Fingerprints that
differ in at most four bits are thus within Manhattan distance two in one of
the two halves of 16 counts, so that a grid point within one step of both
exists there. Each fingerprint is put into the cells within one step of its
own in either half (about 50), the cells are joined, and each candidate is
verified on the exact bits. No link is lost, and none is made up.

A crowded cell is cut along the other half in the same way: of two fingerprints
that differ there in at most four bits, one of its two quarters is within
Manhattan distance two, so that they meet in a cell of that quarter's grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import connected_components, free, in_small_batches, join_bounded, written

#: Cells of more fingerprints than this are cut along the other half.
HOT_CELL = 4_096
#: Cells above this many are searched breadth first, one against the rest.
DENSE_RUN = 48
MAX_BITS = 4


def fingerprint(raw: bytes, words_per_shingle: int = 4) -> int:
    """SimHash of a whole text: lower-cased A-Z, words cut at ASCII white
    space, each shingle's XXH64 (seed 42) counted as often as it occurs; a bit
    is set if it is set in over half. No words: zero."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= words_per_shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[: n - words_per_shingle] + 1])
        h = xxhash.xxh64_intdigest
        hashes = np.fromiter((h(line[a:b], 42) for a, b in zip(starts.tolist(), ends[words_per_shingle - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. A narrow pass over
    the whole texts; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x or b"", words_per_shingle) for x in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _counts(bits: Column) -> Column:
    """The bit counts of two-bit segments, two bits each."""
    return bits.bitwiseAND(F.lit(0x55555555)) + F.shiftright(bits, 1).bitwiseAND(F.lit(0x55555555))


def _half(fp: Column, half: int) -> Column:
    return _counts(F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF)))


def _near(point: Column, segments: int, tag: int) -> list[Column]:
    """The cells within one step of a grid point, null where a step leads off
    the grid; tag tells grids apart, above the point's 32 bits."""
    out = [point + F.lit(tag << 32)]
    for seg in range(segments):
        count = F.shiftright(point, 2 * seg).bitwiseAND(F.lit(3))
        out.append(F.when(count < 2, point + F.lit((1 << 2 * seg) + (tag << 32))))
        out.append(F.when(count > 0, point + F.lit((tag << 32) - (1 << 2 * seg))))
    return out


def _cells(fp: Column) -> Column:
    """The cells within one step of fp's grid point, in either half."""
    return F.array_compact(F.array(*[c for half in (0, 1) for c in _near(_half(fp, half), 16, half)]))


def _parts(fp: Column, key: Column) -> Column:
    """The cells within one step in either quarter of the half that key is not of."""
    other = F.when(F.shiftright(key, 32) == 0, _half(fp, 1)).otherwise(_half(fp, 0))
    quarters = [F.shiftright(other, 16 * q).bitwiseAND(F.lit(0xFFFF)) for q in (0, 1)]
    return F.array_compact(F.array(*[c for q in (0, 1) for c in _near(quarters[q], 8, q + 1)]))


def _crowded(fps: DataFrame, most: int) -> DataFrame:
    """(key) of the cells that more than `most` fingerprints go to, counted from
    the numbers of fingerprints at each grid point."""
    points = F.array(*[_half(F.col("fp"), half) + F.lit(half << 32) for half in (0, 1)])
    points = fps.select(F.explode(points).alias("point")).groupBy("point").agg(F.count("*").alias("n"))
    low, half = F.col("point").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("point", 32)
    cells = F.array_compact(F.array(*_near(low, 16, 0)))
    cells = points.select(F.explode(cells).alias("key"), half.alias("half"), "n").withColumn("key", F.col("key") + F.col("half") * (1 << 32))
    return cells.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > most).select("key")


def _links(key: np.ndarray, fp: np.ndarray, most: int) -> list[np.ndarray]:
    """Verified links within runs of equal keys: all in short runs, a spanning
    forest in dense ones (a cell only has to connect what it links)."""
    fp = fp.view(np.uint64)  # bitwise_count takes a signed number's absolute value
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[start, len(key)])
    found = []
    at = np.repeat(start[(length > 1) & (length <= DENSE_RUN)], length[(length > 1) & (length <= DENSE_RUN)])
    if len(at):
        own = length[(length > 1) & (length <= DENSE_RUN)]
        pos = np.arange(len(at)) - np.repeat(np.cumsum(own) - own, own)
        left, end = at + pos, at + np.repeat(own, own)
        for step in range(1, int(own.max())):
            keep = left + step < end
            left, end = left[keep], end[keep]
            x, y = fp[left], fp[left + step]
            near = np.bitwise_count(x ^ y) <= most
            if near.any():
                found.append(np.stack([x[near], y[near]]))
    for s, n in zip(start[length > DENSE_RUN].tolist(), length[length > DENSE_RUN].tolist(), strict=True):
        rest, queue = fp[s + 1 : s + n], [fp[s]]
        while len(rest):
            x = queue.pop() if queue else None
            if x is None:
                x, rest = rest[0], rest[1:]
            near = np.bitwise_count(rest ^ x) <= most
            if near.any():
                y = rest[near]
                found.append(np.stack([np.full(len(y), x, np.uint64), y]))
                queue.extend(y)
                rest = rest[~near]
    return [x.view(np.int64) for x in found]


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp, long) that connect
    all pairs at `max_bits` (4 at most) or fewer differing bits; every link is
    one such pair. A cell of more than `hot_cell` fingerprints is joined by the
    finer cells of its other half, so that a task meets those alone."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the grid join is exact up to 4 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            found = _links(key, fp, max_bits)
            x = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
            x = np.unique(np.sort(x, 0), axis=1) if x.shape[1] else x
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], names=["a", "b"])

        last, number = None, 0
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            k, f = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]), b.column(2).to_numpy()
            first = np.array([[k[0, 0]], [k[1, 0]]]) if last is None else last
            new = (np.c_[first, k][:, 1:] != np.c_[first, k][:, :-1]).any(0)
            runs = number + np.cumsum(new)  # cells numbered in the order they come
            last, number = k[:, -1:], int(runs[-1])
            key, fp = np.r_[key, runs], np.r_[fp, f]
            done = int(np.searchsorted(key, key[-1]))
            if done:
                yield out(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
        if len(key):
            yield out(key, fp)

    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = fps.repartition(tasks).select(F.explode(_cells(F.col("fp"))).alias("key"), "fp")
    crowded = written(_crowded(fps, hot_cell), "simhash-crowded")
    if crowded.isEmpty():
        cells = cells.withColumn("part", F.lit(0).cast("long"))
    else:
        cells = join_bounded(cells, crowded.withColumn("cut", F.lit(True)), "key", "left")
        cells = cells.select("key", "fp", F.explode(F.when(F.col("cut"), _parts(F.col("fp"), F.col("key"))).otherwise(F.array(F.lit(0).cast("long")))).alias("part"))
    cells = cells.select("key", "part", "fp").repartition("key", "part").sortWithinPartitions("key", "part")
    return written(cells.mapInArrow(run, "a long, b long"), "simhash-links").distinct()


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, words_per_shingle: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest
    doc_id that links reach, itself included.

    Null text: as empty. Texts without words share fingerprint zero and are
    linked like any others. A null doc_id keeps its row and is never the
    smallest of a group that has another. Repeated rows stay repeated. Other
    columns are ignored whatever their names; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, doc_id, text, words_per_shingle), "simhash-rows")
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = written(groups, "simhash-distinct")
    comp = connected_components(fingerprint_links(groups.select("fp"), max_bits), "simhash-components")
    by = groups.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    low = by.groupBy("component").agg(F.min("least").alias("component_id"))
    by = by.join(low, "component").select("fp", "component_id")
    return rows.join(by, "fp").select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """docs without the near-duplicates: of each group the row with the smallest
    doc_id stays; rows that share that doc_id all stay.

    Null text: as empty. Texts without words are one group. A null doc_id stays
    only where its group has no other. Whole texts are read, however long; an
    empty table gives no rows; all columns stay, whatever their names.
    """
    groups = near_groups(docs, doc_id, text, max_bits)
    (kept,) = free(docs, "__kept")
    keep = groups.where("doc_id <=> component_id").select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(keep, docs[doc_id].eqNullSafe(F.col(kept)), "left_semi")
