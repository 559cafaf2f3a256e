"""Line dedup by pairwise alignment (operator 3).

Documents are paired through hashes of short runs of lines, the shortest with
LEAST_CHARS characters from each line on and up to each line: every holder of a
run with the run's first holder. A pair's shared runs, at their places in both,
are aligned by patience diff, and what it matches is deleted from the later
document. Runs that it leaves, as the later document has passages in another
order, are aligned again, until all are matched.

Only places of shared runs meet, never whole documents. That gives what pairing
all holders of every line would, with pairs that grow with the lines: a block
consists of such runs, whoever else has it, and of each the first holder has it
too. A run's first holder has nobody before it, so one copy of every block stays.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm import textops
from gridspark.llm.common import free, in_small_batches, written

#: An aligned block of fewer characters stays.
LEAST_CHARS = 20


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs, ordered by the first, that increases in the second."""
    tops, at, back = [], [], []
    for k, (_, y) in enumerate(pairs):
        p = bisect_left(tops, y)
        tops[p : p + 1] = [y]
        at[p : p + 1] = [k]
        back.append(at[p - 1] if p else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _numbered(x: Sequence[int], start: int, stop: int) -> dict[tuple[int, int], int]:
    """Positions by line and by which of its occurrences in the range it is."""
    seen: Counter = Counter()
    out = {}
    for k in range(start, stop):
        out[x[k], seen[x[k]]] = k
        seen[x[k]] += 1
    return out


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), increasing in both: equal lines at the
    ends of a range match; within, lines that occur once in either are anchors,
    the longest increasing run of which parts the range, and so on. Where no
    line occurs once, the n-th occurrences of a line are anchors."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        where = {x: k for k, x in enumerate(a[i:m], i) if in_a[x] == 1 and in_b.get(x) == 1}
        anchors = _increasing([(k, where[x]) for k, x in enumerate(b[j:n], j) if x in where])
        if not anchors:
            where = _numbered(a, i, m)
            anchors = _increasing([(k, where[x]) for x, k in _numbered(b, j, n).items() if x in where])
        if not anchors:
            continue
        out += [(x, y) for y, x in anchors]
        for (y, x), (v, u) in zip([(j - 1, i - 1), *anchors], [*anchors, (n, m)], strict=True):
            if x + 1 < u and y + 1 < v:
                todo.append((x + 1, u, y + 1, v))
    return sorted(out)


def windows(size: np.ndarray, full: np.ndarray, low: np.ndarray | int, high: np.ndarray | int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest runs of lines with `least` characters and
    a full line, from each line on and up to each line, that lie in its document
    (from low to high). Any such run is covered by those within it."""
    c, f, k = np.r_[0, np.cumsum(size)], np.r_[0, np.cumsum(full)], np.arange(len(size))
    end = np.maximum(np.searchsorted(c, c[:-1] + least), np.searchsorted(f, f[:-1] + 1))
    start = np.minimum(np.searchsorted(c, c[1:] - least, "right"), np.searchsorted(f, f[1:] - 1, "right")) - 1
    end, start = np.maximum(end, k + 1), np.minimum(start, k)
    on, up = end <= high, start >= low
    return np.r_[k[on], start[up]], np.r_[end[on], k[up] + 1]


def aligned(a: Sequence[int], b: Sequence[int], start: Sequence[int], end: Sequence[int]) -> list[int]:
    """Lines of b that alignment finds in a. a and b are the runs that both have,
    in the order of their places, b's from line `start` to `end`. Runs that
    patience diff matches go with all their places in b; those that are left, as
    b has passages in another order, are aligned again until none is."""
    gone: set[int] = set()
    left = list(range(len(b)))
    while left:
        runs = [b[k] for k in left]
        done = {runs[y] for _, y in patience(a, runs)}
        if not done:
            break
        for k in left:
            if b[k] in done:
                gone.update(range(start[k], end[k]))
        a, left = [x for x in a if x not in done], [k for k in left if b[k] not in done]
    return sorted(gone)


def blocks(a: Sequence[str], b: Sequence[str], least: int = LEAST_CHARS) -> list[int]:
    """Positions in b of the blocks of `least` characters that alignment finds in
    a, for two documents' lines: what kept_lines() does for all documents."""
    found = []
    for x in (a, b):
        size, full = np.array([len(y) for y in x], np.int64), np.array([y.strip(" ") != "" for y in x], bool)
        start, end = windows(size, full, 0, len(x), least)
        order = np.lexsort((end, start))
        found.append([(s, e, tuple(x[s:e])) for s, e in zip(start[order].tolist(), end[order].tolist())])
    first: dict = {}
    for s, e, run in found[0]:
        first.setdefault(run, (s, e))
    own = [(s, e, first[run]) for s, e, run in found[1] if run in first]
    return aligned(sorted({x for *_, x in own}), [x for *_, x in own], [s for s, _, _ in own], [e for _, e, _ in own])


def _key(doc_id: str, text: str) -> Column:
    """A document: its id and its text's hash, so that rows which repeat an id
    with other texts are documents of their own, the order being theirs too."""
    return F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("t"))


def kept_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(d, keep) of each document that loses lines: keep is an array of boolean,
    one for each line up to the last that goes."""
    lines = F.split(F.col(text), "\n", -1)
    rows = docs.where(F.col(text).isNotNull()).select(
        _key(doc_id, text).alias("d"),
        F.transform(lines, lambda x: F.xxhash64(x)).alias("h"),
        F.transform(lines, lambda x: F.char_length(x)).alias("n"),
        F.transform(lines, lambda x: F.trim(x) != "").alias("full"),
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if not t.num_rows:
                continue
            count = pc.list_value_length(t.column(1)).to_numpy()
            last = np.cumsum(count)
            doc = np.repeat(np.arange(t.num_rows), count)
            h, n, full = (c.flatten().to_numpy(zero_copy_only=False) for c in t.columns[1:])
            start, end = windows(n, full, (last - count)[doc], last[doc], least_chars)
            line, doc = textops.hashes(textops.mixed(h.astype(np.uint64)), start, end).astype(np.int64), doc[start]
            order = np.lexsort((start, line, doc))
            line, doc, start, length = line[order], doc[order], start[order], (end - start)[order]
            run = np.r_[True, (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])][: len(line)]
            place = run | np.r_[True, start[1:] != start[:-1]][: len(line)]
            run, line, doc, start, length = (x[place] for x in (run, line, doc, start, length))
            new = np.flatnonzero(run)
            places = pa.ListArray.from_arrays(pa.array(np.r_[new, len(line)], pa.int32()), pa.array(start - (last - count)[doc], pa.int32()))
            yield pa.RecordBatch.from_arrays([t.column(0).take(pa.array(doc[new])), pa.array(line[new]), pa.array(length[new], pa.int32()), places], names=["d", "line", "lines", "places"])

    kind = "d struct<id: long, t: long>"
    distinct = in_small_batches(rows.dropDuplicates(["d"]))
    held = written(distinct.mapInArrow(runs, f"{kind}, line long, lines int, places array<int>"), "line-runs")
    first = held.groupBy("line").agg(F.min(F.struct("d", F.get("places", F.lit(0)).alias("place"))).alias("f"), F.count("*").alias("holders"))
    first = first.where("holders > 1").select("line", F.col("f.d").alias("a"), F.col("f.place").alias("place"))
    first = written(first, "line-first")  # a join of two plain shuffles, so that Spark can split a hot run
    shared = held.join(first, "line").where("d <> a")
    pairs = shared.groupBy("a", "d").agg(F.collect_list(F.struct("place", "lines", "places")).alias("runs"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            gone = []
            for found in t.column(1).to_pylist():
                own = sorted((s, x["lines"], (x["place"], x["lines"])) for x in found for s in x["places"])
                gone.append(aligned(sorted({x for *_, x in own}), [x for *_, x in own], [s for s, _, _ in own], [s + n for s, n, _ in own]))
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["d", "gone"])

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            out = []
            for gone in t.column(1).to_pylist():
                keep = np.ones(max(gone) + 1, bool)
                keep[gone] = False
                out.append(keep)
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(out, pa.list_(pa.bool_()))], names=["d", "keep"])

    found = pairs.select("d", "runs").mapInArrow(align, f"{kind}, gone array<int>").where(F.size("gone") > 0)
    found = found.groupBy("d").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    return found.mapInArrow(masks, f"{kind}, keep array<boolean>")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """docs with the aligned blocks deleted from text, and the column
    lines_removed; all rows and other columns stay.

    Lines end at a line feed. Blank lines alone pair no documents but go with a
    block.
    Null text stays null; a text of which nothing is left is empty. Exact copies
    lose all lines but in the first. Rows equal in id and text are one document.
    Order is by doc_id (null first), then by the text's hash. Whole texts are
    compared, however long; an empty table gives no rows. Columns may have any
    names; one called lines_removed is replaced.
    """
    key, of, mask = free(docs, "__key", "__d", "__keep")
    keep = written(kept_lines(docs, doc_id, text, least_chars), "line-masks").toDF(of, mask)
    out = docs.withColumn(key, _key(doc_id, text)).join(keep, F.col(key) == F.col(of), "left")
    left = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x, i: F.coalesce(F.get(F.col(mask), i), F.lit(True))), "\n")
    gone = F.coalesce(F.size(F.filter(mask, lambda x: ~x)), F.lit(0))
    columns = [F.when(F.col(mask).isNull(), F.col(text)).otherwise(left).alias(c) if c == text else F.col(c) for c in docs.columns if c != "lines_removed"]
    return out.select(*columns, F.when(F.col(mask).isNull(), 0).otherwise(gone).alias("lines_removed"))
