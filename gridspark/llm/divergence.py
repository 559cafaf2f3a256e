"""Source divergence audit (operator 11): how far the word shares of a
language's sources lie apart.

Terms are counted per (lang, source) group, combined in each task before any
shuffle. Kept terms are numbered; a group is a sparse array of ascending (term
id, count), cut into blocks of ids. For every unordered pair of a language's
groups and every block, the two arrays are co-grouped and merged by a galloping
intersection that prices overlaps and terms of one side; terms that neither has
are priced at once, by their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridspark.llm.common import in_small_batches, join_bounded, written
from gridspark.operators.ordering import global_rank

#: A share is 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)).
SCALE, PRIOR = 1_000_000_000, 5
#: Term ids of one sparse block, which bounds what a merge holds.
BLOCK = 1 << 12
#: Entries that a task counts before it hands them on.
HELD = 200_000
#: Bytes of a text whose terms are counted at once.
SLICE = 1 << 20

#: Every separator as a space, A-Z in lower case, all other bytes as they are.
_PLAIN = bytes(b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, slice by slice: runs of letters and of
    characters beyond ASCII, only A-Z lower-cased."""
    plain = text.translate(_PLAIN)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + SLICE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in a group and the
    documents that hold it; the row of term null counts the group's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (a, b), (n, d) in held.items():
                term = pa.array(list(d), pa.binary()).cast(pa.string())
                columns = [pa.array([a] * len(d)), pa.array([b] * len(d)), term, pa.array([n[t] for t in d], pa.int64()), pa.array(d.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for a, b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                n, d = held.setdefault((a, b), (Counter(), Counter()))
                before, seen = len(d), {None}
                for words in terms_of(raw.as_py()):
                    n.update(words)
                    seen.update(words)
                d.update(seen)
                size += len(d) - before
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    rows = in_small_batches(docs).select(*[F.coalesce(F.col(c), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "text"))])
    parts = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, v: Column) -> Column:
    """Exact for counts up to 10 ** 18: whole division of decimals."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(19,0)")
    return F.call_function("div", top, (total + PRIOR * v).cast("decimal(19,0)")) + 1


def shares(count: np.ndarray, total: int, v: int) -> np.ndarray:
    """The same of an array: long division, three digits of SCALE at a time, so
    that no product exceeds 64 bits where the divisor is below 9 * 10 ** 15."""
    d = np.int64(total + PRIOR * v)
    whole, rest = np.divmod(count.astype(np.int64) + PRIOR, d)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, d)
        whole = whole * 1000 + digits
    return whole + 1


def gallop(few: np.ndarray, many: np.ndarray, step: int = 64) -> np.ndarray:
    """The place in `many` of each of `few` (both ascending), or where it would
    stand: from the last place steps are doubled until they pass the next `step`
    needles, which are then found by halving within that stretch."""
    out = np.empty(len(few), np.int64)
    at = 0
    for k in range(0, len(few), step):
        part = few[k : k + step]
        wide = step
        while at + wide < len(many) and many[at + wide] < part[-1]:
            wide *= 2
        out[k : k + step] = at + np.searchsorted(many[at : at + wide + 1], part)
        at = int(out[k + len(part) - 1])
    return out


def price(ids: tuple[np.ndarray, np.ndarray], counts: tuple[np.ndarray, np.ndarray], totals: tuple[int, int], v: int) -> tuple[int, int]:
    """The sum of |p - q| over the terms that either group has in a block, and
    how many these are."""
    few = int(len(ids[1]) < len(ids[0]))
    many = 1 - few
    p, q = shares(counts[few], totals[few], v), shares(counts[many], totals[many], v)
    p0, q0 = (int(shares(np.zeros(1), totals[k], v)[0]) for k in (few, many))
    at = gallop(ids[few], ids[many])
    met = np.zeros(len(at), bool)
    inside = at < len(ids[many])
    met[inside] = ids[many][at[inside]] == ids[few][inside]
    alone = np.ones(len(q), bool)
    alone[at[met]] = False
    value = np.abs(p[met] - q[at[met]]).sum() + np.abs(p[~met] - q0).sum() + np.abs(q[alone] - p0).sum()
    return int(value), len(p) + int(alone.sum())


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one pair task each: two groups' arrays of one block, either of
    which may lack."""
    none = np.zeros(0, np.int64)
    for batch in batches:
        found = []
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            ids, counts = (tuple(row[f"{c}_{x}"].values.to_numpy() if row[f"{c}_{x}"].is_valid else none for x in "ab") for c in ("ids", "counts"))
            found.append(price(ids, counts, (row["total_a"].as_py(), row["total_b"].as_py()), row["v"].as_py()))
        value, met = (pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "a", "b")), value, met], names=["lang", "a", "b", "value", "met"])


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of a language's groups."""
    entry = F.sort_array(F.collect_list(F.struct("id", "n")))
    arrays = kept.groupBy("lang", "source", F.expr(f"id div {BLOCK}").alias("block")).agg(entry.alias("e"))
    arrays = written(arrays.select("lang", "source", "block", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")), "divergence-arrays")
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    sides = join_bounded(join_bounded(arrays, groups, ["lang", "source"]), other, "lang").where("source <> item")
    task = ["lang", "a", "b", "block", "v", "total_a", "total_b"]
    left = sides.where("source < item").select("lang", "source", "item", "block", "v", "total", "item_total", "ids", "counts").toDF(*task, "ids_a", "counts_a")
    right = sides.where("source > item").select("lang", "item", "source", "block", "v", "item_total", "total", "ids", "counts").toDF(*task, "ids_b", "counts_b")
    tasks = in_small_batches(left.join(right, task, "full_outer"))  # a row a side at most: co-grouped
    parts = tasks.drop("block").mapInArrow(_merge, "lang string, a string, b string, value long, met long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))
    left = groups.select("lang", "v", F.col("source").alias("a"), F.col("total").alias("total_a"))
    all_pairs = join_bounded(left, other.toDF("lang", "b", "total_b"), "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    zero = F.lit(0).cast("long")
    apart = F.abs(_share(zero, F.col("total_a"), F.col("v")) - _share(zero, F.col("total_b"), F.col("v")))
    absent = F.when(F.col("v") > 0, (F.col("v") - F.coalesce("met", zero)) * apart).otherwise(zero)
    way = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return all_pairs.select("lang", way.alias("way"), (F.coalesce("value", zero) + absent).alias("value")).select("lang", "way.source", "way.item", "value")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): for every group its language's
    other sources by distance (part `pair`, all of them) and the terms that it
    has more of than its language (part `term`, the first `top`).

    A language keeps the terms of at least `least_docs` of its documents; all
    its V kept terms count in every distance, with p = 1 + floor(10 ** 9 * (n +
    5) / (N + 5 V)) for n of the N occurrences of a group. Ranks run from 1, by
    value from the largest, ties by the item's UTF-8 bytes.

    Null text, lang or source: as ''. Empty texts belong to their group; a
    language that keeps no term gives distances of 0. Repeated rows are documents
    of their own. Texts of any length are counted in slices. An empty table gives
    no rows; other columns are ignored whatever their names.
    """
    counts = written(term_counts(docs, lang, source, text), "divergence-counts")
    own = counts.where("term is not null")
    terms = own.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    terms = global_rank(terms.drop("docs"), ["lang", "term"], "id")
    kept = written(own.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "divergence-kept")
    groups = counts.where("term is null").select("lang", "source")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = written(groups.na.fill(0, ["total", "v", "lang_total"]), "divergence-groups")

    more = join_bounded(kept, groups, ["lang", "source"])
    more = more.withColumn("value", _share(F.col("n"), F.col("total"), F.col("v")) - _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = more.select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    apart = _pairs(kept.select("lang", "source", "id", "n"), groups.drop("lang_total")).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return apart.withColumn("part", F.lit("pair")).select(*columns).unionByName(more.withColumn("part", F.lit("term")).select(*columns))
