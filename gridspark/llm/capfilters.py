"""Embedding near-dedup by spherical-cap filters (operator 1).

Filter directions form a structured random product code: space is rotated at
random and cut into blocks, each block has a few random codewords, and every
combination of one codeword per block is a direction. A vector goes to all
directions whose inner product exceeds a bound, found by list decoding: block
by block, keeping the partial sums that can still reach the bound. Vectors that
meet at a direction are compared exactly, in double precision, and linked from
the cosine 0.9 on. The links found connect components; a component's vectors
are then compared exactly among themselves for their numbers of links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import connected_components, join_bounded, written

COSINE = 0.9
#: Share of isolated pairs at the cosine asked for that no direction may bring
#: together, vectors that meet at one direction on average, and codes with a
#: rotation of their own.
MISS, MEET, CODES = 1e-5, 512, 16
#: Vectors that one task compares all with all, at most; those of a component
#: are cut finer, as long as that gives at most PARTS parts.
UNIT, LEAST_UNIT, PARTS = 2048, 128, 512
SEED = 7


class ProductCode:
    """Directions for dimension d, as many as n vectors call for: `codes` codes,
    each of a rotation of its own, so that no vector depends on one code's luck.

    As the rotations are random, a pair at `cosine` meets in each code with the
    same chance on its own, and all codes miss it with chance (1 - p) ** codes.
    The bound is set on planted pairs to the p that makes this `miss`, whatever
    n is; what grows with n is how many directions a vector exceeds (`filters`).
    """

    def __init__(self, d: int, n: int, miss: float = MISS, meet: int = MEET, codes: int = CODES, cosine: float = COSINE, seed: int = SEED):
        self.filters = 40.0
        for _ in range(2):  # the number of directions and that of a vector's filters follow each other
            rng = np.random.default_rng([seed, d])
            total = max(256.0, n * self.filters / meet / codes)
            # blocks of four dimensions or more, as codewords of fewer are all alike
            self.parts = min(max(1, d // 4), max(2, int(np.ceil(np.log(total) / np.log(4096)))))
            self.words = min(4096, max(2, int(np.ceil(total ** (1 / self.parts)))))
            self.cuts = np.linspace(0, d, self.parts + 1).astype(int)
            self.codes = []
            for _ in range(codes):
                rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
                blocks = []
                for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True):
                    c = rng.standard_normal((self.words, b - a))
                    blocks.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(self.parts))
                self.codes.append((rotation, blocks))
            x, y = planted_pairs(rng, 512, d, cosine)
            self._set_bound(x, y, 1 - miss ** (1 / codes))
            some = range(min(4, codes))
            self.filters = max(1.0, sum(len(self.decode(x, k)[0]) for k in some) / len(some) / len(x) * codes)

    def _set_bound(self, x: np.ndarray, y: np.ndarray, chance: float) -> None:
        """The highest bound at which planted pairs meet in a code with `chance`."""
        some = range(min(4, len(self.codes)))

        def enough(bound: float) -> bool:
            self.bound = bound
            return sum(self.meet(x, y, k).sum() for k in some) >= chance * len(some) * len(x)

        high, low = 1.0, 0.96
        while low > 1e-3 and not enough(low):  # downwards, as low bounds list many directions
            high, low = low, low * 0.96
        for _ in range(5):
            mid = (low + high) / 2
            low, high = (mid, high) if enough(mid) else (low, mid)
        self.bound = low

    def meet(self, x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        """Of pairs of unit rows, which share a direction of code k."""
        a, b = (np.stack(self.decode(z, k)) for z in (x, y))
        size = self.words**self.parts * (k + 1)
        hit = np.zeros(len(x), bool)
        hit[np.intersect1d(*(r * size + i for r, i in (a, b))) // size] = True
        return hit

    def decode(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of all directions of code k that unit rows exceed."""
        rotation, blocks = self.codes[k]
        y = x @ rotation
        parts = [y[:, a:b] @ c.T for a, b, c in zip(self.cuts[:-1], self.cuts[1:], blocks, strict=True)]
        rest = [p.max(1) for p in parts]
        rows, sums, ids = np.arange(len(x)), np.zeros(len(x)), np.full(len(x), k, np.int64)
        for j, p in enumerate(parts):
            total = sums[:, None] + p[rows]
            need = self.bound - sum(rest[j + 1 :], np.zeros(len(x)))
            at, word = np.nonzero(total >= need[rows, None])
            rows, sums, ids = rows[at], total[at, word], ids[at] * self.words + word
        return rows, ids


@lru_cache(maxsize=8)
def product_code(d: int, n: int, miss: float = MISS, meet: int = MEET, cosine: float = COSINE) -> ProductCode:
    return ProductCode(d, n, miss, meet, cosine=cosine)


def planted_pairs(rng: np.random.Generator, n: int, d: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """n pairs of random unit rows with the cosine given (in one dimension: of +-1)."""
    x, u = _unit(rng.standard_normal((n, d))), rng.standard_normal((n, d))
    if d == 1:
        return x, x
    u = _unit(u - (u * x).sum(1, keepdims=True) * x)
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * u


def _unit(block: np.ndarray) -> np.ndarray:
    """Rows of length one; by their largest part first, so that squares of huge
    or tiny numbers stay in range."""
    block = block / np.abs(block).max(1, keepdims=True)
    return block / np.linalg.norm(block, axis=1, keepdims=True)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of one dimension, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)


def _units(rows: DataFrame, key: str, least: int) -> DataFrame:
    """rows with the columns x and y of the unit of work they take part in. A
    key of up to `least` rows is one unit; a larger one is cut into parts by a
    hash of vec_id, of UNIT rows at most, and each pair of parts is a unit, so
    that all pairs of rows meet and no task gets more than two parts."""
    large = written(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > min(least, UNIT)), "cap-large")
    size = F.least(F.lit(UNIT), F.greatest(F.lit(least), F.col("n") / PARTS))
    out = join_bounded(rows, large, key, "left").withColumn("parts", F.coalesce(F.ceil(F.col("n") / size), F.lit(1)).cast("int"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    out = out.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return out.withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other")).drop("n", "parts", "other")


def _by_unit(rows: DataFrame, key: str, kind: str, work: Callable[..., list[np.ndarray]], schema: str, names: list[str]) -> DataFrame:
    """work(ids, unit vectors, copies, parts, whether of one part) for each unit
    and length of vectors, these being consecutive rows of sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                if t.num_rows > 1:
                    same = t.column(2)[0].as_py() == t.column(3)[0].as_py()
                    out = work(t.column(4).to_numpy(), _unit(_matrix(t.column(5), kind)), t.column(7).to_numpy(), t.column(6).to_numpy(), same)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)
                held.clear()

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(j).to_numpy() for j in range(4)])
            edge = np.r_[0, np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1, b.num_rows]
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                now = tuple(k[:, s].tolist())
                if now != last:
                    yield from flush()
                    last = now
                held.append(b.slice(s, e - s))
        yield from flush()

    unit = ["key", "size", "x", "y"]
    rows = rows.select(F.col(key).alias("key"), F.octet_length("vector").cast("long").alias("size"), "x", "y", "vec_id", "vector", "part", "copies")
    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, schema)


def _pairs_of(v: np.ndarray, part: np.ndarray, same: bool, cosine: float) -> np.ndarray:
    """Of a unit, which pairs (row, column) are linked: within one part, or
    between two."""
    near = v @ v.T >= cosine
    np.fill_diagonal(near, False)
    return near if same else near & (part[:, None] != part[None, :])


def vectors(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(v, vec_id, copies): the distinct vectors that can link, with the number
    of their exact copies, the smallest vec_id standing for them. Null and zero vectors and those with a null or
    non-finite component are left out."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    rows = embeddings.where(v.isNotNull() & ~bad & ~zero).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))


def links(distinct: DataFrame, kind: str = "<f8", cosine: float = COSINE, miss: float = MISS, meet: int = MEET) -> DataFrame:
    """Links (a, b) that connect all vectors which the filters bring together
    and whose cosine is `cosine` or more: within each unit of a direction a
    spanning forest of its exact links."""
    total = max(1, distinct.count())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1).to_pylist()
            for size in sorted({len(x) for x in v}):
                own = np.array([k for k, x in enumerate(v) if len(x) == size])
                d = size // np.dtype(kind).itemsize
                code = product_code(d, total, miss, meet, cosine)
                for at in range(0, len(own), 512):
                    some = own[at : at + 512]
                    x = _unit(_matrix(b.column(1).take(pa.array(some)), kind))
                    rows, ids = (np.concatenate(c) for c in zip(*[code.decode(x, k) for k in range(len(code.codes))], strict=True))
                    pick = pa.array(some[rows])
                    yield pa.RecordBatch.from_arrays([pa.array(ids), b.column(0).take(pick), b.column(1).take(pick)], names=["key", "vec_id", "vector"])

    def forest(ids: np.ndarray, v: np.ndarray, copies: np.ndarray, part: np.ndarray, same: bool) -> list[np.ndarray]:
        near = _pairs_of(v, part, same, cosine)
        a, b, seen = [], [], np.zeros(len(ids), bool)
        for s in np.flatnonzero(near.any(1)):
            if seen[s]:
                continue
            seen[s], queue = True, [s]
            while queue:
                k = queue.pop()
                new = np.flatnonzero(near[k] & ~seen)
                seen[new] = True
                queue.extend(new)
                a += [ids[k]] * len(new)
                b += ids[new].tolist()
        return [np.array(a, np.int64), np.array(b, np.int64)]

    dealt = distinct.select("vec_id", "vector").mapInArrow(deal, "key long, vec_id long, vector binary")
    dealt = dealt.withColumn("copies", F.lit(1).cast("long"))
    return _by_unit(_units(dealt, "key", UNIT), "key", kind, forest, "a long, b long", ["a", "b"])


def _bytes(rows: DataFrame, kind: str) -> DataFrame:
    """v as bytes of the kind of number it came in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [np.asarray(x, kind).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(v, pa.binary()), b.column(2)], names=["vec_id", "vector", "copies"])

    return rows.select("vec_id", "v", "copies").mapInArrow(run, "vec_id long, vector binary, copies long")


def near_dedup(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, miss: float = MISS, meet: int = MEET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, zero or hold a null or non-finite component link with
    nothing; so do vectors of different dimensions. Exact copies are compared
    once and counted each. A null vec_id is a row without links. Rows that
    repeat a vec_id count as vectors of their own: each counts in the others'
    links, and the id's smallest component is that of its vector. An empty table
    gives no rows; other columns are ignored whatever their names.
    """
    all_rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    whole = written(vectors(all_rows.where("vec_id is not null")), "cap-distinct")
    kind = "<f4" if dict(embeddings.dtypes)[embedding] == "array<float>" else "<f8"
    distinct = written(_bytes(whole, kind), "cap-vectors")
    found = written(links(distinct, kind, cosine, miss, meet), "cap-links")
    comp = written(connected_components(found, "cap-components").withColumnRenamed("node", "vec_id"), "cap-members")

    def count(ids: np.ndarray, v: np.ndarray, copies: np.ndarray, part: np.ndarray, same: bool) -> list[np.ndarray]:
        return [ids, np.rint(_pairs_of(v, part, same, cosine) @ copies.astype(np.float64)).astype(np.int64)]

    members = _units(distinct.join(comp, "vec_id"), "component", LEAST_UNIT)
    mates = _by_unit(members, "component", kind, count, "vec_id long, n long", ["vec_id", "n"])
    degree = mates.groupBy("vec_id").agg(F.sum("n").alias("n"))
    own = distinct.select("vec_id", "copies").join(degree, "vec_id", "left").join(comp, "vec_id", "left")
    own = own.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    by = whole.select("v", "vec_id").join(own, "vec_id").select("v", "n_links", "component_id")
    v = F.col("embedding").cast("array<double>")
    out = all_rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), v).alias("v")).join(by, "v", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

