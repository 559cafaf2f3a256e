"""Weighted percentiles and histograms, state-space deltas, quantile bins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.ordering import global_cumsum
from gridspark.sources.bounded import join_bounded
from gridspark.sources.staging import written


def cell_volume(value: Column, dz: float, dy: float, dx: float) -> Column:
    """Volume of a cell, 0 where the value is missing."""
    return F.when(value.isNull(), 0.0).otherwise(dz * dy * dx)


#: Distinct values of a key that one task may put in order, and splitters a round.
MOST_ORDERED, SPLITTERS = 100_000, 63


def narrowed(sums: DataFrame, keys: Sequence[str], value: str, most: int = MOST_ORDERED) -> DataFrame:
    """Distributed selection. sums has, per key, distinct values with their weight
    __w, and __need, the cumulated weight that is looked for. Of each key at most
    `most` values are left, among them the first at which the weight cumulated
    in order reaches __need; __before is the weight of all values below them.

    Each round asks every key that has more values for splitters at even ranks
    (a mergeable sketch), sums the weights between them with map-side combining,
    and keeps the stretch in which __need is reached. Splitters follow the ranks,
    so that outliers don't matter and a round leaves about one value in 64.
    Rounds are written; the driver sees whether a key is left.
    """
    keys = list(keys)
    rows, parts = sums.withColumn("__before", F.lit(0.0)), []
    ranks = [(k + 1) / (SPLITTERS + 1) for k in range(SPLITTERS)]
    while True:
        many = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx(value, ranks, 10_000).alias("__s")).where(F.col("__n") > most)
        many = written(many.select(*keys, "__s"), "percentile-splitters")
        if many.isEmpty():
            break
        parts.append(rows.join(many, keys, "left_anti"))
        j = join_bounded(rows, many, keys).withColumn("__b", F.size(F.filter("__s", lambda x: x < F.col(value)))).drop("__s")
        h = j.groupBy(*keys, "__b").agg(F.sum("__w").alias("__h"), F.first("__need").alias("__need"), F.first("__before").alias("__low"))
        upto = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
        h = h.withColumn("__c", F.col("__low") + F.sum("__h").over(upto)).where(F.col("__c") >= F.col("__need"))
        at = written(h.groupBy(*keys).agg(F.min(F.struct("__b", (F.col("__c") - F.col("__h")).alias("before"))).alias("__at")), "percentile-stretch")
        rows = join_bounded(j, at, keys).where(F.col("__b") == F.col("__at.__b"))
        rows = written(rows.select(*keys, value, "__w", "__need", F.col("__at.before").alias("__before")), "percentile-values")
    for part in parts:
        rows = rows.unionByName(part)
    return rows


def _reached(d: DataFrame, keys: Sequence[str], value: str, needs: Callable[[Column], Column], most: int) -> DataFrame:
    """(keys, __need, value): per key and each weight that needs() makes of its
    total, the least value at which the weight cumulated in order reaches it."""
    if d.limit(most + 1).count() <= most:  # no key has more: totals and order in one pass
        total = F.sum("__w").over(Window.partitionBy(*keys))
        k = d.withColumn("__all", needs(total)).select(*keys, value, "__w", F.explode("__all").alias("__need"), F.lit(0.0).alias("__before"))
    else:
        n = written(d.groupBy(*keys).agg(F.sum("__w").alias("__n")), "percentile-needs")
        n = n.select(*keys, F.explode(needs(F.col("__n"))).alias("__need"))
        both = join_bounded(d, n, list(keys)).withColumn("__side", F.col("__need"))
        k = narrowed(both, [*keys, "__side"], value, most).drop("__side")
    upto = Window.partitionBy(*keys, "__need").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    k = k.withColumn("__c", F.col("__before") + F.sum("__w").over(upto)).where(F.col("__c") >= F.col("__need"))
    return k.groupBy(*keys, "__need").agg(F.min(value).alias(value))


def weighted_percentile(df: DataFrame, keys: Sequence[str], value: str, weight: str, q: float, out: str = "p", most: int = MOST_ORDERED) -> DataFrame:
    """Inverted-CDF percentile: the least value whose cumulated weight reaches q
    of the total.

    Exact, however large a group is and whatever its values are: weights are
    summed to distinct values (with map-side combining), which are narrowed() to
    at most `most` a key before they are put in order. Rows whose key is null
    are left out.
    """
    d = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).na.drop(subset=list(keys)).groupBy(*keys, value).agg(F.sum(weight).cast("double").alias("__w"))
    found = _reached(written(d, "percentile-values"), keys, value, lambda n: F.array(n * (q * (1 - 1e-12))), most)
    return found.select(*keys, F.col(value).alias(out))


def medians(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", most: int = MOST_ORDERED) -> DataFrame:
    """Medians by key, halfway between the two values in the middle; a group's
    values meet in no task and no aggregation buffer. Keys without values and
    rows whose key is null are left out."""
    d = df.where(F.col(value).isNotNull()).na.drop(subset=list(keys)).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").cast("double").alias("__w"))
    # the two middle ranks from 1: floor and ceiling of (n + 1) / 2
    middle = lambda n: F.array_distinct(F.array(*[f((n + 1) / 2).cast("double") for f in (F.floor, F.ceil)]))
    return _reached(written(d, "median-values"), keys, "__v", middle, most).groupBy(*keys).agg(F.avg("__v").alias(out))


def percentiles(df: DataFrame, value: str, qs: Sequence[float]) -> DataFrame:
    """One row with a column p: the exact percentiles of a whole table, linear
    between neighbours in order; null without rows. Values are counted first
    (with map-side combining) and put in order by a range sort, so that no task
    and no aggregation holds them all."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    upto = global_cumsum(counts, ["v"], "n")
    total = upto.agg(F.max("upto")).first()[0] or 0

    def at(rank: int) -> Column:
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("v")))

    places = [max(0, total - 1) * q for q in qs]
    ends = [(at(int(x)), at(min(int(x) + 1, max(0, total - 1)))) for x in places]
    return upto.agg(F.array(*[a + (b - a) * (x - int(x)) for x, (a, b) in zip(places, ends, strict=True)]).alias("p"))


def histogram_bin(value: Column, edges: Sequence[float]) -> Column:
    """Number from 0 of the bin on given edges: half-open, the last one closed;
    null outside. The edges are literals of the plan."""
    out = F.when(value == edges[-1], len(edges) - 2)
    for k in range(len(edges) - 1):
        out = out.when((value >= edges[k]) & (value < edges[k + 1]), k)
    return out


def weighted_histogram(df: DataFrame, keys: Sequence[str], value: str, weight: str, edges: Sequence[float]) -> DataFrame:
    binned = df.withColumn("bin", histogram_bin(F.col(value), edges)).where("bin is not null")
    return binned.groupBy(*keys, "bin").agg(F.sum(weight).alias("weight"))


def ranges(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    aggs = [f(v).alias(f"{v}_{n}") for v in values for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return df.groupBy(*keys).agg(*aggs)


def equal_bin(value: Column, low: Column, high: Column, n: int) -> Column:
    """Histogram rule: floor(n * share), the top edge in the last bin."""
    share = F.when(high > low, (value - low) / (high - low)).otherwise(0.0)
    return F.least(F.lit(n - 1), F.floor(n * share)).cast("int")


def lookup_bin(value: Column, low: Column, high: Column, n: int) -> Column:
    """Lookup rule: trunc((n - 1) * share), clamped to 0..n-1."""
    share = F.when(high > low, (value - low) / (high - low)).otherwise(0.0)
    return F.least(F.lit(n - 1), F.greatest(F.lit(0), ((n - 1) * share).cast("int"))).cast("int")


def histogram_2d(df: DataFrame, key: str, s: str, t: str, weight: str, n: int) -> DataFrame:
    """Weighted counts in n x n equal bins between each key's extremes."""
    j = join_bounded(df, written(ranges(df, [key], [s, t]), "ranges"), key)
    cols = [equal_bin(F.col(v), F.col(f"{v}_lo"), F.col(f"{v}_hi"), n).alias(f"{v}_bin") for v in (s, t)]
    return j.select(key, *cols, F.col(weight).alias("__w")).groupBy(key, f"{s}_bin", f"{t}_bin").agg(F.sum("__w").alias("weight"))


def histogram_edges(df: DataFrame, key: str, s: str, t: str, n: int) -> DataFrame:
    """The n + 1 edges of histogram_2d, by key and number k."""
    r = ranges(df, [key], [s, t]).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n))))
    return r.select(key, "k", *[(F.col(f"{v}_lo") + (F.col(f"{v}_hi") - F.col(f"{v}_lo")) * F.col("k") / n).alias(f"{v}_edge") for v in (s, t)])


def state_delta(df: DataFrame, key: str, s: str, t: str, volume: str, delta: str, n: int) -> DataFrame:
    """Volume-weighted mean change of each bin of the reference state; a missing
    change makes its bin missing."""
    j = join_bounded(df, written(ranges(df, [key], [s, t]), "ranges"), key)
    cols = [equal_bin(F.col(v), F.col(f"{v}_lo"), F.col(f"{v}_hi"), n).alias(f"{v}_bin") for v in (s, t)]
    g = j.select(key, *cols, F.col(volume).alias("__w"), F.col(delta).alias("__d")).groupBy(key, f"{s}_bin", f"{t}_bin")
    out = g.agg(F.sum(F.col("__w") * F.col("__d")).alias("__x"), F.sum("__w").alias("__t"), F.count_if(F.col("__d").isNull()).alias("__m"))
    return out.select(key, f"{s}_bin", f"{t}_bin", F.when(F.col("__m") == 0, F.col("__x") / F.nullif("__t", F.lit(0.0))).alias("delta"))


def apply_delta(df: DataFrame, deltas: DataFrame, key: str, s: str, t: str, n: int, out: str = "changed", bounds: DataFrame | None = None) -> DataFrame:
    """Add to t the delta of the bin that (s, t) looks up, by key; bins lie
    between the extremes of df, or those of a table of bounds."""
    j = join_bounded(df, written(ranges(df, [key], [s, t]) if bounds is None else bounds, "ranges"), key)
    for v in (s, t):
        j = j.withColumn(f"{v}_bin", lookup_bin(F.col(v), F.col(f"{v}_lo"), F.col(f"{v}_hi"), n))
    j = j.join(deltas, [key, f"{s}_bin", f"{t}_bin"], "left")
    return j.withColumn(out, F.col(t) + F.col("delta")).drop(f"{s}_lo", f"{s}_hi", f"{t}_lo", f"{t}_hi")


def corrected_bounds(model: DataFrame, reference: DataFrame, key: str, s: str, t: str, weight: str, edges: Sequence[float], q: float = 0.99) -> DataFrame:
    """The extremes of the model's state space moved to the reference's: salinity
    by its best scale about the percentile q, temperature by its scale about
    the minimum. By key: s_lo, s_hi, t_lo, t_hi."""
    r = ranges(model, [key], [s, t])
    scale = salinity_scale(model, reference, key, s, weight, edges, q).select(key, F.col("scale").alias("cs"))
    pm, pr = (weighted_percentile(d, [key], s, weight, q, name) for d, name in ((model, "pm"), (reference, "pr")))
    heat = temperature_scale(model, reference, key, t, weight, q).withColumnRenamed("scale", "ct")
    j = r.join(scale, key).join(pm, key).join(pr, key).join(heat, key)
    salt = [(F.col("cs") * (F.col(f"{s}_{e}") - F.col("pm")) + F.col("pr")).alias(f"{s}_{e}") for e in ("lo", "hi")]
    warm = [(F.col("ct") * (F.col(f"{t}_{e}") - F.col("m_min")) + F.col("r_min")).alias(f"{t}_{e}") for e in ("lo", "hi")]
    return j.select(key, *salt, *warm)


def salinity_scale(model: DataFrame, reference: DataFrame, key: str, value: str, weight: str, edges: Sequence[float], q: float = 0.99) -> DataFrame:
    """Per key the scale c of 0.5..1.4 whose histogram of c * (S - P99 of the
    model) + P99 of the reference is nearest to the reference's (ties: the
    smaller), and its distance."""
    p = weighted_percentile(model, [key], value, weight, q, "pm").join(weighted_percentile(reference, [key], value, weight, q, "pr"), key)

    def shares(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        h = weighted_histogram(df, keys, "__x", weight, edges)
        total = F.sum("weight").over(Window.partitionBy(*keys))
        return h.select(*keys, "bin", (F.col("weight") / total).alias(name))

    scales = F.explode(F.array(*[F.lit(k / 10) for k in range(5, 15)]))
    tried = model.join(p, key).withColumn("scale", scales).withColumn("__x", F.col("scale") * (F.col(value) - F.col("pm")) + F.col("pr"))
    ref = shares(reference.withColumn("__x", F.col(value)), [key], "g")
    grid = p.select(key).withColumn("scale", scales).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(len(edges) - 2))))
    both = grid.join(shares(tried, [key, "scale"], "h"), [key, "scale", "bin"], "left").join(ref, [key, "bin"], "left")
    diff = F.coalesce("h", F.lit(0.0)) - F.coalesce("g", F.lit(0.0))
    d = both.groupBy(key, "scale").agg(F.sqrt(F.sum(diff * diff)).alias("distance"))
    d = d.groupBy(key).agg(F.min(F.struct(F.round("distance", 9).alias("distance"), "scale")).alias("s"))
    return d.select(key, "s.scale", "s.distance")


def temperature_scale(model: DataFrame, reference: DataFrame, key: str, value: str, weight: str, q: float = 0.99) -> DataFrame:
    """Per key P99 of (T - Tmin) of the reference over that of the model."""

    def spread(df: DataFrame, name: str) -> DataFrame:
        low = df.groupBy(key).agg(F.min(value).alias("__lo"))
        return weighted_percentile(df, [key], value, weight, q, "__p").join(low, key).select(key, (F.col("__p") - F.col("__lo")).alias(name), F.col("__lo").alias(f"{name}_min"))

    return spread(model, "m").join(spread(reference, "r"), key).select(key, (F.col("r") / F.nullif("m", F.lit(0.0))).alias("scale"), "m_min", "r_min")


def quantile_bins(df: DataFrame, value: str, n: int, out: str = "bin") -> DataFrame:
    """Bin 0 for zeros, 1..n of equal counts for the others; the n - 1 inner
    edges are exact percentiles, n numbers that go back into the plan."""
    edges = percentiles(df.where(F.col(value) > 0), value, [k / n for k in range(1, n)])
    j = df.crossJoin(F.broadcast(edges))  # one row by construction
    number = F.size(F.filter("p", lambda e: e < F.col(value))) + 1
    return j.withColumn(out, F.when(F.col(value) > 0, number).when(F.col(value) == 0, 0)).drop("p")
