"""Calibration: optimal offsets, objectives over random draws, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.distributions import medians, percentiles
from gridspark.sources.bounded import join_bounded
from gridspark.sources.staging import written

#: Predictions up to which all are packed into one row (8 bytes each).
MOST_PREDICTIONS = 1_000_000


def quadratic_melt(k: Column, forcing: Column, salinity_factor: Column | float = 1.0, slope: Column | float = 1.0) -> Column:
    """Quadratic in the thermal forcing."""
    return k * salinity_factor * slope * forcing * F.abs(forcing)


def salinity_factor(s0: float, f: float, beta: float = 7.7e-4, c_po: float = 3974.0, latent: float = 3.34e5, g: float = 9.81) -> float:
    return c_po / latent * beta * (g / (2 * abs(f))) * s0


def sweep(df: DataFrame, name: str, first: float, step: float, n: int) -> DataFrame:
    """df for each of n evenly spaced parameters."""
    return df.withColumn(name, F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.lit(first) + k * F.lit(step))))


def optimal_offset(sums: DataFrame, targets: DataFrame, keys: Sequence[str], zone: str, offset: str, value: str, target: str) -> DataFrame:
    """Per keys and zone the offset whose sum is nearest to the target (ties: the
    smallest; sums are compared to nine decimals), and what is left."""
    d = F.abs(F.col(value) - F.col(target))
    best = sums.join(targets, zone).groupBy(*keys, zone).agg(F.min(F.struct(F.round(d, 9).alias("r"), F.col(offset).alias("offset"), d.alias("residual"))).alias("s"))
    return best.select(*keys, zone, F.col("s.offset").alias("offset"), F.col("s.residual").alias("residual"))


def constrained(df: DataFrame, keys: Sequence[str], box: str, value: str) -> DataFrame:
    """Keys whose sum over box 1 is positive and above that over box 2."""
    one, two = (F.coalesce(F.sum(F.when(F.col(box) == b, F.col(value))), F.lit(0.0)) for b in (1, 2))
    return df.groupBy(*keys).agg(one.alias("box1"), two.alias("box2")).where("box1 > 0 and box1 > box2")


def sensitivity(means: DataFrame, optima: DataFrame, keys: Sequence[str], offset: str, value: str, step: float = 1.0) -> DataFrame:
    """Mean at the optimum plus a step minus that at it; where that is beyond the
    axis, half a step back instead, over half a step."""
    at = means.select(*keys, F.round(offset, 6).alias("__o"), F.col(value).alias("__v"))
    top = means.agg(F.max(offset).alias("__top"))
    o = optima.crossJoin(F.broadcast(top)).withColumn("__up", F.col("offset") + step <= F.col("__top") + 1e-9)  # one row by construction
    o = o.withColumns({"__a": F.round("offset", 6), "__b": F.round(F.when(F.col("__up"), F.col("offset") + step).otherwise(F.col("offset") - step / 2), 6)})
    a = at.withColumnsRenamed({"__o": "__a", "__v": "__va"})
    b = at.withColumnsRenamed({"__o": "__b", "__v": "__vb"})
    j = o.join(a, [*keys, "__a"]).join(b, [*keys, "__b"])
    s = F.when(F.col("__up"), (F.col("__vb") - F.col("__va")) / step).otherwise((F.col("__va") - F.col("__vb")) / (step / 2))
    return j.select(*keys, "offset", s.alias("sensitivity"))


def mean_absolute_error(predicted: Column, observed: Column, weight: Column | None = None, skipna: bool = True) -> Column:
    """Of a group; skipna False: null if any is missing."""
    d = F.abs((predicted - observed) * (weight if weight is not None else 1.0))
    return F.avg(d) if skipna else F.when(F.count(d) == F.count("*"), F.avg(d))


def uniform(seed: str, name: str, key: Column | None = None) -> Column:
    """A number in (0, 1) hashed from the columns sample and key: reruns and
    retried tasks agree."""
    key = F.col("key") if key is None else key
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit(name), F.col("sample").cast("string"), key)), 1, 13), 16, 10)
    return (h.cast("double") + 0.5) / float(1 << 52)


def _normal(seed: str, key: Column | None = None) -> Column:
    return F.sqrt(-2 * F.log(uniform(seed, "a", key))) * F.cos(uniform(seed, "b", key) * 6.283185307179586)


def draws(df: DataFrame, samples: int, mean: str, sigma: str, seed: str = "draw") -> DataFrame:
    """df times samples 1..n, each with a weight in (0, 1) and a value drawn from
    N(mean, sigma) by Box-Muller. key: a string column."""
    out = df.withColumn("sample", F.explode(F.sequence(F.lit(1), F.lit(samples))))
    return out.withColumns({"weight": uniform(seed, "w"), "drawn": F.col(mean) + F.col(sigma) * _normal(seed)})


def objective(predicted: DataFrame, drawn: DataFrame, params: Sequence[str], strict: Sequence[int] = (1, 2), seed: str = "draw") -> DataFrame:
    """Per sample and parameters the sum over terms of the weighted mean absolute
    errors, each normalised by its median over the parameters plus 1e-6 and
    times a share in (0, 1) drawn for the sample.

    predicted: (term, key, params, x); drawn: (term, key, sample, weight, drawn),
    keys being unique over terms. A missing prediction voids a strict term and
    is passed over in the others; parameters that lack a term are left out.
    """
    j = join_bounded(predicted, drawn.select("term", "key", "sample", "weight", "drawn"), ["term", "key"])
    skip = mean_absolute_error(F.col("x"), F.col("drawn"), F.col("weight"))
    whole = mean_absolute_error(F.col("x"), F.col("drawn"), F.col("weight"), skipna=False)
    e = j.groupBy("sample", "term", *params).agg(F.when(F.col("term").isin(*strict), whole).otherwise(skip).alias("e"))
    median = F.percentile("e", F.lit(0.5)).over(Window.partitionBy("sample", "term"))
    e = e.withColumn("key", F.col("term").cast("string")).withColumn("e", uniform(seed, "t") * F.col("e") / (median + 1e-6))
    terms = predicted.select("term").distinct().count()
    out = e.groupBy("sample", *params).agg(F.sum("e").alias("objective"), F.count("e").alias("__n"))
    return out.where(F.col("__n") == terms).drop("__n")


def matrices(predicted: DataFrame, keys: DataFrame, params: Sequence[str], strict: Sequence[int] = (1, 2)) -> DataFrame:
    """Predictions packed into one row: `ps`, all parameters in order, `terms`, how
    many terms there are, and `ts`, per term that has keys its keys (key, mean, sigma, fixed weight or null) and per parameters
    a row of predictions in the keys' order, null where a term lacks them.

    predicted: (term, key, params, x), once each; keys: (term, key, mean, sigma,
    fixed). For predictions of a checked number only, which bounds the keys that
    are broadcast, too.
    """
    p = F.struct(*params)
    known = keys.select("term", "key", F.lit(True).alias("known"))
    x = predicted.join(F.broadcast(known), ["term", "key"]).groupBy("term", p.alias("p")).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "x"))).alias("x"), F.count("x").alias("n"), F.bool_or(F.col("x").isNull()).alias("missing")
    )
    own = keys.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("key", "mean", "sigma", "fixed"))).alias("keys"))
    x = x.join(F.broadcast(own), "term").select(
        "term", "keys", "p", F.when(~(F.col("term").isin(*strict) & F.col("missing")), F.struct("n", F.transform("keys", lambda k: F.try_element_at("x", k["key"])).alias("x"))).alias("row")
    )
    ts = x.groupBy("term").agg(F.first("keys").alias("keys"), F.map_from_entries(F.collect_list(F.struct("p", "row"))).alias("rows"))
    ts = ts.agg(F.array_sort(F.collect_list(F.struct("term", "keys", F.map_entries("rows").alias("rows")))).alias("ts"))
    ps = F.array_sort(F.array_distinct(F.flatten(F.transform("ts", lambda t: t["rows"]["key"]))))
    ts = ts.withColumn("ps", ps)
    at = lambda t: F.transform("ps", lambda p: F.try_element_at(F.map_from_entries(t["rows"]), p))
    ts = ts.select("ps", F.transform("ts", lambda t: F.struct(t["term"].alias("term"), t["keys"].alias("keys"), at(t).alias("rows"))).alias("ts"))
    return ts.join(F.broadcast(predicted.agg(F.countDistinct("term").alias("terms"))))  # one row each


def _median(values: Column) -> Column:
    """Of the values of an array that are not null."""
    s = F.array_sort(F.filter(values, lambda v: v.isNotNull()))
    n = F.size(s)
    return (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.ceil((n - 1) / 2).cast("int"))) * 0.5


def objectives_in_rows(matrix: DataFrame, samples: int, seed: str = "draw") -> DataFrame:
    """(sample, ps, objectives): objective() for samples 1..n of draws(), one row
    a sample, its draws and errors being arrays: no cube of samples, parameters
    and keys is built and nothing is shuffled."""
    spark = matrix.sparkSession
    rows = spark.range(1, samples + 1).select(F.col("id").cast("int").alias("sample")).join(F.broadcast(matrix))  # one row by construction
    drawn = lambda k: F.struct(F.coalesce(k["fixed"], uniform(seed, "w", k["key"])).alias("weight"), (k["mean"] + k["sigma"] * _normal(seed, k["key"])).alias("drawn"))
    rows = rows.withColumn("draws", F.transform("ts", lambda t: F.transform(t["keys"], drawn)))

    def errors(t: Column, draws: Column) -> Column:
        def mean(row: Column) -> Column:
            d = F.zip_with(row["x"], draws, lambda x, d: F.coalesce(F.abs((x - d["drawn"]) * d["weight"]), F.lit(0.0)))
            return F.when(row["n"] > 0, F.aggregate(d, F.lit(0.0), lambda a, v: a + v) / row["n"])

        return F.struct(F.transform(t["rows"], mean).alias("e"), uniform(seed, "t", t["term"].cast("string")).alias("share"))

    rows = rows.select("sample", "ps", "terms", F.zip_with("ts", "draws", errors).alias("es"))
    rows = rows.withColumn("es", F.transform("es", lambda t: F.struct(t["e"].alias("e"), t["share"].alias("share"), (_median(t["e"]) + 1e-6).alias("by"))))
    rows = rows.select("sample", "ps", "terms", F.transform("es", lambda t: F.transform(t["e"], lambda v: t["share"] * v / t["by"])).alias("es"))
    total = F.aggregate(F.slice("es", F.lit(2), F.size("es")), F.get("es", F.lit(0)), lambda a, e: F.zip_with(a, e, lambda x, y: x + y))
    # a term without keys has no errors, so that no parameters have all terms
    whole = F.transform(total, lambda o: F.when(F.size("es") == F.col("terms"), o))
    return rows.select("sample", "ps", whole.alias("objectives"))


def best_of_samples(predicted: DataFrame, keys: DataFrame, samples: int, params: Sequence[str], strict: Sequence[int] = (1, 2), seed: str = "draw", most: int = MOST_PREDICTIONS) -> DataFrame:
    """(sample, params, objective): best_parameters() of objective() for samples
    1..n. Up to `most` predictions are packed into one row that meets each sample
    once; beyond that draws and predictions are joined as long tables.

    keys: (term, key, mean, sigma, fixed); where fixed is not null it is the
    weight. predicted is read several times, so it should be a written table.
    """
    if predicted.limit(most + 1).count() > most:
        drawn = draws(keys, samples, "mean", "sigma", seed).withColumn("weight", F.coalesce("fixed", "weight"))
        return best_parameters(objective(predicted, drawn, params, strict, seed), params)
    rows = objectives_in_rows(written(matrices(predicted, keys, params, strict), "matrices"), samples, seed)
    found = F.zip_with("objectives", "ps", lambda o, p: F.struct(F.round(o, 9).alias("objective"), *[p[c].alias(c) for c in params]))
    best = rows.select("sample", F.array_min(F.filter(found, lambda x: x["objective"].isNotNull())).alias("s")).where("s is not null")
    return best.select("sample", *[F.col(f"s.{c}").alias(c) for c in params], "s.objective")


def best_parameters(objectives: DataFrame, params: Sequence[str]) -> DataFrame:
    """Per sample the parameters of the least objective, to nine decimals (ties:
    the smallest)."""
    best = objectives.groupBy("sample").agg(F.min(F.struct(F.round("objective", 9).alias("objective"), *params)).alias("s"))
    return best.select("sample", *[F.col(f"s.{p}").alias(p) for p in params], "s.objective")


def summary(chosen: DataFrame, name: str) -> DataFrame:
    """Percentiles 5, 50 and 95 and the mode (ties: the smallest) of a parameter."""
    p = percentiles(chosen, name, [0.05, 0.5, 0.95]).select(*[F.get("p", F.lit(k)).alias(f"p{q}") for k, q in enumerate((5, 50, 95))])
    mode = chosen.groupBy(name).count().agg(F.max_by(name, F.struct("count", -F.col(name))).alias("mode"))
    return p.crossJoin(mode)  # one row each


def edge_histogram(chosen: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """How often each value of a parameter's axis was chosen: bins end 1e-7 above
    the values, the first one begins at half the least. values has one row per
    value of the axis."""
    w = Window.orderBy(name)  # the axis of one parameter
    bins = values.select(name, F.coalesce(F.lag(name).over(w) + 1e-7, F.col(name) * 0.5).alias("low"), (F.col(name) + 1e-7).alias("high"))
    n = chosen.groupBy(F.col(name).alias("__x")).agg(F.count("*").alias("__n"))
    j = bins.join(n, (F.col("__x") >= F.col("low")) & (F.col("__x") < F.col("high")), "left")
    return j.groupBy("low", "high").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))


def slice_percentile(chosen: DataFrame, given: str, name: str, q: float) -> DataFrame:
    """For each value of one parameter the least value of another at which the
    counts of its slice add up to the share q."""
    n = chosen.groupBy(given, name).agg(F.count("*").alias("n"))
    w = Window.partitionBy(given)
    n = n.withColumns({"upto": F.sum("n").over(w.orderBy(name)), "all": F.sum("n").over(w)})
    return n.where(F.col("upto") >= F.col("all") * q).groupBy(given).agg(F.min(name).alias(name))


def incomplete_members(optima: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Whether a member lacks an optimum in any zone."""
    return optima.groupBy(*keys).agg(F.bool_or(F.col(value).isNull()).alias("invalid"))


def member_weights(df: DataFrame, key: str, value: str) -> DataFrame:
    """Weights by key: the median over the median of all."""
    whole = percentiles(df, value, [0.5]).select(F.get("p", F.lit(0)).alias("__m"))
    return medians(df, [key], value).crossJoin(F.broadcast(whole)).select(key, (F.col("median") / F.col("__m")).alias("weight"))  # one row by construction


def region_weights(df: DataFrame, keys: Sequence[str], counts: Column) -> DataFrame:
    """1 for the regions that count, 0 for all others, by key."""
    return df.select(*keys, F.when(counts, 1.0).otherwise(0.0).alias("weight")).groupBy(*keys).agg(F.max("weight").alias("weight"))
