"""Mixing: words counted in what is emitted, and shares of many sources."""

import random
from fractions import Fraction

from gridspark.llm import mixing

DOCS = "doc_id long, text string, source string, size string, taken int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], DOCS)


def test_words_taken_are_those_emitted(spark):
    rng = random.Random(5)
    rows = [(i % 90, " ".join("w" * rng.randint(0, 12)), rng.choice("abc")) for i in range(200)]
    rows += [(None, "a b", None), (None, "a b", None), (None, None, "a"), (7, "", "b"), (-5, "long " * 200_000, "c")]
    df = table(spark, rows)
    want = sorted((r.doc_id is None, r.doc_id, r.size, r.source_size, r.target, r.size * r.copies) for r in mixing.plan(df).collect())
    got = mixing.mixed(df).collect()
    assert sorted((r.doc_id is None, *r) for r in got) == want
    assert sum(r.taken for r in got) == sum(len((r.text or "").split()) for r in mixing.mix(df).select("text").collect())
    assert mixing.mixed(df.limit(0)).count() == 0


def test_shares_of_many_sources(spark):
    rng = random.Random(6)
    size = {f"host{i}.example": rng.choice([0, 1, 3, 1000]) + i % 7 for i in range(1500)} | {None: 40}
    sizes = spark.createDataFrame(list(size.items()), "source string, size long")
    names = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, free, level = Fraction(sum(size.values())), set(names), None
    while level is None or any(weight[s] * level > 3 * size[s] for s in free):
        free -= {s for s in free if level is not None and weight[s] * level > 3 * size[s]}
        level = (total - sum(3 * size[s] for s in set(names) - free)) / sum(weight[s] for s in free)
    got = {r.source: r for r in mixing.targets(sizes).collect()}
    assert set(got) == set(names)
    for s in names:
        assert got[s].source_size == size[s]
        assert abs(got[s].target - float(min(3 * size[s], weight[s] * level))) <= 1e-9 * float(total)
