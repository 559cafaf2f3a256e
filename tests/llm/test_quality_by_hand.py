"""Importance resampling against a version in plain integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridspark.llm import quality

M = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mixed(h):
    h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & M
    return h ^ (h >> 29)


def word_hash(w):
    return mixed(sum((b + 1) * pow(BASE, k, 1 << 64) for k, b in enumerate(w)) & M)


def kind(b):
    return 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 0 if 97 <= b <= 122 or b > 127 else 3 if b in b".,;:?'\"()-" else 4


def grams(text):
    """Buckets of words, pairs of words, and pairs of shapes with the distance to an equal word."""
    out, words = [], text.encode().split()
    hashes = [word_hash(bytes(b + 32 if 65 <= b <= 90 else b for b in w)) for w in words]
    shapes = []
    for w in words:
        upper, mark = sum(kind(b) == 1 for b in w), min(3, sum(kind(b) >= 3 for b in w))
        case = 0 if upper == 0 else 1 if upper == 1 else 3 if 2 * upper >= len(w) else 2
        shapes.append((((kind(w[0]) * 5 + kind(w[-1])) * 4 + case) * 4 + mark) * 2 + any(kind(b) == 2 for b in w))
    for k, h in enumerate(hashes):
        lag = next((d for d in range(1, 7) if k >= d and hashes[k - d] == h), 0)
        before = shapes[k - 1] + 1 if k else 0
        out += [h >> 49, (mixed((hashes[k - 1] if k else 0) * 3 + h & M) >> 49) + (1 << 15), (mixed((before * 4096 + shapes[k]) * 8 + lag + 1 & M) >> 51) + (1 << 16)]
    return out


def texts(n, rng):
    pool = ["Good", "prose,", "and", "plain", "words.", "x1", "BAD$$", "e-mail", "Été", "42", "BAD$$"]
    return {i: " ".join(rng.choice(pool if i % 3 else pool[5:]) for _ in range(rng.randint(0, 30))) for i in range(n)}


@pytest.fixture
def tables(spark):
    rows = texts(90, random.Random(4))
    labels = {i: int(i % 3 > 0) for i in range(0, 90, 2)}
    docs = spark.createDataFrame([*rows.items(), (500, None)], "doc_id long, text string")
    return rows, labels, docs, spark.createDataFrame([*labels.items(), (7777, 1), (None, 1), (3, None)], "doc_id long, quality int")


def parted(labels_df):
    """The ids that fit and those that cut, by the same hash."""
    rows = labels_df.where("doc_id is not null and quality is not null").select("doc_id", F.expr(f"pmod(xxhash64(doc_id, {quality.SEED + 1}), 5)").alias("p")).collect()
    return {r.doc_id for r in rows if r.p < 4}, {r.doc_id for r in rows if r.p == 4}


def test_fit_and_weights(tables):
    rows, labels, docs, labels_df = tables
    fit, _ = parted(labels_df)
    raw, target = np.zeros(quality.N_BUCKETS), np.zeros(quality.N_BUCKETS)
    for i, t in rows.items():
        for b in grams(t):
            raw[b] += 1
            target[b] += i in fit and labels.get(i) == 1
    want = np.zeros(quality.N_BUCKETS)
    for a, b in ((0, 1 << 15), (1 << 15, 1 << 16), (1 << 16, quality.N_BUCKETS)):
        n = b - a
        for k in np.flatnonzero(raw[a:b]) + a:
            p = (raw[k] + 1) / (raw[a:b].sum() + n)
            want[k] = math.log((target[k] + n * p) / (target[a:b].sum() + n)) - math.log(p)
    got = quality.fit(docs, labels_df)
    assert np.allclose(got[raw > 0], want[raw > 0])
    scored = {r.doc_id: r.log_weight for r in quality.weights(docs, got).collect()}
    for i, t in rows.items():
        assert scored[i] == pytest.approx(sum(want[b] for b in grams(t)), abs=1e-3)
    assert scored[500] == 0.0


def test_cut_off(tables, spark):
    _, labels, _, labels_df = tables
    _, cut = parted(labels_df)
    w = {i: (5.0 if labels[i] else -5.0) + 0.01 * i for i in labels}
    scored = spark.createDataFrame([*w.items()], "doc_id long, log_weight double")
    at = quality.cut_off(scored, labels_df)
    own = [i for i in cut if i in labels]

    def balanced(x):
        good, bad = ([w[i] for i in own if labels[i] == q] for q in (1, 0))
        return sum(v >= x for v in good) / len(good) + sum(v < x for v in bad) / len(bad)

    best = max(balanced(x) for x in [-1e9, *[w[i] + 1e-6 for i in own]])
    assert balanced(at) >= best - 2 * 0.002 - 1e-9
    assert quality.cut_off(scored, labels_df.where("quality = 1")) == float("-inf")


def test_top_k_with_ties(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.randint(0, 9))) for i in range(200)] + [(None, 9.0), (7, 9.0)]
    df = spark.createDataFrame(rows, "doc_id long, gumbel_key double")
    for k in (0, 1, 37, 202, 500):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.gumbel_key) for r in quality.top_k(df, k).where("kept").collect())
        want = sorted(sorted(((i is None, i or 0, g) for i, g in rows), key=lambda x: (-x[2], x[0], x[1]))[:k])
        assert got == want


def test_a_very_long_text(spark):
    t = "Good prose, and plain words. " * 60_000
    ratio = np.random.default_rng(0).standard_normal(quality.N_BUCKETS)
    df = spark.createDataFrame([(1, t), (2, "BAD$$"), (1, t)], "doc_id long, text string")
    got = sorted((r.doc_id, round(r.log_weight, 3)) for r in quality.weights(df, ratio).collect())
    assert got[0] == got[1] and got[0][0] == 1
    want = sum(ratio.astype(np.float32)[b] for b in grams("Good prose, and plain words. " * 4)[45:60]) * 60_000
    assert abs(got[0][1] - want) < 1e-3 * 60_000
