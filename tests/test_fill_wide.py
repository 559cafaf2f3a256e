"""Nearest fills reach across holes of any width."""

import pytest

from gridspark.operators import fill, labels


@pytest.mark.parametrize("width", [3, 90, 400])
def test_wide_hole(spark, width):
    have = {(0, 0): 5, (0, width + 1): 7, (2, width + 1): 8}
    rows = [(i, j, have.get((j, i))) for j in range(3) for i in range(width + 2)]
    want = {(j, i): have[min(have, key=lambda s: ((s[0] - j) ** 2 + (s[1] - i) ** 2, s))] for i, j, _ in rows}
    df = spark.createDataFrame([(*r, True) for r in rows], "i int, j int, v int, inside boolean")
    assert {(r.j, r.i): r.v for r in fill.fill_nearest(df, "v", "inside").collect()} == want
    g = spark.createDataFrame([(i, j, -1 if v is None else v) for i, j, v in rows], "i int, j int, label int")
    assert {(r.j, r.i): r.label for r in labels.extend_nearest(g, "label").collect()} == want
