"""Every query against its SQL in DuckDB, and all the others for rows."""

import datetime
import decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from gridspark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return None if v != v else round(float(v), 6) + 0.0
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        return pd.Timestamp(v).date().isoformat() if v == pd.Timestamp(v).normalize() else str(v)
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, np.ndarray):
        return str(v.tolist())
    return v.item() if hasattr(v, "item") else v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)), key=str)


def close(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)) or isinstance(b, float) and isinstance(a, int):
        return abs(a - b) <= 2e-6 * max(1.0, abs(a))
    return a == b


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, db, data, name):
    cols, got = rows_of(registry.QUERIES[name](spark, data).toPandas())
    want_cols, want = rows_of(db.sql(registry.ORACLE[name]).df())
    assert cols == want_cols
    assert len(got) == len(want)
    assert all(close(a, b) for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_gives_rows(spark, data, name):
    assert registry.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["cell", "flag", "yr", "mean", "n_months"]
    assert set(e.oracle_sql()) <= set(e.queries())
