"""Every query of the library equals its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest

from granary.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and v != v:
        return None
    if isinstance(v, (list, np.ndarray)):
        return tuple(plain(x) for x in v)
    v = v.item() if isinstance(v, np.generic) else v
    return round(v, 6) if isinstance(v, float) else v


def rows(df):
    return sorted(repr(tuple(plain(v) for v in r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
