"""Every registered query against its SQL, in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as e

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = {k: v for k, v in e.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(x):
        if x is None or (not isinstance(x, (list, dict)) and pd.isna(x)):
            return ""
        return f"{round(float(x), 5) + 0.0!r}" if isinstance(x, float) or hasattr(x, "dtype") else str(x)

    cols = [df[c].astype(float) if df[c].dtype.kind in "iu" else df[c] for c in sorted(df.columns)]
    return sorted(tuple(map(value, row)) for row in zip(*cols, strict=True))


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    got, want = e.queries()[name](spark, FOLDER).toPandas(), duck.sql(OWN[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got = got.astype({c: "float64" for c in got.columns if got[c].dtype.kind in "iu"})
    want = want.astype({c: "float64" for c in want.columns if want[c].dtype.kind in "iu"})
    assert plain(got) == plain(want)
