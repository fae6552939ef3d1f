"""Every query with an oracle equals its DuckDB SQL (row count, columns, values)."""
import hashlib
import os

import duckdb
import pandas as pd
import pytest

from conftest import SF001, needs

import __spark_entry__ as E
from verdant.sources.tables import TABLES

NAMES = sorted(E.oracle_sql())


def _txt(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return ""
    if isinstance(v, float):
        return "" if v != v else repr(float(v))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _digest(pdf):
    pdf = pdf[sorted(pdf.columns)]
    rows = sorted("|".join(_txt(v) for v in r) for r in pdf.astype(object).itertuples(index=False))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@needs(SF001)
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    made = E.queries()[name](spark, SF001)
    got = made.toPandas()
    for c, t in made.dtypes:
        if t == "bigint":  # pandas turns whole numbers beside nulls into floats
            got[c] = got[c].astype("Int64")
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _digest(got) == _digest(exp)


@needs(SF001)
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "crop_type" in df.columns


def test_every_oracle_has_a_query():
    from verdant.plans import oracle
    assert set(oracle.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60
