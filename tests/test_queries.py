"""Every registered query of the library itself against its DuckDB oracle; the entry point's guard."""

import importlib
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from affilspark.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def canonical(df: pd.DataFrame) -> list:
    def value(v):
        if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
            return None
        if isinstance(v, bool) or type(v).__name__ in ("bool", "bool_"):
            return bool(v)
        return round(float(v), 9) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(repr([value(v) for v in row]) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_without_llm():
    """The entry point works where the llm folders and the pipeline are gone."""
    code = "import sys; sys.modules['affilspark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'city_best' in e.queries() and not any(k.startswith('op') and k[2].isdigit() for k in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    root = importlib.import_module("affilspark").__file__.rsplit("/", 2)[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
