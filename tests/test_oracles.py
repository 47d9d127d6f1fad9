import math

import duckdb
import pytest

import __spark_entry__ as entry
from namesmith import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    clean = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(clean(v.item() if hasattr(v, "item") else v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert name == "pipeline_end_to_end"  # the one query without a twin: a row for every name, all decided
        assert len(got) == duck.execute("select count(*) from customer").fetchone()[0] == got["idx"].nunique()
        assert got["tipo"].notna().all() and got["macrosector"].str.len().gt(0).all() and got["confianza"].between(0, 100).all()
        employer = got["tipo"].isin(["EMPRESA", "PERSONA_NATURAL"])
        assert got.loc[employer, "cluster"].notna().all() and got.loc[~employer, "cluster"].isna().all()
        assert (got[employer].groupby("clave")["cluster"].nunique() == 1).all()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
