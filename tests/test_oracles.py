"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same check at sf0.01)."""

import hashlib
import json

import pandas as pd
import pytest

import __spark_entry__ as E
from tidewatch.plans.queries import registry

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k in registry()}  # the training-data queries have their own tests
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def norm(df: pd.DataFrame):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].round(6)
    rows = sorted(json.dumps([v.item() if hasattr(v, "item") else v for v in r], default=str)
                  for r in df.itertuples(index=False))
    return list(df.columns), hashlib.sha256("\n".join(rows).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) == set(registry())


def test_seed_oracle_cuts_and_merges(spark, duck, monkeypatch):
    """With short merge periods and a loose bound the recursion takes all of its branches."""
    from tidewatch.plans import oracles, queries
    monkeypatch.setitem(queries.BLOCK_QUERIES, "det_seed", ("SEED", "s", dict(delta=0.9, block=32, eps_prime=0.01, alpha=0.8, compress=50)))
    duck.execute("CREATE OR REPLACE TEMP VIEW wide AS SELECT * FROM read_parquet('/root/testdata/sf0.1/events.parquet')")
    got = queries._block_query("det_seed")(spark, "/root/testdata/sf0.1").toPandas()
    exp = duck.sql(oracles._seed_sql().replace("FROM events", "FROM wide")).df()
    assert len(got) and norm(got) == norm(exp)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF).toPandas()
    exp = duck.sql(ORACLES[key]).df()
    assert len(got) == len(exp)
    assert norm(got) == norm(exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["model_id", "axon", "drift_probability", "timestamp"]
    assert df.count() > 0
