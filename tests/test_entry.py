"""Driver contract and oracle checks (Spark vs DuckDB) at sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, norm

SF = "/root/testdata/sf0.001"
FAST = ["device_attack_normal", "parse_payload", "payload_hash", "iqr_cap", "fit_skew", "fit_iqr_bounds",
        "decode_class", "row_key", "alerts", "traffic_buckets", "containment_state", "eval_auc",
        "eval_ap", "class_downsample", "rejects", "system_stats"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert [f.name for f in df.schema.fields] == ["device_name", "total_records", "attack_count", "normal_count"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST)
def test_oracle(spark, con, key):
    sp = E.queries()[key](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[key]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert norm(sp) == norm(dk)
