"""Every registered query against its DuckDB oracle on the smallest tables."""
import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SPARK_FAMILY = {"int": "int32", "bigint": "int64", "double": "float64", "string": "string",
                "boolean": "bool", "date": "date", "timestamp_ntz": "timestamp"}
DUCK_FAMILY = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string",
               "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
               }
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from csvforge.plans.queries import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    from tools.oracle_check import digest
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {f.name: SPARK_FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema}
    duck_types = {c: DUCK_FAMILY.get(str(t), str(t)) for c, t in zip(ocols, [d[1] for d in res.description])}
    assert spark_types == duck_types
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
