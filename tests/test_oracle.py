"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from oracle import ORACLE_SQL as ORACLE
from tools.check_oracle import digest, duck
from vitrine.registry import QUERIES

SPARK_TO_DUCK = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
                 "DoubleType()": "DOUBLE", "DateType()": "DATE", "BooleanType()": "BOOLEAN"}
DUCK_NAMES = {"STRING": "VARCHAR", "NUMBER": "DOUBLE", "bool": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["periode", "annee", "mois", "jour", "chiffre_affaires"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, key):
    sdf = QUERIES[key](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(o_cols, o_rows)[0]
    o_types = dict(zip(o_cols, (str(d[1]) for d in res.description)))
    s_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    assert s_types == {c: DUCK_NAMES.get(t, t) for c, t in o_types.items()}
