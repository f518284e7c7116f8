from __future__ import annotations

import pytest

import __spark_entry__
from corpusloom.plans.queries import ORACLES, QUERIES
from tests.conftest import DATA, same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    same(QUERIES[name](spark, DATA), ORACLES[name])


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == 200 and df.columns[0] == "doc_id"
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_accent_fold(spark):
    from corpusloom.functions.python import folded_title

    rows = spark.createDataFrame([("Śaṅkara – Été",), (None,), ("a1!",)], "t string")
    assert [r[0] for r in rows.select(folded_title("t")).collect()] == ["sankaraete", "", "a1"]
