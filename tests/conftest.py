from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def same(df, sql: str, folder: str = DATA) -> None:
    """A frame and its SQL give the same rows, by column name, in any order."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(folder):
        path = f"{folder}/{f}"
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    got = [r.asDict() for r in df.collect()]
    found = con.sql(sql)
    want = [dict(zip(found.columns, r)) for r in found.fetchall()]
    assert sorted(df.columns) == sorted(found.columns)
    key = lambda r: str([(k, float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v) for k, v in sorted(r.items())])
    assert sorted(map(key, got)) == sorted(map(key, want))
