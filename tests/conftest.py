import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": f"file://{base}/shared"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def duck(data):
    import duckdb

    con = duckdb.connect()
    for p in Path(data).iterdir():
        con.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return con


def same_rows(got, want):
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    order = lambda df: df[cols].astype(str).sort_values(cols).reset_index(drop=True)
    assert order(got).equals(order(want))
