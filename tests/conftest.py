import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.codegen.wholeStage", "false")
         .config("spark.sql.codegen.factoryMode", "NO_CODEGEN").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def as_rows(frame):
    """A pandas frame as sorted tuples in column order by name."""
    cols = sorted(frame.columns)
    plain = frame[cols].astype(object).where(frame[cols].notna(), None)
    return cols, sorted(map(repr, plain.values.tolist()))
