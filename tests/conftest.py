import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    """A function: the rows of SQL over the Parquet tables of a scale."""
    import duckdb

    def run(sql: str, scale: str = "sf0.001"):
        con = duckdb.connect()
        con.execute("SET TimeZone = 'UTC'")
        for name in os.listdir(f"{DATA}/{scale}"):
            con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{scale}/{name}'")
        found = con.execute(sql)
        return [c[0] for c in found.description], found.fetchall()

    return run
