from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from checks import inputs
from leadloom.session import tune

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def codes(spark):
    return inputs.table(spark, SF, "response_codes")


@pytest.fixture(scope="session")
def lead_catalogue(spark):
    return inputs.catalogue(spark, SF)


def rows(df, *columns):
    """Rows as sorted tuples."""
    found = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in found), key=repr)


def mapping(df, key, *values):
    """Rows as a dict by key."""
    return {
        r[0]: (tuple(r)[1:] if len(values) > 1 else r[1]) for r in df.select(key, *values).collect()
    }
