import uuid

import pytest

from tidemark.session import build_session, scratch_dir
from tidemark.tables import create_table, with_batch

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidemark-tests", master="local[4]", shuffle_partitions=4,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
           "spark.sql.session.timeZone": "America/New_York", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return lambda label="t": scratch_dir(spark, label)


@pytest.fixture
def make_table(spark, folder):
    def make(schema, **layout):
        return create_table(spark, f"t_{uuid.uuid4().hex[:10]}", schema, folder(), **layout)

    return make


@pytest.fixture
def make_history(make_table):
    return lambda schema: make_table(with_batch(schema), partition_by=("batch_id",))


def explained(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fields(text: str):
    """A schema from ``name type`` pairs, without needing a session."""
    from pyspark.sql import types as T

    kinds = {"string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType, "date": T.DateType,
             "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType, "boolean": T.BooleanType}
    return T.StructType([T.StructField(n, kinds[k]()) for n, k in (p.split() for p in text.split(","))])
