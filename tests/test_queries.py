"""Every registered query against its SQL twin on the smallest data, and the rules for the sources."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.conftest import SMALL
from tidemark.checks.run import expected, oracle, rows_of, types_of

ROOT = Path(__file__).parent.parent


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    frame = driver.queries()[name](spark, SMALL)
    got = rows_of(frame)
    if name in driver.oracle_sql():
        columns, want, kinds = expected(con, driver.oracle_sql()[name])
        assert sorted(frame.columns) == columns and types_of(frame) == kinds
        assert got == want


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["k", "amt", "st", "d", "c_at", "u_at", "del"] and not frame.isEmpty()


def test_sql_is_given_only_for_registered_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_scratch_comes_from_the_session(spark):
    from tidemark.session import scratch_root

    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or scratch_root(spark).startswith(configured)


def test_no_local_checkpoints_or_row_udfs():
    for file in (ROOT / "tidemark").rglob("*.py"):
        text = file.read_text()
        assert not re.search(r"localCheckpoint|\.rdd\b|toPandas|crossJoin|F\.udf", text), file
