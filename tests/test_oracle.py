"""Every registered query against its SQL on the smallest given tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.bindings import bind
from checks.compare import connect, differences
from checks.oracle import ORACLES
from checks.queries import QUERIES as OWN
from gondola.operators import quality
from gondola.plans.sinks import replace_days
from gondola.schema import silver_schema
from gondola.sources import tables

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(OWN) == set(ORACLES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


def test_date_filter_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "precios")
    replace_days(bind(spark, SF, "precios"), path, "precios")
    fact = tables.scan(spark, path, silver_schema("precios"))
    files = {r.lectura: r.archivos for r in quality.pruning_effect(fact, "1999-01-01").collect()}
    assert files["un_dia"] == 1 and files["completa"] >= 7


def test_table_schema_lists_every_column(spark):
    assert quality.describe_table(bind(spark, SF, "precios"), "precios").count() == 19


def test_entry(spark):
    assert entry(spark).count() > 0
