"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001 here)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    """The library's own queries; those of the optional subpackage without SQL are listed in its tests."""
    from goalpost.plans import registry
    from sql_oracle import ORACLE
    assert set(registry.QUERIES) == set(ORACLE) <= set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    if key not in SQL:
        pytest.skip("no SQL: tested against brute force")
    msgs, n, _ = compare(spark, con, QUERIES[key], SQL[key], SF)
    assert not msgs, msgs
    if key in ("sample_n",):
        assert n == 20


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ranking_na_uf" in df.columns


def test_output_types_are_the_oracle_families(spark):
    """Integral outputs are bigint, floating outputs double (the contract with the SQL side)."""
    allowed = {"bigint", "double", "string", "boolean"}
    for key in ["gold_indicator_rank", "quality_report", "kpi_latest", "event_validate", "union_by_name",
                "bronze_ingest", "run_metrics"]:
        df = QUERIES[key](spark, SF)
        bad = {f.name: f.dataType.simpleString() for f in df.schema.fields
               if f.dataType.simpleString() not in allowed}
        assert not bad, (key, bad)
