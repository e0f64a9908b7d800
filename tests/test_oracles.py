"""Every registered query against its SQL, over the whole of the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = check.oracle_connection(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, sf_dir, name):
    outcome = check.compare(spark, duck, name, sf_dir)
    assert outcome.startswith(("ok: ", "rows only: ")), outcome
    assert not outcome.endswith(": 0") or name in {"no_telemetry_alert_isfirst_5m"}, "an empty result checks nothing"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 83
