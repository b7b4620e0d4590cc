"""Every core query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from framemill import registry
from tests.oracle import assert_same, connection, plain


@pytest.fixture(scope="module")
def con(data):
    return connection(data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, data, con, name):
    assert_same(registry.QUERIES[name](spark, data), con, registry.ORACLES[name])


@pytest.mark.parametrize("name", ["relabel_actions", "slot_assembly", "sparse_scatter", "channel_reverse", "step_pipeline", "standardise_taco_play", "standardise_bridge_orig"])
def test_zeros_keep_their_sign(spark, name):
    """The smallest tables hardly have a -0.0; the next ones have hundreds."""
    folder = os.environ.get("TEST_LARGER_SF_DIR", "/root/testdata/sf0.01")
    assert_same(registry.QUERIES[name](spark, folder), connection(folder), registry.ORACLES[name])


def test_signs_of_zero_are_compared():
    assert repr(plain(-0.0)) != repr(plain(0.0)) and repr(plain([1.0, -0.0])) != repr(plain([1.0, 0.0]))
    assert repr(plain([float("nan")])) == repr(plain([-float("nan")]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, data, name):
    assert registry.QUERIES[name](spark, data).count() >= 0


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
