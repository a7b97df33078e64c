"""Registered corpus queries against their SQL twins."""

from __future__ import annotations

import os

import compare
import pytest

from lakeworks.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLES[name]) is None


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
