"""Corpus queries that SQL can express, against their statements; the others return what they promise."""

import pytest

import __spark_entry__ as contract
from beaconry.llm.queries import ORACLES, QUERIES
from tests.oracle import DATA, differences, oracle

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


def test_all_are_registered():
    names = [n for n in contract.queries() if n == "pipeline" or n.startswith("op")]
    assert {n.split("_")[0] for n in names if n != "pipeline"} >= {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    assert differences(spark, con, name, FOLDER) == []
