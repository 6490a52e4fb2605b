"""Every registered query against its SQL oracle."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from millrace import catalog

FOLDER = f"/root/testdata/sf{os.environ.get('MILLRACE_SF', '0.001')}"
#: At the smallest scale all ten suppliers are known already; these need more of them.
LARGER = {"erp_partners", "material_partners"}
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def folders():
    larger = FOLDER.replace("sf0.001", "sf0.01")
    return {folder: duck(folder) for folder in (FOLDER, larger)}, larger


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, folders, name):
    connections, larger = folders
    folder = larger if name in LARGER else FOLDER
    assert compare(QUERIES[name](spark, folder), connections[folder], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
