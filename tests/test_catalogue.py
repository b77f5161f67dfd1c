"""A sample of the catalogue against its SQL; tools/compare.py runs all of it."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from lethe.plans.catalogue import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "keys_clean", "validate_root", "path_two_hop", "estimate_delete", "purge_rows",
    "purge_audit", "mask_apply", "mask_date_shift", "rpt_signoff", "chk_orphans",
]
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())  # optional queries may be tested otherwise


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, connection, name):
    fine, note, _ = compare(spark, connection, SF_DIR, name)
    assert fine, note


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0
