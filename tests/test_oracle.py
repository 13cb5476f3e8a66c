"""Every named query against its independent SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
import fleetscope_oracle as oracle
from fleetscope.plans import catalog
from fleetscope.sources import events
from tests.conftest import DATA

QUERIES = catalog.queries()
ORACLE = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}
SCALES = os.environ.get("ORACLE_SCALES", "0.01").split(",")


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    folder = str(DATA / f"sf{request.param}")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    yield folder, connection
    connection.close()


def _key(row):
    return [(value is not None, str(value)) for value in row]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


def compare(found, wanted):
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(wanted.query("w", f"SELECT {quoted} FROM w").fetchall(), key=_key)
    actual = sorted((tuple(row) for row in found.select(*columns).collect()), key=_key)
    assert actual == expected
    return actual


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, scale, name):
    folder, connection = scale
    rows = compare(QUERIES[name](spark, folder), connection.sql(ORACLE[name]))
    # the smallest scale happens to have no repeated key
    assert rows or (name == "duplicate_keys" and folder.endswith("sf0.001"))


def on_damaged(name):
    """The oracle of a query, with the damaged readings in place of the clean."""
    clean = oracle.TELEMETRY.replace("telemetry AS (", "clean AS (")
    damaged = oracle.DAMAGED.replace("FROM telemetry", "FROM clean")
    expected = f", {oracle.EXPECTED}" if name == "state_mix_drift" else ""
    return f"""WITH {clean}{damaged}, telemetry AS (SELECT * FROM damaged){expected}
        {oracle.CLEAN[name]}"""


# a load by day refuses damaged readings, and the result review counts no null groups
REFUSED = {"slice_replace_load", "result_tables"}


@pytest.mark.parametrize("name", sorted({*catalog.ANALYSES, *catalog.LOADS} - REFUSED))
def test_same_rows_on_damaged_readings(spark, scale, name):
    folder, connection = scale
    found = catalog.CLEAN[name](events.damaged_telemetry(spark, folder))
    compare(found, connection.sql(on_damaged(name)))


def test_entry_is_stable(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "zone",
        "shift",
        "total_records",
        "offline_count",
        "unauthorized_count",
        "total_risk_events",
        "risk_score",
    ]
    assert result.count() == 18
