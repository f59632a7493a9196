"""Every registered query against its SQL on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from marketbars.checks import oracles, queries

# What else the entry module registers has tests of its own.
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()
FITTED = {
    "predict_linear",
    "predict_forest",
    "predict_gbt",
    "model_leaderboard",
    "best_model_predictions",
    "score_saved_model",
}


@pytest.fixture(scope="session")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def as_rows(rows, names):
    """Rows with columns by name, in one fixed order; nulls sort last."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: [(value is None, 0 if value is None else value) for value in row],
    )


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir, tables):
    ours = QUERIES[name](spark, sf_dir)
    cursor = tables.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(ours.columns) == sorted(names)
    expected = as_rows(cursor.fetchall(), names)
    assert expected
    assert as_rows(ours.collect(), ours.columns) == expected
