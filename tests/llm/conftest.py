from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest

KIND = "text string, doc_id long, extra string, lang string, source string, sha string, size long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash."""

    def make(*rows):
        full = [(r[1], r[0], "x", "en", r[2] if len(r) > 2 else "s", "sha", -1) for r in rows]
        return spark.createDataFrame(full, KIND)

    return make


@pytest.fixture(scope="session")
def make_labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make


@pytest.fixture(scope="session")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {Path(path).stem} as select * from '{path}'")
    return connection
