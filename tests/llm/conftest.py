import glob
import os

import pytest


@pytest.fixture(scope="session")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from (doc_id, text) or longer rows, with clashing columns."""

    def build(rows):
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        schema = "doc_id long, text string, lang string, source string"
        frame = spark.createDataFrame(full, schema)
        return frame.selectExpr(
            "*", "length(text) AS n_chars", "1 AS size", "'x' AS kind", "2 AS start", "3 AS node"
        )

    return build
