"""Fixtures for the training-data operators."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import SCHEMA, documents  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """These operators run many small jobs here; two partitions show all that eight would.  Set and taken
    back by module: the session is shared with the other tests."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs_dir(spark, odd_docs, tmp_path_factory):
    """The odd documents as a table folder."""
    path = str(tmp_path_factory.mktemp("tables"))
    odd_docs.write.parquet(f"{path}/documents.parquet")
    return path
