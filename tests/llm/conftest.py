from __future__ import annotations

import pytest
from samples import DOCS, EXTRA, MESSY

from tidemark.llm.common import ship

@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F

    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in MESSY]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in EXTRA})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def provided():
    """Rows of a provided table at the smallest scale."""
    import pyarrow.parquet as pq

    return lambda name: pq.read_table(f"/root/testdata/sf0.001/{name}.parquet").to_pylist()
