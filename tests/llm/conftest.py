"""Small tables with every hard case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import pytest
from samples import SCHEMA, hard_rows


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["x", 1, 2, 3, 4, 5, "k", 6, "i", "l", "t", 7])
                                      for r in rows], SCHEMA)
    return build


@pytest.fixture(scope="session")
def hard(make):
    return make(hard_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark, sf):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())


@pytest.fixture(autouse=True, scope="session")
def prepared(spark):
    from sparkloom.llm.common import ready

    ready(spark)
