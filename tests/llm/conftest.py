import os

import pytest
from llm_rows import CLASHES, DOC_SCHEMA, small_docs
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def doc_rows():
    return small_docs()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    """The small documents with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame(doc_rows, DOC_SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels_schema():
    return "doc_id long, quality int, toxic int"


@pytest.fixture(scope="session")
def sf001():
    return os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")
