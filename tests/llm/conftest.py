import pytest
from samples import CLASHING, ROWS


@pytest.fixture(scope="session")
def tricky(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.limit(0)
