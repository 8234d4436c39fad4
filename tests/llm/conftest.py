import pytest

RAW = "_idx bigint, id string, instruction string, context string, response string, category string, meta string, source_name string, created_at timestamp, ingested_at timestamp"
LOG = "log_id bigint, model string, prediction string"


@pytest.fixture(scope="session")
def raw(spark):
    """Rows of raw_instructions from partial dictionaries."""

    def make(*rows, **extra):
        cols = [c.split()[0] for c in RAW.split(", ")]
        full = [tuple(({"_idx": i} | r).get(c) for c in cols) for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, RAW)
        for k, v in extra.items():
            df = df.withColumn(k, v)
        return df

    return make


@pytest.fixture(scope="session")
def log(spark):
    return lambda *texts: spark.createDataFrame([(i, "m", t) for i, t in enumerate(texts)], LOG)
