import pytest


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table with extra columns that clash with the operators' own names."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        columns = len(schema.split(","))
        rows = [tuple(r) + (None,) * (columns - len(r)) for r in rows]
        df = spark.createDataFrame(rows, schema)
        for name in ("score", "size", "_size", "fp", "line", "h", "content", "taken", "lang_pred", "shard", "node"):
            df = df.selectExpr("*", f"cast(null as string) as {name}")
        return df

    return make
