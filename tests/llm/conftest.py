import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """DataFrame of (doc_id, text) rows, with other columns whose names an operator uses itself."""

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, DOCS)
        if not extra:
            return df
        return df.selectExpr(
            "*", "'x' AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS fp", "2 AS kept",
            "3 AS n_words", "4 AS h_text", "5 AS spans", "6 AS key", "7 AS _removed2", "8 AS begin",
        )

    return make


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
