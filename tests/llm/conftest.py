import pytest


@pytest.fixture
def documents(spark):
    """Documents as (id, text, source) rows, with columns that clash with working names."""

    def make(rows, extra=True):
        full = [(i, t, s, 1, "x", 2.0, True, None, 3) for i, t, s in rows]
        df = spark.createDataFrame(
            full,
            "doc_id bigint, text string, source string, id int, key string, _key double, "
            "_spread boolean, size string, _l_pos int",
        )
        return df if extra else df.select("doc_id", "text", "source")

    return make
