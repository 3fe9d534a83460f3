import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, n long"


@pytest.fixture(scope="session", autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def documents(spark):
    """Makes a documents table with columns that clash with internal names."""

    def make(rows):
        full = [(i, t, lang, src, len(t or ""), "k", 7, 9) for i, t, lang, src in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make
