import pytest


@pytest.fixture
def docs(spark):
    """docs([(id, text), ...]) -> a table with columns whose names the operators use inside."""

    def make(rows, **columns):
        full = [(i, t, "h1", "en", "x", 7, 0.5) for i, t in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string, lang string, rest string, g int, h1 double")
        return df.repartition(3) if len(full) > 3 else df

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, long), (5, long), (6, "one two"), (None, "one two"),
            (None, None), (7, "é" * 60), (8, "é" * 60), (9, "\n\n\n")]
