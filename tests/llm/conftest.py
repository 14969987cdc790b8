import pytest

# Names that operators might use inside: extra columns may have them.
CLASHES = (
    "fp", "hash", "key", "row", "rows", "bucket", "guest", "root", "rules", "rest", "gone", "n",
    "s", "c", "y", "i", "word", "text_md5", "component_id", "spans", "items", "segment", "start",
    "end", "size", "host", "path", "rule", "verdict", "score", "ids", "row_id", "a.b", "left",
)


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema): a DataFrame with the extra columns of CLASHES."""
    from pyspark.sql import functions as F

    def make(rows, schema, parts=3):
        names = {x.split()[0] for x in schema.split(", ")}
        df = spark.createDataFrame(rows, schema).repartition(parts)
        extra = {c: F.lit(k) for k, c in enumerate(CLASHES) if c not in names}
        return df.withColumns(extra)

    return make


@pytest.fixture(scope="session")
def edge_docs(frame):
    """Nulls, empty and blank texts, repeated rows and ids, and one very long text."""
    long = " ".join(f"w{k % 997}x{k % 31}" for k in range(60_000)) + "\n" + "z" * 50_000
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (None, "alpha beta gamma delta epsilon"),
        (None, "alpha beta gamma delta epsilon"), (None, "another text without an id at all"),
        (4, "alpha beta gamma delta epsilon"), (4, "alpha beta gamma delta epsilon"),
        (4, "same id but another text here"), (5, long), (6, long), (7, "x"), (8, "Ünïcode ÄÖ 日本語 \U0001f600"),
    ]
    return frame(rows, "doc_id long, text string")


@pytest.fixture(scope="session")
def no_docs(frame):
    return frame([], "doc_id long, text string")
